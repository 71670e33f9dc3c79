"""Matching, break classes, merge, SCD2, hierarchy on hand-built rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from tieout.operators import balances, history, matching
from tieout.plans.ledger import seed_frames

POST_DDL = ("source_system STRING, source_doc_id STRING, entity_id INT, business_date DATE, posting_date DATE, "
            "currency STRING, amount_currency DECIMAL(18,2), amount_usd DECIMAL(18,2), fx_rate DECIMAL(18,8), "
            "account_code STRING, debit_usd DECIMAL(18,2), credit_usd DECIMAL(18,2), posting_role STRING")
GL_DDL = ("journal_id STRING, journal_line_id INT, entity_id INT, business_date DATE, posting_date DATE, "
          "account_code STRING, debit_usd DECIMAL(18,2), credit_usd DECIMAL(18,2), currency STRING, "
          "source_system STRING, source_doc_id STRING")
D = dt.date(2001, 1, 10)
Z = Decimal("0")


def sl(doc, acct, dr, cr, cur="USD", role="R", d=D):
    amt = dr if dr > 0 else cr
    return ("AP", doc, 1, d, d, cur, amt, amt, Decimal("1"), acct, dr, cr, role)


def gl(doc, line, acct, dr, cr, cur="USD", d=D):
    return (f"GL-{doc}", line, 1, d, d, acct, dr, cr, cur, "AP", doc)


def _txn(spark, sl_rows, gl_rows):
    p = spark.createDataFrame(sl_rows, POST_DDL)
    g = spark.createDataFrame(gl_rows, GL_DDL)
    m = matching.match_transactions(p, g)
    return matching.recon_transaction_level(m, seed_frames(spark)("tolerance_rules"), "2024-02-01 08:00:00")


def test_break_classes(spark):
    dd = dt.date(2001, 1, 13)
    rows_sl = [
        sl("A1", "6000", Decimal("10"), Z),                # matched
        sl("A2", "6000", Decimal("10"), Z),                # missing GL
        sl("A4", "6000", Decimal("10"), Z),                # amount mismatch (USD)
        sl("A5", "6000", Decimal("10"), Z, cur="EUR"),     # fx rounding
        sl("A6", "6000", Decimal("10"), Z),                # timing
    ]
    rows_gl = [
        gl("A1", 1, "6000", Decimal("10"), Z),
        gl("A3", 1, "6000", Decimal("10"), Z),             # missing SL
        gl("A4", 1, "6000", Decimal("10.50"), Z),
        gl("A5", 1, "6000", Decimal("10.05"), Z, cur="EUR"),
        gl("A6", 1, "6000", Decimal("10"), Z, d=dd),
    ]
    out = {r["source_doc_id"]: r for r in _txn(spark, rows_sl, rows_gl).collect()}
    assert out["A1"]["status"] == "MATCHED" and out["A1"]["break_class"] == "UNKNOWN"
    assert out["A2"]["break_class"] == "MISSING_GL_POSTING"
    assert out["A3"]["break_class"] == "MISSING_SL_POSTING"
    assert out["A4"]["break_class"] == "AMOUNT_MISMATCH"
    assert out["A5"]["break_class"] == "FX_ROUNDING"
    assert out["A6"]["break_class"] == "TIMING_DIFF" and out["A6"]["posting_lag_days"] == 3


def test_zero_lines_never_match(spark):
    out = _txn(spark, [sl("Z1", "1300", Z, Z)], [gl("Z1", 1, "1300", Z, Z)]).collect()
    assert sorted(r["break_class"] for r in out) == ["MISSING_GL_POSTING", "MISSING_SL_POSTING"]


def test_direction_must_agree(spark):
    out = _txn(spark, [sl("B1", "2000", Z, Decimal("5"))], [gl("B1", 1, "2000", Decimal("5"), Z)]).collect()
    assert len(out) == 2 and all(r["status"] == "BREAK" for r in out)


def test_duplicate_keys_pair_one_to_one(spark):
    rows_sl = [sl("C1", "6000", Decimal("1"), Z, role="R1"), sl("C1", "6000", Decimal("2"), Z, role="R2")]
    rows_gl = [gl("C1", 1, "6000", Decimal("1"), Z), gl("C1", 2, "6000", Decimal("2"), Z)]
    out = _txn(spark, rows_sl, rows_gl).collect()
    assert len(out) == 2  # not 4: no key emits all pairs
    assert all(r["status"] == "MATCHED" for r in out)


def test_merge_is_idempotent(spark):
    tgt = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k1 STRING, k2 STRING, v INT")
    src = spark.createDataFrame([("a", None, 10), ("c", "y", 3)], "k1 STRING, k2 STRING, v INT")
    once = history.merge_upsert(tgt, src, ["k1", "k2"])
    twice = history.merge_upsert(once, src, ["k1", "k2"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    assert sorted((r["k1"], r["v"]) for r in once.collect()) == [("a", 10), ("b", 2), ("c", 3)]


def test_merge_plain_keys_duplicate_null_rows(spark):
    tgt = spark.createDataFrame([("a", None, 1)], "k1 STRING, k2 STRING, v INT")
    src = spark.createDataFrame([("a", None, 10)], "k1 STRING, k2 STRING, v INT")
    assert history.merge_upsert(tgt, src, ["k1", "k2"], null_safe=False).count() == 2
    assert history.merge_upsert(tgt, src, ["k1", "k2"]).count() == 1


def test_merge_appends_new_columns(spark):
    tgt = spark.createDataFrame([("a", 1)], "k STRING, v INT")
    src = spark.createDataFrame([("b", 2, "n")], "k STRING, v INT, extra STRING")
    out = history.merge_upsert(tgt, src, ["k"])
    assert "extra" in out.columns and out.filter("k = 'a'").first()["extra"] is None


def test_scd2_lifecycle(spark):
    cols = "code STRING, name STRING"
    v1 = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], cols)
    v2 = spark.createDataFrame([("1", "a"), ("2", "B"), ("4", "d")], cols)
    s1 = history.scd2_snapshot(None, v1, "code", ["name"], "2024-01-01 00:00:00")
    s2 = history.scd2_snapshot(s1, v2, "code", ["name"], "2024-02-01 00:00:00")
    rows = {(r["code"], r["name"]): r for r in s2.collect()}
    assert rows[("1", "a")]["valid_to"] is None
    assert rows[("2", "b")]["valid_to"] is not None and rows[("2", "B")]["valid_to"] is None
    assert rows[("3", "c")]["valid_to"] is not None  # hard delete closes
    assert rows[("4", "d")]["valid_to"] is None
    s3 = history.scd2_snapshot(s2, v2, "code", ["name"], "2024-03-01 00:00:00")
    assert s3.count() == s2.count()  # same source again: nothing changes
    asof = {r["code"]: r["name"] for r in history.scd2_as_of(s2, "2024-01-15 00:00:00").collect()}
    assert asof == {"1": "a", "2": "b", "3": "c"}


def test_chart_hierarchy(spark):
    from tieout.sources.fixtures import dim_account

    acc = dim_account(spark).select("account_code", "account_name", "account_type", "parent_account_code",
                                    "is_control_account", "subledger_source")
    h = {r["account_code"]: r for r in balances.account_hierarchy(acc).collect()}
    assert len(h) == 24
    assert h["1100"]["level"] == 1 and h["1100"]["path"] == "1000/1100" and h["1100"]["root_code"] == "1000"
    assert h["2000"]["level"] == 0


def test_hierarchy_orphans_and_cycles(spark):
    acc = spark.createDataFrame(
        [("R", None), ("A", "R"), ("B", "A"), ("O", "MISSING"), ("X", "Y"), ("Y", "X")],
        "account_code STRING, parent_account_code STRING",
    )
    h = balances.account_hierarchy(acc)
    assert {r["account_code"]: r["level"] for r in h.collect()} == {"R": 0, "A": 1, "B": 2}
    assert sorted(r["account_code"] for r in balances.unreached_accounts(acc, h).collect()) == ["O", "X", "Y"]


def test_trial_balance_running(spark):
    rows = [sl("T1", "1200", Decimal("10"), Z, d=D), sl("T2", "1200", Z, Decimal("4"), d=D),
            sl("T3", "1200", Decimal("1"), Z, d=dt.date(2001, 1, 11))]
    tb = balances.trial_balance(spark.createDataFrame(rows, POST_DDL)).orderBy("posting_date").collect()
    assert [r["daily_net_usd"] for r in tb] == [Decimal("-6.00"), Decimal("-1.00")]
    assert [r["running_balance_usd"] for r in tb] == [Decimal("-6.00"), Decimal("-7.00")]
    _ = F


def test_hot_key_salting_pairs_every_line_once(spark):
    # one key holds most lines: 300 SL and 250 GL lines on the same document
    rows_sl = [sl("H1", "6000", Decimal(i + 1), Z, role=f"R{i:03d}") for i in range(300)]
    rows_gl = [gl("H1", i + 1, "6000", Decimal(i + 1), Z) for i in range(250)]
    rows_sl += [sl("C1", "6000", Decimal("7"), Z), sl("Z1", "6000", Z, Z)]
    rows_gl += [gl("C1", 1, "6000", Decimal("7"), Z), gl("Z1", 1, "6000", Z, Z)]
    p = spark.createDataFrame(rows_sl, POST_DDL)
    g = spark.createDataFrame(rows_gl, GL_DDL)
    m = matching.match_transactions(p, g, hot_key_lines=100, lines_per_bucket=40).cache()
    hot = m.filter(F.col("source_doc_id") == "H1")
    assert hot.count() == 300  # 250 pairs + 50 SL-only: no pair explosion, nothing lost
    assert hot.filter(F.col("sl_amount_usd").isNotNull() & F.col("gl_amount_usd").isNotNull()).count() == 250
    assert hot.select("posting_role").distinct().count() == 300
    assert hot.filter(F.col("journal_line_id").isNotNull()).select("journal_line_id").distinct().count() == 250
    cold = {r["source_doc_id"]: r for r in m.filter(F.col("source_doc_id") != "H1").collect() if r["sl_amount_usd"]}
    assert cold["C1"]["gl_amount_usd"] == Decimal("7")
    assert m.filter(F.col("source_doc_id") == "Z1").count() == 2  # zero lines stay one-sided
    m.unpersist()


def test_hot_path_equals_cold_path_on_fixture(spark, ledger):
    # with every multi-line key treated as hot, unique keys must pair exactly as before
    cols = matching.MATCH_COLUMNS
    base = matching.match_transactions(ledger.postings(), ledger.stg_gl()).select(*cols)
    salted = matching.match_transactions(ledger.postings(), ledger.stg_gl(), hot_key_lines=1, lines_per_bucket=1)
    assert base.exceptAll(salted.select(*cols)).count() == 0
    assert salted.select(*cols).exceptAll(base).count() == 0


def test_pairs_do_not_depend_on_the_hot_key_limit(spark):
    rows_sl = [sl("H1", "6000", Decimal(i), Z, d=D + dt.timedelta(days=i % 5), role=f"R{i:03d}") for i in range(1, 401)]
    rows_gl = [gl("H1", i, "6000", Decimal(i), Z) for i in range(1, 401)]
    p, g = spark.createDataFrame(rows_sl, POST_DDL), spark.createDataFrame(rows_gl, GL_DDL)
    plain = matching.match_transactions(p, g, hot_key_lines=1_000_000)
    ranged = matching.match_transactions(p, g, hot_key_lines=100, lines_per_bucket=40)
    assert plain.count() == 400 and plain.exceptAll(ranged).count() == 0 and ranged.exceptAll(plain).count() == 0


def test_hierarchy_reaches_every_level(spark):
    acc = spark.createDataFrame([(f"A{i}", f"A{i - 1}" if i else None) for i in range(130)], "account_code STRING, parent_account_code STRING")
    levels = {r["level"] for r in balances.account_hierarchy(acc).collect()}
    assert levels == set(range(130))


def _walk(links):
    """Level, root and path of every account reached from a root, one by one."""
    parent, out = dict(links), {}
    for code in parent:
        path, seen = [code], {code}
        while parent.get(path[-1]) is not None and parent[path[-1]] in parent and parent[path[-1]] not in seen:
            path.append(parent[path[-1]])
            seen.add(path[-1])
        if parent[path[-1]] is None:
            out[code] = (len(path) - 1, path[-1], "/".join(reversed(path)))
    return out


def test_hierarchy_of_random_forests_with_cycles_and_orphans(spark, monkeypatch):
    rng = random.Random(5)
    links = [(f"N{i:04d}", None if i % 50 == 0 else f"N{rng.randrange(i):04d}") for i in range(600)]
    links += [(f"C{i:03d}", f"C{(i + 1) % 37:03d}") for i in range(37)] + [(f"B{i:03d}", f"B{i - 1:03d}" if i else "C005") for i in range(45)]
    links += [("SELF", "SELF"), ("UNDER", "SELF"), ("LOST", "NOWHERE"), ("BELOW", "LOST")] + [(f"K{i:03d}", "N0000") for i in range(200)]
    acc = spark.createDataFrame(links, "account_code STRING, parent_account_code STRING").repartition(5)
    for hot in (100_000, 20):  # with and without salted parents
        got = {r.account_code: (r.level, r.root_code, r.path) for r in balances.account_hierarchy(acc, hot).collect()}
        assert got == _walk(links)


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    n, tables = 10_000, []
    keep = balances.write_table
    monkeypatch.setattr(balances, "write_table", lambda df, path: tables.append(df.columns) or keep(df, path))
    acc = spark.range(n).selectExpr("concat('A', id) AS account_code", "IF(id = 0, NULL, concat('A', id - 1)) AS parent_account_code")
    h = balances.account_hierarchy(acc)
    assert h.agg({"level": "max"}).first()[0] == n - 1 and h.count() == n
    assert sum("_piece" in c for c in tables) - 1 <= 16  # the first table is no round


def test_cluster_without_shared_folder_is_refused():
    from types import SimpleNamespace

    from tieout.plans.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))
