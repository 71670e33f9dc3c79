"""Tables kept from run to run equal full builds, whatever arrives; the bytes read follow the change."""

import os

import pytest
from pyspark.sql import functions as F

from tieout.operators import incremental as I
from tieout.operators.balances import trial_balance
from tieout.operators.postings import subledger_postings
from tieout.operators.staging import stage, stg_gl_journal
from tieout.plans import storage

FEEDS = ["gl_journal", *I.POSTING_FEEDS]


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def append(raw, feed, df):
    df.write.mode("append").parquet(os.path.join(raw, feed))


def check(kept):
    """All tables against full builds of the files that are there."""
    read = lambda t: kept.spark.read.parquet(os.path.join(kept.raw_dir, t))
    gl = stg_gl_journal(read("gl_journal"))
    sl = subledger_postings(*(stage(read(t), t) for t in I.POSTING_FEEDS))
    for got, want in (
        (kept.stg_gl(), gl), (kept.postings(), sl),
        (kept.trial_balance("gl"), trial_balance(gl)), (kept.trial_balance("sl"), trial_balance(sl)),
    ):
        assert dict(got.dtypes) == dict(want.dtypes)
        assert rows(got) == rows(want)


@pytest.fixture()
def feeds(spark, ledger, tmp_path):
    frames = {t: ledger.raw(t) for t in FEEDS}
    raw = str(tmp_path / "raw")
    return frames, raw, str(tmp_path / "state")


def test_growing_feeds_replays_and_corrections(spark, feeds):
    frames, raw, state = feeds
    kept = I.IncrementalLedger(spark, raw, state, range_rows=1_500)
    for t, df in frames.items():
        append(raw, t, df.where(F.xxhash64(*df.columns) % 5 != 0))
    assert kept.run().rebuilt
    check(kept)

    for t, df in frames.items():
        append(raw, t, df.where(F.xxhash64(*df.columns) % 5 == 0))
    assert not kept.run().rebuilt
    check(kept)

    # corrections move lines to other days, accounts and amounts; an old copy comes late and must lose
    gl = frames["gl_journal"].where(F.xxhash64("journal_id") % 7 == 0)
    later = F.col("ingested_at") + F.expr("INTERVAL 3 DAYS")
    fixed = gl.withColumn("ingested_at", later).withColumn("posting_date", F.date_add("posting_date", 40)).withColumn("debit_usd", (F.col("debit_usd") + 1).cast("decimal(18,2)"))
    stale = gl.withColumn("ingested_at", F.col("ingested_at") - F.expr("INTERVAL 9 DAYS")).withColumn("account_code", F.lit("9999"))
    new = gl.withColumn("journal_id", F.concat(F.lit("ZZ-"), "journal_id"))
    append(raw, "gl_journal", fixed.unionByName(stale).unionByName(new).unionByName(new))
    assert not kept.run().rebuilt
    check(kept)

    # nothing new reads nothing; another session finds the same state
    again = I.IncrementalLedger(spark, raw, state, range_rows=1_500)
    assert again.run().bytes_read == 0
    check(again)


def test_ranges_split_and_keys_stay_in_one_range(spark, feeds):
    frames, raw, state = feeds
    gl = frames["gl_journal"]
    append(raw, "gl_journal", gl.limit(300))
    kept = I.IncrementalLedger(spark, raw, state, range_rows=200)
    kept.run()
    few = len(kept.state.lows)
    append(raw, "gl_journal", gl)
    kept.run()
    assert len(kept.state.lows) > 3 * few
    append(raw, "gl_journal", gl.where(F.xxhash64("journal_id") % 3 == 0).withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 DAY")))
    kept.run()
    parts = kept.spark.read.parquet(*kept._paths("gl"))
    assert parts.count() == gl.select(*I.GL_KEYS).distinct().count()
    sizes = [r["count"] for r in parts.groupBy("part").count().collect()]
    assert max(sizes) <= 400


def test_bytes_follow_the_change(spark, feeds):
    frames, raw, state = feeds
    gl = frames["gl_journal"]
    many = gl.crossJoin(spark.range(12)).withColumn("journal_id", F.format_string("J%03d-%s", F.col("id"), F.col("journal_id"))).withColumn("posting_date", F.add_months("posting_date", F.col("id").cast("int"))).drop("id")
    append(raw, "gl_journal", many)
    kept = I.IncrementalLedger(spark, raw, state, range_rows=1_000)
    kept.run()
    day = gl.where(F.col("posting_date") == gl.agg(F.max("posting_date")).first()[0]).withColumn("journal_id", F.concat(F.lit("J999-"), "journal_id"))
    replay = many.where(F.col("journal_id") == many.agg(F.max("journal_id")).first()[0]).withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 DAY"))
    append(raw, "gl_journal", day.unionByName(replay).coalesce(1))
    run = kept.run()
    assert not run.rebuilt and run.bytes_read < run.bytes_in_force / 10, run
    got, want = kept.stg_gl(), stg_gl_journal(spark.read.parquet(os.path.join(raw, "gl_journal")))
    assert rows(got) == rows(want)
    assert rows(kept.trial_balance("gl")) == rows(trial_balance(want))


def test_replaced_feed_is_built_anew_and_a_lost_run_changes_nothing(spark, feeds, monkeypatch):
    frames, raw, state = feeds
    gl = frames["gl_journal"]
    for t in I.POSTING_FEEDS:
        append(raw, t, frames[t].limit(20))
    append(raw, "gl_journal", gl.limit(500))
    kept = I.IncrementalLedger(spark, raw, state)
    kept.run()
    before = rows(kept.stg_gl())
    append(raw, "gl_journal", gl.where(F.xxhash64("journal_id") % 2 == 0))
    with monkeypatch.context() as m:
        m.setattr(storage, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            kept.run()
    assert rows(kept.stg_gl()) == before == rows(I.IncrementalLedger(spark, raw, state).stg_gl())
    kept.run()
    check(kept)

    gl.limit(100).write.mode("overwrite").parquet(os.path.join(raw, "gl_journal"))
    assert kept.run().rebuilt
    check(kept)


def test_only_lines_of_new_keys_are_settled_again(spark, feeds, monkeypatch):
    frames, raw, state = feeds
    gl = frames["gl_journal"]
    is_late = F.xxhash64(*gl.columns) % 50 == 0
    append(raw, "gl_journal", gl.where(~is_late))
    settled = []
    monkeypatch.setattr(I, "stg_gl_journal", lambda df: settled.append(df.count()) or stg_gl_journal(df))
    kept = I.IncrementalLedger(spark, raw, state, range_rows=1_500)
    kept.run()
    late = gl.where(is_late).unionByName(gl.where(F.xxhash64(*gl.columns) % 90 == 1))  # new lines and repeats, over all ranges
    append(raw, "gl_journal", late)
    kept.run()
    assert max(settled) <= 3 * late.count()
    want = stg_gl_journal(gl)
    assert rows(kept.stg_gl()) == rows(want)
    assert rows(kept.trial_balance("gl")) == rows(trial_balance(want))
