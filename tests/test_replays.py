"""The staged GL by marks, feeds of one base table, counts of hot documents, packed CSV."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tieout.operators import matching, replays
from tieout.operators.staging import stg_gl_journal
from tieout.sources import files
from tieout.sources.fixtures import fixture
from tieout.sources.schemas import RAW_DDL

from conftest import SF_SMALL

GL_DDL = RAW_DDL["gl_journal"].replace(" NOT NULL", "")
D, LIVE, OLD = dt.date(2001, 1, 10), dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 31)


def line(journal, number, debit, at):
    values = {"journal_id": journal, "journal_line_id": number, "entity_id": 1, "business_date": D, "posting_date": D,
              "account_code": "6000", "debit_usd": Decimal(debit), "credit_usd": Decimal(0), "currency": "USD",
              "amount_currency": Decimal(debit), "fx_rate": Decimal(1), "source_system": "AP", "source_doc_id": journal,
              "description": "d", "created_by": "c", "ingested_at": at}
    return tuple(values[c.split()[0]] for c in GL_DDL.split(", "))


@pytest.mark.parametrize(("mark_bits", "most"), [(28, 0.9), (17, 0.9), (4, 0.9), (28, 0.0)])
def test_marks_keep_the_same_lines(spark, mark_bits, most):
    rows = [line(f"J{i:04d}", n, i + n, LIVE) for i in range(300) for n in (1, 2)]
    rows += [line(f"J{i:04d}", 1, i + 9, OLD) for i in range(0, 300, 20)]
    rows += [line("HOT", 1, i, OLD) for i in range(60)] + [line(None, 1, 5, LIVE), line(None, 1, 6, LIVE), line(None, None, 7, OLD)]
    raw = spark.createDataFrame(rows, GL_DDL).repartition(7)
    plain, marked = stg_gl_journal(raw), replays.staged_gl(raw, mark_bits, most)
    assert marked.columns == plain.columns and marked.count() == plain.count() == 603
    assert plain.exceptAll(marked).count() == 0


def test_only_marked_lines_are_shuffled(spark):
    raw = spark.range(20_000, numPartitions=4).select(
        F.concat(F.lit("J"), F.col("id")).alias("journal_id"), F.lit(1).alias("journal_line_id"),
        *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in GL_DDL.split(", ")[2:]])
    marked = replays.staged_gl(raw.unionByName(raw.limit(10)))
    assert marked.count() == 20_000
    plan = marked._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    assert "Window" not in plan and "LeftAnti" in plan


def test_documents_are_not_cached_and_feeds_read_one_table(spark):
    fx = fixture(spark, SF_SMALL)
    assert not fx.documents().storageLevel.useDisk
    invoices = fx.ap_invoices()
    assert {"/".join(f.split("/")[-2:-1]).split("-")[1] for f in invoices.inputFiles()} == {"li"}
    whole = fx.documents().filter((F.col("feed") == "AP-INV") & (F.col("k") % 1000 != 9))
    assert invoices.count() == whole.count() > 0


def test_hot_documents_are_counted_by_residues_first(spark):
    ids = spark.range(500).select(F.when(F.col("id") < 200, "H").otherwise(F.col("id").cast("string")).alias("source_doc_id"))
    none = ids.limit(0)
    found = matching.hot_documents(ids, none, threshold=150, lines_per_bucket=50, coarse=2).collect()
    assert [r["_nb"] for r in found] == [4]
    assert matching.hot_documents(ids, none, threshold=1_000).count() == 0


def test_zero_lines_of_a_hot_document_stay(spark):
    from test_matching import GL_DDL as GL
    from test_matching import POST_DDL, Z, gl, sl

    p = spark.createDataFrame([sl("H", a, Decimal(i + 1), Z, role=f"R{i}") for i in range(30) for a in ("6000", "2000")]
                              + [sl("H", "6000", Z, Z, role=f"Z{i}") for i in range(5)], POST_DDL)
    g = spark.createDataFrame([gl("H", i + 1, "6000", Decimal(i + 1), Z) for i in range(30)] + [gl("H", 99, "6000", Z, Z)], GL)
    plain = matching.match_transactions(p, g)
    ranged = matching.match_transactions(p, g, hot_key_lines=10, lines_per_bucket=10)
    assert plain.count() == 66 and plain.exceptAll(ranged).count() == 0 and ranged.exceptAll(plain).count() == 0


def test_match_shuffles_by_document(spark):
    from test_matching import GL_DDL as GL
    from test_matching import POST_DDL, Z, gl, sl

    p = spark.createDataFrame([sl("A", "6000", Decimal(1), Z)], POST_DDL)
    g = spark.createDataFrame([gl("A", 1, "6000", Decimal(1), Z)], GL)
    plan = matching.match_transactions(p, g)._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert plan.count("Exchange hashpartitioning(source_doc_id") == 2 and plan.count("Exchange") == 2


def test_csv_folders_may_be_packed(spark, tmp_path):
    df = spark.range(1_000).select(F.col("id").cast("int").alias("entity_id"), F.lit("Entity").alias("entity_name"))
    for how in ("none", "gzip"):
        files.write_tables_csv({"dim_entity": df}, str(tmp_path / how), compression=how)
    names = os.listdir(tmp_path / "gzip" / "raw__dim_entity.csv")
    assert any(n.endswith(".csv.gz") for n in names) and not any(n.endswith(".csv") for n in names)
    back = [spark.read.option("header", True).csv(str(tmp_path / how / "raw__dim_entity.csv")) for how in ("none", "gzip")]
    assert back[1].count() == 1_000 and back[0].exceptAll(back[1]).count() == 0
