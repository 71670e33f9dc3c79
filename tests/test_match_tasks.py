"""The match and its readers at size: tasks by lines, unique columns without dictionary, feeds counted without landing."""

import datetime as dt
from decimal import Decimal

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tieout.operators import matching
from tieout.plans.ledger import Ledger
from tieout.plans.materialize import write_table
from tieout.sources.schemas import DATA_FEEDS


def _sides(spark):
    from test_matching import GL_DDL, POST_DDL, Z, gl, sl

    p = [sl(f"D{i // 2}", "6000", Decimal(i + 1), Z, role=f"R{i % 3}") for i in range(400)] + [sl(None, "6000", Z, Z)]
    g = [gl(f"D{i // 2}", i, "6000", Decimal(i + 1), Z) for i in range(40, 440)]
    return spark.createDataFrame(p, POST_DDL), spark.createDataFrame(g, GL_DDL)


def test_tasks_of_the_match_hold_a_bounded_number_of_lines(spark):
    p, g = _sides(spark)
    plain = matching.match_transactions(p, g)
    small = matching.match_transactions(p, g, lines_per_task=10)  # 801 lines
    plan = small._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert plan.count(", 81), REPARTITION_BY_NUM") == 2 and plan.count("Exchange") == 2
    assert small.rdd.getNumPartitions() == 81  # neither joined by AQE nor bound to the session's count
    assert plain.count() > 400 and plain.exceptAll(small).count() == 0 and small.exceptAll(plain).count() == 0


def test_lines_by_residue_count_every_line(spark):
    p, g = _sides(spark)
    residues = matching.lines_by_residue(matching.sl_lines(p), matching.gl_lines(g), coarse=4)
    assert residues.agg(F.sum("count")).first()[0] == 801
    assert residues.filter(F.col("_r").isNull()).first()["count"] == 1


def test_unique_columns_are_written_without_a_dictionary(spark, tmp_path):
    df = spark.range(2_000).select(F.concat(F.lit("D"), F.col("id") % 50).alias("source_doc_id"), F.lit("AP").alias("source_system"))
    back = write_table(df.coalesce(1), str(tmp_path / "t"), plain=["source_doc_id"])
    assert back.exceptAll(df).count() == 0 and back.count() == 2_000
    group = pq.ParquetFile(next((tmp_path / "t").glob("*.parquet"))).metadata.row_group(0)
    kinds = {group.column(i).path_in_schema: set(group.column(i).encodings) for i in range(2)}
    assert not any("DICTIONARY" in e for e in kinds["source_doc_id"]) and any("DICTIONARY" in e for e in kinds["source_system"])


def test_row_counts_of_runs_land_no_feed(spark):
    landed = []
    feed = spark.createDataFrame([(dt.date(2001, 1, 2),), (dt.date(2001, 2, 3),), (None,)], "posting_date DATE")
    led = Ledger(spark, lambda t: landed.append(t) or feed, lambda t: feed, derived=lambda t: feed)
    rows = led.run_row_counts().collect()
    assert not landed and len(rows) == 3 * len(DATA_FEEDS)
    assert {r.run_id for r in rows} == {"run-2001-01", "run-2001-02", None}
