"""The incremental tables with very many key ranges: ranges found by halving, few files a range, one pass per feed."""

import os

from pyspark.sql import functions as F

from tieout.operators import incremental as I
from tieout.operators.staging import stg_gl_journal
from tieout.plans import queries_history
from tieout.sources.schemas import raw_schema

from test_incremental import append, rows


def test_range_of_a_line(spark, tmp_path):
    kept = I.IncrementalLedger(spark, str(tmp_path / "raw"), str(tmp_path / "state"))
    lows = [(None, None), (None, 4), ("", 1), ("A\"\\", 2), *((f"J{i:05d}", 1 + i % 2) for i in range(3000)), ("é", 1)]
    kept.state.lows = {7 * i + 3: low for i, low in enumerate(lows)}
    keys = [*lows, ("A", 1), ("J", None), ("J00000", 0), ("J02999", 9), ("z", 1), ("éé", None)]
    df = spark.createDataFrame(keys, "journal_id STRING, journal_line_id INT")
    at = df.withColumn("part", kept._range())
    rank = lambda k: (k[0] is not None, k[0] or "", k[1] is not None, k[1] or 0)
    want = {k: 7 * max(i for i, low in enumerate(lows) if rank(low) <= rank(k)) + 3 for k in keys}
    assert {(r[0], r[1]): r["part"] for r in at.collect()} == want
    assert len(at._jdf.queryExecution().analyzed().toString()) < 400_000  # not an expression a range
    assert "from_json" not in at._jdf.queryExecution().optimizedPlan().toString()  # parsed once


def test_a_run_adds_one_file_a_range(spark, tmp_path):
    raw, state = str(tmp_path / "raw"), str(tmp_path / "state")
    schema = raw_schema("gl_journal")
    given = {"journal_id": F.format_string("J%06d", "id"), "journal_line_id": F.lit(1), "source_system": F.lit("AP"),
             "debit_usd": F.col("id"), "credit_usd": F.lit(0), "account_code": F.lit("1000"), "entity_id": F.lit(1)}
    day, at = F.lit("2024-01-01").cast("date"), F.lit("2024-02-01 00:00:00").cast("timestamp")
    given |= {"posting_date": day, "business_date": day, "ingested_at": at}
    gl = spark.range(20_000).select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))
    append(raw, "gl_journal", gl.where("journal_id not like '%7'"))
    kept = I.IncrementalLedger(spark, raw, state, range_rows=1_000)
    kept.run()
    append(raw, "gl_journal", gl.where("journal_id like '%7'"))
    kept.run()
    folders = kept._paths("gl")
    assert len(folders) > 10
    for folder in folders:  # the range's own lines and those of the run
        assert len([n for n in os.listdir(folder) if n.endswith(".parquet")]) <= 2
    assert rows(kept.stg_gl()) == rows(stg_gl_journal(gl))


def test_feeds_are_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    feed = spark.range(1000).mapInArrow(count, "id BIGINT")
    arrived = []
    for _ in queries_history._deliver(spark, {"feed": feed}, str(tmp_path)):
        arrived.append(spark.read.schema("id BIGINT").parquet(*I.list_files(spark, str(tmp_path / "raw" / "feed"))).collect())
    assert seen.value == 1000
    assert 0 < len(arrived[0]) < 1000 and sorted(r[0] for r in arrived[1]) == list(range(1000))
