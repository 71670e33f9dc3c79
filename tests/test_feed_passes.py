"""The GL feed: one reading of its base tables, rates without a join, replays beside the live lines."""

import datetime as dt

from pyspark.sql import functions as F

from tieout.sources import fixtures

SF = "/root/testdata/sf0.001"


def test_rates_without_a_join(spark):
    table = fixtures.fx_rate(spark).select("rate_date", "from_currency", "rate")
    first, last = dt.date(1994, 12, 30), dt.date(2002, 2, 2)  # two days more at each end
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("rate_date"))
    cases = days.select("rate_date", F.explode(F.array(*map(F.lit, ["USD", "EUR", "INR", "GBP", None]))).alias("from_currency"))
    cases = cases.unionByName(spark.createDataFrame([(None, "EUR")], "rate_date DATE, from_currency STRING"))
    given = cases.withColumn("given", fixtures.rate_in_table(F.col("rate_date"), F.col("from_currency")))
    both = given.join(table, ["rate_date", "from_currency"], "left")
    assert both.filter("rate IS NOT NULL").count() == table.count() > 7000
    assert both.filter("NOT given <=> rate").count() == 0


def test_gl_feed_reads_its_tables_once(spark):
    gl = fixtures.fixture(spark, SF).gl_journal()
    plan = gl._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 7  # five feeds and two kinds of manual entries
    assert "Join" not in plan


def test_replays_are_older_and_higher(spark):
    gl = fixtures.fixture(spark, SF).gl_journal()
    keys = ["journal_id", "journal_line_id"]
    live = gl.filter(F.col("ingested_at") == F.lit(fixtures.LIVE_INGESTED_AT))
    old = gl.filter(F.col("ingested_at") == F.lit(fixtures.REPLAY_INGESTED_AT))
    pairs = old.alias("o").join(live.alias("l"), keys)
    assert 0 < old.count() == pairs.count() and old.count() + live.count() == gl.count()
    up = F.col("o.debit_usd") + F.col("o.credit_usd") - F.col("l.debit_usd") - F.col("l.credit_usd")
    assert pairs.filter(up != 1).count() == 0
