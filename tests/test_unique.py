"""Uniqueness by sketch: same rows as the plain count, far less shuffled."""

import numpy as np
from pyspark.sql import functions as F

from tieout.operators import quality, unique


def shuffled(df):
    """Bytes that the exchanges of a frame wrote when it was collected."""
    df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get("shuffleBytesWritten").get().value() if name == "ShuffleExchangeExec" else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def _rows(df):
    return sorted(map(str, df.collect()))


def test_pack_round_trip():
    random = np.random.default_rng(5)
    for top in (1, 3, 200, 2**20, 2**45, 2**62):
        for n in (0, 1, 2, 999):
            some = np.sort(random.integers(0, top, n, dtype=np.uint64))
            assert (unique.unpack(unique.pack(some)) == some).all()


def test_equal_to_the_plain_count(spark):
    df = spark.range(0, 40_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 997 == 1, None)
        .when(F.col("id") % 501 == 2, F.concat(F.lit("twice"), F.col("id").cast("int") % 5010))
        .otherwise(F.concat(F.lit("document-"), "id")).alias("k"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("v"))
    for most in (unique.MOST_SUSPECTS, 1):  # 1: too many suspects, the plain way
        assert _rows(unique.dq_unique_sketched(df, "k", most)) == _rows(quality.dq_unique(df, "k"))
        assert _rows(unique.dq_unique_combination_sketched(df, ["k", "v"], most)) == _rows(
            quality.dq_unique_combination(df, ["k", "v"]))
    assert unique.dq_unique_sketched(df.limit(0), "k").count() == 0
    assert unique.dq_unique_sketched(df.filter("k IS NULL"), "k").count() == 0


def test_shuffle_where_repeats_are_rare(spark):
    n = 400_000
    df = spark.range(0, n, 1, 8).select(
        F.concat(F.lit("JE-"), F.sha2(F.when(F.col("id") % 50_000 == 7, 7).otherwise(F.col("id")).cast("string"), 256))
        .alias("journal_id"))
    plain = quality.dq_unique(df, "journal_id")
    assert _rows(unique.dq_unique_sketched(df, "journal_id")) == _rows(plain)
    few = unique.suspects(df, ["journal_id"], n)
    assert 1 <= few.count() < 3 * unique.SPURIOUS
    assert shuffled(few) + shuffled(unique.dq_unique_sketched(df, "journal_id")) < shuffled(plain) / 10
