"""Sharding: repeated rows, clashing names, few jobs, splitters against a sort."""

import numpy as np
import pytest

from tieout.llm import sharding
from tieout.llm.common import scratch

SF = "/root/testdata/sf0.01"


def shares(frame):
    return {r.shard: (r["count"], r.low, r.high) for r in frame.groupBy("shard").agg({"*": "count"}).withColumnRenamed("count(1)", "count").join(
        frame.groupBy("shard").agg({"slot": "min"}), "shard").join(frame.groupBy("shard").agg({"slot": "max"}), "shard").toDF("shard", "count", "low", "high").collect()}


@pytest.mark.parametrize("doc", [7, None])
def test_rows_equal_in_text_and_id_are_spread(spark, doc):
    rows = [(doc, "the same text for all")] * 4000
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), scratch(spark, "same"))
    for n, low, high in (found := shares(got)).values():
        assert abs(n - 500) <= 5 and (low, high) == (0, n - 1)
    assert sorted(found) == list(range(8)) and got.distinct().count() == 4000  # slots differ within a shard


def test_hot_rows_among_others(spark):
    rows = [(k % 50, f"text {k} " * (k % 9)) for k in range(900)] + [(3, "hot one")] * 1500 + [(k, "hot two") for k in range(1500)] + [(None, None)] * 300
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), scratch(spark, "hot"))
    size = lambda t: len((t or "").encode()) + 1
    back = got.collect()
    assert sorted(map(str, [(r.doc_id, r.text) for r in back])) == sorted(map(str, rows))
    totals = [sum(size(r.text) for r in back if r.shard == k) for k in range(8)]
    assert max(totals) - min(totals) <= 2 * max(size(t) for _, t in rows) + 0.01 * sum(totals) / 8
    for k in range(8):
        assert sorted(r.slot for r in back if r.shard == k) == list(range(sum(r.shard == k for r in back)))


def test_helper_names_may_be_columns(spark):
    schema = "doc_id long, text string, __hash string, __id string, __piece string, __own string, __base string, hash string, id string, size string, position string, piece string, `___HASH` string, slot string, shard string"
    rows = [(k, f"text {k}", *"abcdefghijklm") for k in range(40)] + [(None, None, *[None] * 13)] * 3
    got = sharding.sharded(spark.createDataFrame(rows, schema), scratch(spark, "names"))
    assert got.count() == 43 and got.where("__hash = 'a' and piece = 'j'").count() == 40
    assert got.columns[:13] == [c for c in schema.replace("`", "").replace(" long", "").replace(" string", "").split(", ")][:13]


def test_jobs_stay_few(spark):
    sc = spark.sparkContext
    sc.setJobGroup("shards", "count of jobs")
    out = sharding.op1_histogram_sort(spark, SF)
    jobs = len(sc.statusTracker().getJobIdsForGroup("shards"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert jobs < 60


def test_places_equal_a_sort():
    rng = np.random.default_rng(2)
    keys = [rng.integers(0, 6, 500), rng.integers(0, 4, 500), rng.integers(0, 9, 500)]
    cuts = sorted({(2, sharding._LOW, sharding._LOW), (2, 1, 4), (2, 1, 7), (2, 3, sharding._LOW), (4, 0, 2), (5, sharding._LOW, sharding._LOW)})
    expected = [sum(c <= tuple(int(k[i]) for k in keys) for c in cuts) for i in range(500)]
    assert sharding._places(cuts, keys).tolist() == expected
