"""Look-ups of documents: what they return and how little they read."""

from pyspark.sql import functions as F

from tieout.operators import drill


def scanned_rows(df):
    """Rows that the scans of a collected frame handed on (after row groups and pages were left out)."""

    def scans(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return scans(node.executedPlan())
        if name == "FileSourceScanExec":
            return node.metrics().get("numOutputRows").get().value()
        return sum(scans(node.children().apply(i)) for i in range(node.children().size()))

    return scans(df._jdf.queryExecution().executedPlan())


def _rows(df):
    return sorted(map(str, df.collect()))


def test_look_up_reads_few_rows(spark, ledger, tmp_path):
    gl = ledger.stg_gl()
    total = gl.count()
    table = drill.lay_out(gl, str(tmp_path / "gl"), total, page_rows=50, file_rows=total // 3)
    documents = [r[0] for r in gl.filter("source_doc_id IS NOT NULL").select("source_doc_id").distinct()
                 .orderBy(F.xxhash64("source_doc_id")).limit(3).collect()]
    for few in (documents[:1], documents):
        found = drill.look_up(table, few)
        assert _rows(found) == _rows(gl.filter(F.col("source_doc_id").isin(*few)))
    one = drill.look_up(table, documents[:1])
    one.collect()
    assert 0 < scanned_rows(one) <= max(100, total // 100)
    assert drill.look_up(table, ["no such document"]).count() == 0
    assert drill.look_up(table, []).count() == 0


def test_drill_by_table_and_by_join(spark, ledger, tmp_path):
    lines = ledger.postings()
    table = drill.lay_out(lines, str(tmp_path / "sl"), lines.count())
    ids = lines.select("source_doc_id").distinct().orderBy("source_doc_id").limit(4)
    ids = ids.union(ids).union(spark.createDataFrame([(None,)], "source_doc_id STRING"))
    expected = _rows(lines.join(ids.distinct(), "source_doc_id", "left_semi").select(*lines.columns))
    assert _rows(drill.drill(table, ids)) == expected
    assert _rows(drill.drill(table, ids, most=2)) == expected


def test_hot_document_is_cut(spark, tmp_path):
    lines = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("D"), "id")).alias("source_doc_id"), "id")
    table = drill.lay_out(lines, str(tmp_path / "hot"), 30_000, file_rows=2_500)
    sizes = [r["n"] for r in table.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 10 and max(sizes) < 6_000
    assert drill.look_up(table, ["HOT"]).count() == 10_000
    empty = drill.lay_out(lines.limit(0), str(tmp_path / "none"), 0)
    assert drill.look_up(empty, ["HOT"]).count() == 0


def test_lay_out_shuffles_nothing(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame

    def refused(*_):
        raise AssertionError("lines were shuffled")

    lines = spark.range(4_000).select(F.concat(F.lit("D"), (F.col("id") % 900).cast("string")).alias("source_doc_id"), "id")
    monkeypatch.setattr(DataFrame, "repartitionByRange", refused)
    monkeypatch.setattr(DataFrame, "repartition", refused)
    table = drill.lay_out(lines, str(tmp_path / "t"), 4_000, page_rows=50)
    assert _rows(drill.look_up(table, ["D7"])) == _rows(lines.filter("source_doc_id = 'D7'"))
    in_order = table.withColumn("at", F.monotonically_increasing_id()).withColumn("file", F.input_file_name())
    files = {}
    for r in in_order.orderBy("at").collect():
        files.setdefault(r["file"], []).append(r[drill.HASH])
    assert all(x == sorted(x) for x in files.values())
