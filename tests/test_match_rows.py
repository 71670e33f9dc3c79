"""Rows of the match as they travel: what is new in a row in one stretch, so that they compress."""

from tieout.operators import matching


def test_ids_come_first_and_numbers_last(spark):
    from test_matching import GL_DDL, POST_DDL

    for side, ddl, order in ((matching.sl_lines, POST_DDL, matching.SL_ORDER), (matching.gl_lines, GL_DDL, matching.GL_ORDER)):
        lines = matching.with_spread(side(spark.createDataFrame([], ddl)), order)
        out = matching.for_shuffle(lines)
        assert sorted(out.columns) == sorted(lines.columns)
        texts = [t == "string" for _, t in out.dtypes]
        assert out.columns[0] == "source_doc_id" and texts == sorted(texts, reverse=True)
        assert matching.number_lines(lines, order).columns == [*out.columns, "dup_seq"]

