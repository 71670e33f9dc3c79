"""Keep-latest of a feed in which few keys repeat: only lines that may be copies are shuffled.

`staging.stg_gl_journal` sends every line to the task of its key. Here:

1. `unique.suspects` finds the key positions (hash bits) that more than one line takes, at two to five
   bytes a line. A repeated key is always among them.
2. The suspects become marks, a bitmap of at most 2**MARK_BITS bits (32 MB) in chunks that are broadcast,
   however many suspects there are. More of them only mark more lines.
3. Marked lines go through the plain keep-latest and are written once; all others are the only copy of
   their key and pass. The staged feed is both together, a scan without a shuffle.

So the result is the same as of the plain form, whatever the hashes say. Where more than MOST_MARKED of
the lines are suspect, repeats aren't rare and the plain form is written instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.functions.columns import money
from tieout.operators.staging import GL_KEYS, GL_STAGED_COLUMNS, stg_gl_journal
from tieout.operators.unique import _position, position_bits, suspects
from tieout.plans.materialize import new_table_dir, write_table

MARK_BITS = 28
#: Bits of a chunk of the bitmap (1,024 longs).
CHUNK_BITS = 16
#: Suspects per line above which all lines are shuffled.
MOST_MARKED = 0.25


def _chunk(marks: pa.Table) -> pa.Table:
    mark = marks.column("mark").to_numpy().astype(np.uint64)
    words = np.zeros(1 << CHUNK_BITS - 6, np.uint64)
    inside = mark & np.uint64((1 << CHUNK_BITS) - 1)
    np.bitwise_or.at(words, inside >> np.uint64(6), np.uint64(1) << (inside & np.uint64(63)))
    return pa.table({
        "chunk": pa.array([int(mark[0]) >> CHUNK_BITS], pa.int64()),
        "words": pa.array([words.astype(np.int64).tolist()], pa.list_(pa.int64())),
    })


def bitmap(found: DataFrame, bits: int, mark_bits: int) -> DataFrame:
    """The chunks of the bitmap that hold a mark; `found` has positions of that many bits."""
    mark = F.col("position").bitwiseAND(F.lit((1 << min(bits, mark_bits)) - 1)).alias("mark")
    marks = found.select(mark).withColumn("chunk", F.shiftright("mark", CHUNK_BITS))
    return marks.groupBy("chunk").applyInArrow(_chunk, "chunk BIGINT, words ARRAY<BIGINT>")


def _is_marked(mark: Column) -> Column:
    inside = mark.bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    word = F.get(F.col("words"), F.shiftright(inside, 6).cast("int"))
    return F.getbit(word, inside.bitwiseAND(F.lit(63)).cast("int")) == 1


def marked(found: DataFrame, bits: int, mark_bits: int = MARK_BITS) -> tuple[DataFrame, Column]:
    """The bitmap of `found` (`bits`-bit positions of keys), written once, and the condition that a line's key is in it.

    Every line whose key was found is marked, and a few others; at most 2**mark_bits bits are broadcast.
    """
    spark = found.sparkSession
    chunks = write_table(bitmap(found, bits, mark_bits), new_table_dir(spark, "gl-marks"))
    mark = _position(GL_KEYS, bits).bitwiseAND(F.lit((1 << min(bits, mark_bits)) - 1))
    return F.broadcast(chunks), (F.shiftright(mark, CHUNK_BITS) == F.col("chunk")) & _is_marked(mark)


def staged_gl(raw_gl: DataFrame, mark_bits: int = MARK_BITS, most: float = MOST_MARKED) -> DataFrame:
    """As `staging.stg_gl_journal`, with the superseded copies found and settled once."""
    spark = raw_gl.sparkSession

    def kept(df: DataFrame, label: str) -> DataFrame:
        return write_table(df, new_table_dir(spark, label))

    rows = raw_gl.count()
    bits = position_bits(rows)
    found = kept(suspects(raw_gl, GL_KEYS, rows), "gl-suspects")
    if found.count() > most * rows:
        return kept(stg_gl_journal(raw_gl), "gl-staged")
    marks, on = marked(found, bits, mark_bits)
    settled = kept(stg_gl_journal(raw_gl.join(marks, on, "left_semi")), "gl-settled")
    single = raw_gl.join(marks, on, "left_anti").withColumn(
        "net_amount_usd", money(F.col("debit_usd") - F.col("credit_usd"))).select(*GL_STAGED_COLUMNS)
    return single.unionByName(settled)
