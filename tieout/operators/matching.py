"""Transaction-level matching: sub-ledger lines vs GL lines.

Full outer match on (source_system, source_doc_id, account_code, direction),
where direction is 'D' for a line with debit > 0 and 'C' for credit > 0.
Zero lines get no direction and so never match (each side stays unmatched),
which is what the "same side is positive" condition means under the ledger's
constraint that a line is never positive on both sides.

Duplicate keys on a side are paired one-to-one in a stable order (`dup_seq`)
rather than multiplied, so no key ever emits all pairs of its lines.

Skew. A full outer join is never broadcast and AQE cannot split its skewed
partitions, so a document holding a large share of all lines must not reach one
task. A count per document (a 64-bit hash of its id, counted by residues first)
finds the *hot* ones, with more than `hot_key_lines` lines on both sides
together; their number is bounded by total lines / `hot_key_lines`.

* Cold keys: lines are shuffled by document, so the lines of a document travel
  side by side and compress well. `dup_seq` = `row_number()` over the key,
  ordered by the stable tie-break; window and join on (key, dup_seq) reuse that
  partitioning (co-partitioning on a key subset is allowed), so each side
  shuffles once. Lines compress tenfold, so partitions are sized by lines,
  LINES_PER_TASK of both sides together: tasks sized by shuffled bytes (AQE) or
  by a fixed partition count sort more than they can hold and spill.
* Hot documents: lines are range-partitioned on (key, tie-break) into
  ceil(lines / LINES_PER_BUCKET) partitions and written once. Lines are
  numbered inside (key, partition); the key's lines in earlier partitions
  (one row per key and partition) are the offset, so `dup_seq` is the same
  number that one window per key gives, and pairs don't depend on the limit.
  The join is then hash-partitioned on (key, dup_seq), which spreads a hot
  key over all tasks.
* Lines with a NULL key part (zero lines) can never match. They carry a
  per-line `_spread` hash (0 for every other line) that is part of both the
  numbering partition and the join key, so a large group of zero lines is
  spread over tasks and still leaves the join one-sided, in the same plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tieout.functions.columns import money
from tieout.functions.rules import categorize_break, resolve_tolerance
from tieout.plans.broadcast import checked_broadcast
from tieout.plans.session import ensure_checkpoint_dir

MATCH_KEYS = ["source_system", "source_doc_id", "account_code", "direction"]
MATCHED_SYSTEMS = ["AP", "AR", "INV"]
SL_ORDER = ["sl_posting_date", "sl_amount_usd", "posting_role", "entity_id", "business_date", "currency"]
GL_ORDER = ["gl_posting_date", "gl_amount_usd", "journal_id", "journal_line_id"]

# lines per document (both sides) above which its keys are numbered by ranges
HOT_KEY_LINES = 1_000_000
# hot keys get ceil(lines / LINES_PER_BUCKET) range partitions, so a task's work is bounded
LINES_PER_BUCKET = 250_000
# lines of both sides that a task of the match sorts
LINES_PER_TASK = 500_000
# residues of the document hash that lines are counted by before single documents are
COARSE_KEYS = 1 << 14
# hot-key list and bucket-offset tables are broadcast only under these bounds
HOT_KEYS_BROADCAST_MAX = 100_000
OFFSETS_BROADCAST_MAX = 1_000_000


def direction(debit: Column, credit: Column) -> Column:
    return F.when(debit > 0, "D").when(credit > 0, "C")


def sl_lines(postings: DataFrame) -> DataFrame:
    return postings.select(
        "source_system", "source_doc_id", "entity_id", "business_date",
        F.col("posting_date").alias("sl_posting_date"), "account_code", "currency",
        F.col("amount_usd").alias("sl_amount_usd"), "posting_role",
        direction(F.col("debit_usd"), F.col("credit_usd")).alias("direction"),
    )


def gl_lines(stg_gl: DataFrame) -> DataFrame:
    return stg_gl.filter(F.col("source_system").isin(*MATCHED_SYSTEMS) & F.col("source_doc_id").isNotNull()).select(
        "source_system", "source_doc_id", "entity_id", "business_date",
        F.col("posting_date").alias("gl_posting_date"), "account_code", "currency",
        money(F.col("debit_usd") + F.col("credit_usd")).alias("gl_amount_usd"),
        "journal_id", "journal_line_id",
        direction(F.col("debit_usd"), F.col("credit_usd")).alias("direction"),
    )


def with_spread(lines: DataFrame, order: list[str]) -> DataFrame:
    """`_spread`: 0 for a line that can match, a hash of the line otherwise."""
    return lines.withColumn("_spread", F.when(_matchable(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(*order)))


def for_shuffle(lines: DataFrame) -> DataFrame:
    """The columns in the order in which shuffled rows compress best.

    A row is its fixed-width part, then its texts. Numbers and dates of a line end the first, ids of the document begin
    the second, so what is new in a row stands in one stretch between two that repeat rows before it.
    """
    kind = {f.name: f.dataType.simpleString() for f in lines.schema.fields}
    ids = [c for c in ("source_doc_id", "journal_id") if c in kind]
    texts = [c for c in kind if kind[c] == "string" and c not in ids]
    return lines.select(*ids, *texts, "_spread", *[c for c in kind if kind[c] != "string" and c != "_spread"])


def number_lines(lines: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """dup_seq = 1..n per (match key, _spread) in `order` (one shuffle, by document, into `parts` partitions)."""
    w = W.partitionBy(*MATCH_KEYS, "_spread").orderBy(*order)
    by = [*([parts] if parts else []), "source_doc_id", "_spread"]
    return for_shuffle(lines).repartition(*by).withColumn("dup_seq", F.row_number().over(w))


def number_lines_ranged(lines: DataFrame, order: list[str], parts: int) -> DataFrame:
    """dup_seq = 1..n per match key in `order`, without putting a key into one task.

    Lines are range-partitioned on (key, order) and written once, so a key runs
    through consecutive partitions in its order. A line's number is its number
    within (key, partition) plus the key's lines in earlier partitions: the same
    number that one window per key gives. The offsets table has at most one row
    per key and partition border; it is broadcast only if a probe finds it small.
    """
    ranged = lines.repartitionByRange(parts, *MATCH_KEYS, *order).withColumn("_b", F.spark_partition_id()).checkpoint()
    x = ranged.withColumn("_rn", F.row_number().over(W.partitionBy(*MATCH_KEYS, "_b").orderBy(*order)))
    sizes = ranged.groupBy(*MATCH_KEYS, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*MATCH_KEYS).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*MATCH_KEYS, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    x = x.join(checked_broadcast(offsets, OFFSETS_BROADCAST_MAX), [*MATCH_KEYS, "_b"])
    return x.withColumn("dup_seq", (F.col("_off") + F.col("_rn")).cast("int")).drop("_b", "_rn", "_off")


def document_key() -> Column:
    return F.xxhash64("source_doc_id")


def _documents(sl: DataFrame, gl: DataFrame, coarse: int) -> DataFrame:
    """Document hash `_kh` and its residue `_r` of every line of both sides; null where a line has no document."""
    ids = sl.select("source_doc_id").unionByName(gl.select("source_doc_id"))
    docs = ids.select(F.when(F.col("source_doc_id").isNotNull(), document_key()).alias("_kh"))
    return docs.withColumn("_r", F.pmod("_kh", F.lit(coarse)).cast("int"))


def lines_by_residue(sl: DataFrame, gl: DataFrame, coarse: int = COARSE_KEYS) -> DataFrame:
    """(_r, count): lines of both sides by residue of the document hash, written once (at most `coarse` + 1 rows)."""
    return _documents(sl, gl, coarse).groupBy("_r").count().checkpoint()


def hot_documents(
    sl: DataFrame, gl: DataFrame, threshold: int = HOT_KEY_LINES, lines_per_bucket: int = LINES_PER_BUCKET,
    coarse: int = COARSE_KEYS, residues: DataFrame | None = None,
) -> DataFrame:
    """Hashes of document ids with more than `threshold` lines on both sides together.

    First, lines are counted by `coarse` residues of the hash, so a task sends at most
    that many counts, however many documents it reads. A hot document makes its residue
    crowded; only the documents of crowded residues (mostly none) are counted one by
    one. A collision can only add documents to the ranged path, which numbers lines as
    the plain one does, so results do not depend on it. `residues` are the lines by
    residue where they are counted already.
    """
    residues = residues if residues is not None else lines_by_residue(sl, gl, coarse)
    crowded = residues.filter(F.col("_r").isNotNull() & (F.col("count") > threshold)).select("_r")
    docs = _documents(sl, gl, coarse)
    if crowded.isEmpty():
        return docs.sparkSession.createDataFrame([], "_kh BIGINT, _nb INT")
    counts = docs.join(F.broadcast(crowded), "_r", "left_semi").groupBy("_kh").count().filter(F.col("count") > threshold)
    return counts.select("_kh", F.ceil(F.col("count") / F.lit(lines_per_bucket)).cast("int").alias("_nb"))


def _matchable() -> Column:
    return F.col("source_doc_id").isNotNull() & F.col("account_code").isNotNull() & F.col("direction").isNotNull() \
        & F.col("source_system").isNotNull()


MATCH_COLUMNS = [
    "source_system", "source_doc_id", "account_code", "entity_id", "business_date", "currency",
    "posting_role", "sl_posting_date", "gl_posting_date", "sl_amount_usd", "gl_amount_usd",
    "journal_id", "journal_line_id",
]
# columns of the mart whose values repeat only in a document's own lines: a dictionary of them is larger than they are
PLAIN_COLUMNS = ["source_doc_id", "journal_id", "sl_amount_usd", "gl_amount_usd"]


def _pair(sl: DataFrame, gl: DataFrame) -> DataFrame:
    sl, gl = sl.alias("sl"), gl.alias("gl")
    cond = [F.col(f"sl.{k}") == F.col(f"gl.{k}") for k in [*MATCH_KEYS, "_spread", "dup_seq"]]
    j = sl.join(gl, cond, "full_outer")

    def both(c: str) -> Column:
        return F.coalesce(F.col(f"sl.{c}"), F.col(f"gl.{c}")).alias(c)

    return j.select(
        both("source_system"), both("source_doc_id"), both("account_code"), both("entity_id"),
        both("business_date"), both("currency"), F.col("sl.posting_role"), F.col("sl.sl_posting_date"),
        F.col("gl.gl_posting_date"), F.col("sl.sl_amount_usd"), F.col("gl.gl_amount_usd"),
        F.col("gl.journal_id"), F.col("gl.journal_line_id"),
    )


def match_transactions(
    postings: DataFrame, stg_gl: DataFrame, hot_key_lines: int = HOT_KEY_LINES,
    lines_per_bucket: int = LINES_PER_BUCKET, lines_per_task: int = LINES_PER_TASK,
) -> DataFrame:
    """Full outer match of SL postings to GL lines (AP/AR/INV with a doc id)."""
    sl = with_spread(sl_lines(postings), SL_ORDER)
    gl = with_spread(gl_lines(stg_gl), GL_ORDER)
    # one pass over the document hashes, the hot ones written once to the shared checkpoint folder
    # (at most lines / hot_key_lines rows); its count and bucket total bound the rest
    ensure_checkpoint_dir(sl.sparkSession)
    residues = lines_by_residue(sl, gl)
    hot = hot_documents(sl, gl, hot_key_lines, lines_per_bucket, residues=residues).checkpoint()
    lines = residues.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    tasks = max(sl.sparkSession.sparkContext.defaultParallelism, -(-lines // lines_per_task))
    stats = hot.agg(F.count(F.lit(1)).alias("keys"), F.sum("_nb").alias("buckets")).first()
    if stats["keys"] == 0:
        return _pair(number_lines(sl, SL_ORDER, tasks), number_lines(gl, GL_ORDER, tasks))
    hot_b = F.broadcast(hot) if stats["keys"] <= HOT_KEYS_BROADCAST_MAX else hot
    parts = max(2, int(stats["buckets"]))

    def split(lines: DataFrame, how: str) -> DataFrame:
        # inner on a unique hash = semi join that also brings the bucket count
        # lines that can't match have no hash: they stay cold, spread by line
        return lines.withColumn("_kh", F.when(_matchable(), document_key())).join(hot_b, "_kh", how).drop("_kh")

    cold = _pair(
        number_lines(split(sl, "left_anti"), SL_ORDER, tasks), number_lines(split(gl, "left_anti"), GL_ORDER, tasks)
    )
    ranged = _pair(
        number_lines_ranged(split(sl, "inner").drop("_nb"), SL_ORDER, parts),
        number_lines_ranged(split(gl, "inner").drop("_nb"), GL_ORDER, parts),
    )
    return cold.unionByName(ranged)


def recon_transaction_level(matched: DataFrame, tolerance_rules: DataFrame, recon_at: dt.datetime | str) -> DataFrame:
    """Delta, lag, resolved tolerances, break class and MATCHED/BREAK per matched row."""
    m = resolve_tolerance(matched, "account_code", tolerance_rules)
    sl, gl = F.col("sl_amount_usd"), F.col("gl_amount_usd")
    delta = F.coalesce(sl, F.lit(0)) - F.coalesce(gl, F.lit(0))
    lag = F.datediff(F.col("gl_posting_date"), F.col("sl_posting_date"))
    tol_amt, tol_days = F.col("amount_tolerance_usd"), F.col("timing_tolerance_days")
    matched_ok = (F.abs(delta) <= tol_amt) & (F.abs(F.coalesce(lag, F.lit(0))) <= tol_days) & sl.isNotNull() & gl.isNotNull()
    ts = recon_at if isinstance(recon_at, str) else recon_at.strftime("%Y-%m-%d %H:%M:%S")
    return m.select(
        *MATCH_COLUMNS[:11],
        money(delta).alias("amount_delta_usd"),
        F.coalesce(lag, F.lit(0)).alias("posting_lag_days"),
        "journal_id", "journal_line_id", "amount_tolerance_usd", "timing_tolerance_days",
        categorize_break(
            sl, gl, F.col("sl_posting_date"), F.col("gl_posting_date"), F.col("currency"), tol_amt, tol_days
        ).alias("break_class"),
        F.when(matched_ok, "MATCHED").otherwise("BREAK").alias("status"),
        F.lit(ts).cast("timestamp").alias("recon_at"),
    )
