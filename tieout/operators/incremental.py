"""The staged GL, the postings and both trial balances kept from run to run.

A run reads the input files it hasn't read yet and rewrites only what they touch:

* Change capture: a ledger of files (path, size, time of change). A file that vanished or changed means
  that the feed was replaced, so everything is built anew.
* The staged GL is dealt into ranges of its key (journal, line). Keep-latest is a maximum, so the latest
  of old and new copies is the latest of the old latest and the new: a run reads the ranges that its new
  lines fall into, whatever they replay, and writes these again. A range that grew to twice its size is split.
* Postings come from append-only feeds, one row at a time: the postings of new files are a new part.
* What changed leaves as signed lines (minus the version in force before, plus the one after). A trial
  balance adds them to the daily sums of the months they fall into. Balances run within a month; what an
  account brings into a month is the sum of its month totals before, a table of accounts by months. A
  correction of an old day so rewrites its month, and re-bases all later days through the carry alone.

Every table is a set of parts, each a Parquet folder that never changes. One manifest names the parts in
force; publishing it is the last step of a run. A run lost at any point leaves the manifest before it, so
a reader sees a whole state, never a mixture; folders that no manifest names are left to a clean-up.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tieout.functions.columns import money_sum
from tieout.operators import replays
from tieout.operators.balances import TB_KEYS
from tieout.operators.postings import subledger_postings
from tieout.operators.staging import GL_KEYS, GL_STAGED_COLUMNS, stage, stg_gl_journal
from tieout.operators.unique import _position
from tieout.plans import storage
from tieout.plans.materialize import open_writers
from tieout.sources.schemas import raw_schema

POSTING_FEEDS = ["ap_invoices", "ap_payments", "ar_invoices", "ar_receipts", "inv_transactions"]
SUMS = ["daily_debits_usd", "daily_credits_usd", "daily_net_usd"]
ACCOUNT = ["entity_id", "account_code"]
#: Rows of a key range; it is split at twice as many.
RANGE_ROWS = 2_000_000
#: Folders that a task writes to at once without sorting its lines by them.
OPEN_FOLDERS = 32

Files = dict[str, tuple[int, int]]


def list_files(spark: SparkSession, folder: str) -> Files:
    """Parquet files of a feed with size and time of change."""
    fs, path = storage._fs(spark, folder)  # noqa: SLF001
    if not fs.exists(path):
        return {}
    found, out = fs.listFiles(path, True), {}
    while found.hasNext():
        s = found.next()
        name = s.getPath().getName()
        if name.endswith(".parquet") and not name.startswith(("_", ".")):
            out[s.getPath().toString()] = (s.getLen(), s.getModificationTime())
    return out


@dataclass
class State:
    """Parts in force: (table, part) -> folder; the files read; the lowest key of each range."""

    parts: dict[tuple[str, str], str] = field(default_factory=dict)
    files: Files = field(default_factory=dict)
    lows: dict[int, tuple[str | None, int | None]] = field(default_factory=dict)

    SCHEMA = "kind STRING, name STRING, part STRING, path STRING, a BIGINT, b BIGINT"

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> State:
        newest = storage.latest_version(spark, folder)
        out = cls()
        for r in spark.read.schema(cls.SCHEMA).parquet(newest).toLocalIterator() if newest else ():
            if r["kind"] == "part":
                out.parts[r["name"], r["part"]] = r["path"]
            elif r["kind"] == "file":
                out.files[r["path"]] = (r["a"], r["b"])
            else:
                out.lows[int(r["part"])] = (r["name"], r["a"])
        return out

    def publish(self, spark: SparkSession, folder: str) -> None:
        rows = [("part", t, p, path, None, None) for (t, p), path in self.parts.items()]
        rows += [("file", None, None, path, *seen) for path, seen in self.files.items()]
        rows += [("range", journal, str(k), None, line, None) for k, (journal, line) in self.lows.items()]
        storage.publish(spark.createDataFrame(rows, self.SCHEMA).coalesce(1), folder)


@dataclass
class Run:
    """What a run read: bytes of input files and of parts, beside what is in force after it."""

    rebuilt: bool
    new_files: int
    bytes_read: int = 0
    bytes_in_force: int = 0


class IncrementalLedger:
    def __init__(self, spark: SparkSession, raw_dir: str, state_dir: str, range_rows: int = RANGE_ROWS):
        self.spark, self.raw_dir, self.dir, self.range_rows = spark, raw_dir, state_dir, range_rows
        self.manifest = os.path.join(state_dir, "manifest")
        self.state = State.load(spark, self.manifest)
        self._read = 0
        self._sizes: dict[str, int] = {}  # of folders, which never change

    # ------------------------------------------------------------------ parts
    def _paths(self, table: str, parts: Iterable[str] | None = None) -> list[str]:
        wanted = None if parts is None else set(parts)
        return [p for (t, k), p in self.state.parts.items() if t == table and (wanted is None or k in wanted)]

    def _size(self, path: str) -> int:
        if path not in self._sizes:
            fs, p = storage._fs(self.spark, path)  # noqa: SLF001
            self._sizes[path] = fs.getContentSummary(p).getLength()
        return self._sizes[path]

    def _table(self, table: str, schema, parts: Iterable[str] | None = None, count: bool = False) -> DataFrame:
        paths = self._paths(table, parts)
        if count:
            self._read += sum(map(self._size, paths))
        reader = self.spark.read.schema(schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, df: DataFrame, table: str, part: str | None = None) -> DataFrame:
        """Writes new parts (by the column `part`, or one) and names them; those of the same name go out of force."""
        path = os.path.join(self.dir, "data", f"{table}-{uuid.uuid4().hex}")
        if part is not None:
            df.write.option("compression", "zstd").parquet(path)
            self.state.parts[table, part] = path
            return self.spark.read.schema(df.schema).parquet(path)
        with open_writers(self.spark, OPEN_FOLDERS):
            df.withColumn("_folder", F.col("part")).write.option("compression", "zstd").partitionBy("_folder").parquet(path)
        for name in storage.names(self.spark, path):
            if name.startswith("_folder="):
                self.state.parts[table, name.removeprefix("_folder=")] = os.path.join(path, name)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def _drop(self, table: str, parts: Iterable[str]) -> None:
        for p in parts:
            self.state.parts.pop((table, str(p)), None)

    # ------------------------------------------------------------------ a run
    def run(self) -> Run:
        """Brings all tables up to the files that are there now, then publishes them at once."""
        feeds = {t: list_files(self.spark, os.path.join(self.raw_dir, t)) for t in ["gl_journal", *POSTING_FEEDS]}
        now = {path: seen for files in feeds.values() for path, seen in files.items()}
        replaced = any(now.get(path) != seen for path, seen in self.state.files.items())
        before, self._read = self.state, 0
        known = {} if replaced else dict(before.files)
        self.state = State() if replaced else State(dict(before.parts), {}, dict(before.lows))
        self.state.files = now
        new = {t: [p for p in files if p not in known] for t, files in feeds.items()}
        self._read += sum(now[p][0] for paths in new.values() for p in paths)
        try:
            if new["gl_journal"]:
                self._balance("gl", self._stage_gl(self._raw("gl_journal", new["gl_journal"])))
            if any(new[t] for t in POSTING_FEEDS):
                fresh = subledger_postings(*(stage(self._raw(t, new[t]), t) for t in POSTING_FEEDS))
                self._balance("sl", self._write(fresh, "postings", uuid.uuid4().hex).withColumn("sign", F.lit(1)))
            if now != before.files:
                self.state.publish(self.spark, self.manifest)
        except BaseException:
            self.state = before
            raise
        held = sum(self._size(p) for p in self.state.parts.values())
        return Run(replaced or not before.files, sum(map(len, new.values())), self._read, held + sum(n for n, _ in now.values()))

    def _raw(self, feed: str, paths: list[str]) -> DataFrame:
        schema = raw_schema(feed)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # -------------------------------------------------------------- staged GL
    def _range(self) -> Column:
        """The range of a line: the one with the greatest low key that isn't above the line's key, found by halving."""
        key = F.struct(*(F.col(c) for c in GL_KEYS))
        lows = sorted(self.state.lows.items(), key=lambda kv: (kv[1][0] is not None, kv[1][0] or "", kv[1][1] is not None, kv[1][1] or 0))
        # both lists are parsed once a query (foldable), however many ranges there are
        bounds = F.from_json(
            F.lit(json.dumps([dict(zip(GL_KEYS, low, strict=True)) for _, low in lows])),
            f"array<struct<{GL_KEYS[0]}: string, {GL_KEYS[1]}: int>>")
        names = F.from_json(F.lit(json.dumps([k for k, _ in lows])), "array<int>")
        steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(lows).bit_length()))))

        def further(at: Column, step: Column) -> Column:  # `at` lows are known not to be above the key
            return F.when((at + step <= len(lows)) & (F.get(bounds, at + step - 1) <= key), at + step).otherwise(at)

        return F.element_at(names, F.greatest(F.aggregate(steps, F.lit(0), further), F.lit(1)))

    def _deal(self, df: DataFrame, ranges: int, first: int) -> DataFrame:
        """Writes `df` as that many new key ranges, numbered from `first`, and notes their low keys."""
        dealt = df.drop("part").repartitionByRange(ranges, *GL_KEYS).withColumn("part", F.spark_partition_id() + first)
        out = self._write(dealt.select(*GL_STAGED_COLUMNS, "part"), "gl")
        for r in out.groupBy("part").agg(F.min(F.struct(*GL_KEYS)).alias("low")).collect():
            self.state.lows[r["part"]] = tuple(r["low"])
        return out

    def _stage_gl(self, raw: DataFrame) -> DataFrame:
        """Keep-latest of the new lines and the ranges they fall into; returns the signed changes."""
        if not self.state.lows:
            fresh, rows = replays.staged_gl(raw), raw.count()
            return self._deal(fresh, max(1, -(-rows // self.range_rows)), 0).drop("part").withColumn("sign", F.lit(1))
        # the newest copy of each new key; small beside the table, and read several times
        fresh = self._write(stg_gl_journal(raw).withColumn("part", self._range()), "new", "new")
        self._drop("new", ["new"])
        arrived = {r["part"]: r["count"] for r in fresh.groupBy("part").count().collect()}
        touched = list(arrived)
        old = self._table("gl", fresh.schema, map(str, touched), count=True)
        # lines whose key may be new are settled with the new lines; the others are copied where they are
        bits = replays.MARK_BITS
        marks, on = replays.marked(fresh.select(_position(GL_KEYS, bits).alias("position")), bits)
        hit = self._write(old.join(marks, on, "left_semi"), "hit", "hit")
        latest = stg_gl_journal(hit.drop("part", "net_amount_usd").unionByName(fresh.drop("part", "net_amount_usd")))
        # a range that took in very many lines is dealt over several tasks, each of which adds a file to it
        salts = max(1, -(-max(arrived.values()) // self.range_rows))
        settled = latest.withColumn("part", self._range()).repartition("part", F.pmod(F.hash(*GL_KEYS), F.lit(salts)))
        settled = self._write(settled, "settled", "settled")
        self._drop("hit", ["hit"])
        self._drop("settled", ["settled"])
        self._drop("gl", touched)
        written = self._write(settled.unionByName(old.join(marks, on, "left_anti")), "gl")
        for r in written.groupBy("part").count().where(F.col("count") > 2 * self.range_rows).collect():
            low = self.state.lows.pop(r["part"])
            self._drop("gl", [r["part"]])
            first = max([*self.state.lows, r["part"]]) + 1
            self._deal(written.where(F.col("part") == r["part"]), -(-r["count"] // self.range_rows), first)
            lowest = min(k for k in self.state.lows if k >= first)
            self.state.lows[lowest] = low  # keys between the old low and the lowest now belong here too
        keys = fresh.select(*GL_KEYS)

        def of_new_keys(lines: DataFrame) -> DataFrame:
            same = [lines[k].eqNullSafe(keys[k]) for k in GL_KEYS]
            return lines.join(keys, same[0] & same[1], "left_semi").drop("part")

        gone, come = of_new_keys(hit), of_new_keys(settled)
        return gone.withColumn("sign", F.lit(-1)).unionByName(come.withColumn("sign", F.lit(1)))

    # ---------------------------------------------------------- trial balances
    def _balance(self, side: str, lines: DataFrame) -> None:
        """Adds signed lines to the daily sums of their months and to the month totals."""
        signed = lambda c: F.sum(c * F.col("sign"))
        net = F.col("credit_usd") - F.col("debit_usd")
        month = F.coalesce(F.date_format("posting_date", "yyyy-MM"), F.lit("0000-00"))
        delta = lines.groupBy(*TB_KEYS, month.alias("part")).agg(
            *(money_sum(signed(c)).alias(n) for n, c in zip(SUMS, (F.col("debit_usd"), F.col("credit_usd"), net), strict=True)),
            F.sum("sign").cast("long").alias("lines"),
        )
        delta = self._write(delta, "delta", "delta")
        self._drop("delta", ["delta"])
        touched = [r[0] for r in delta.select("part").distinct().collect()]
        days = self._table(f"{side}_days", delta.schema, touched, count=True).unionByName(delta)
        days = days.groupBy(*TB_KEYS, "part").agg(*(money_sum(F.sum(c)).alias(c) for c in SUMS), F.sum("lines").alias("lines")).where("lines > 0")
        of_month = [*ACCOUNT, F.col("part").alias("month")]
        totals = self._table(f"{side}_months", delta.select(*of_month, F.col("daily_net_usd").cast("decimal(38,2)").alias("net")).schema, count=True)
        kept = totals.where(~F.col("month").isin(touched))
        self._drop(f"{side}_days", touched)
        days = self._write(days, f"{side}_days")
        fresh = days.groupBy(*of_month).agg(F.sum("daily_net_usd").cast("decimal(38,2)").alias("net"))
        self._write(kept.unionByName(fresh), f"{side}_months", "all")

    def trial_balance(self, side: str, months: Iterable[str] | None = None) -> DataFrame:
        """The daily trial balance of `gl` or `sl` (all months, or those named), running balances included."""
        paths = self._paths(f"{side}_days", months)
        totals = self.spark.read.parquet(*self._paths(f"{side}_months"))
        before = W.partitionBy(*ACCOUNT).orderBy("month").rowsBetween(W.unboundedPreceding, -1)
        opening = totals.select(*ACCOUNT, "month", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("opening"))
        days = self.spark.read.parquet(*paths).alias("d")
        inside = W.partitionBy(*(F.col(f"d.{c}") for c in ACCOUNT), F.col("d.part")).orderBy("d.posting_date").rowsBetween(W.unboundedPreceding, W.currentRow)
        same = [F.col(f"d.{c}").eqNullSafe(F.col(f"o.{c}")) for c in ACCOUNT]
        joined = days.join(opening.alias("o"), same[0] & same[1] & (F.col("d.part") == F.col("o.month")))
        running = money_sum(F.col("opening") + F.sum("d.daily_net_usd").over(inside)).alias("running_balance_usd")
        return joined.select(*(F.col(f"d.{c}") for c in [*TB_KEYS, *SUMS]), running)

    def stg_gl(self) -> DataFrame:
        return self.spark.read.parquet(*self._paths("gl")).select(*GL_STAGED_COLUMNS)

    def postings(self) -> DataFrame:
        return self.spark.read.parquet(*self._paths("postings"))
