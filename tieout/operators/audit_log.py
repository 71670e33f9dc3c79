"""The append-only audit log with snapshots, so that the latest state costs a snapshot and the tail.

Events are appended as files to the log folder and never change. A snapshot holds the latest event per key
over a set of event files, and the names of these files. The latest state is the latest event per key over
one whole snapshot and the files it doesn't name:

* A file counts twice at most (in a snapshot and in the tail), which changes no latest event. So any whole
  snapshot gives the same answer, and the one that names the most files is read only because it's cheapest.
* Runs that compact at the same time write two snapshots under names of their own. A compaction lost on
  the way leaves a folder without the mark of success, which no reader looks at.
* Events appended during a compaction aren't named by it and stay in the tail.

A new snapshot is made from the one before and its tail. Older snapshots are dropped two compactions later
(`keep`), when no reader that started before can still need them. The log itself stays whole for audit.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.operators.staging import dedup_latest
from tieout.plans import storage

#: Event files after which a snapshot is due.
DUE = 64
_EVENTS, _NAMES = "events", "files"


def _folder(log: str) -> str:
    return log.rstrip("/") + "_snapshots"


def _event_files(spark: SparkSession, log: str) -> set[str]:
    return {n for n in storage.names(spark, log) if n.endswith(".parquet") and n[0] not in "_."}


def _whole(spark: SparkSession, log: str) -> list[tuple[int, str]]:
    """(event files named, folder) of the whole snapshots, the largest last; the count is part of the name."""
    found = []
    for name in storage.names(spark, _folder(log)):
        path = os.path.join(_folder(log), name)
        # the list of names is written last, so its mark means that both parts are whole
        if name.startswith("s") and storage.exists(spark, os.path.join(path, _NAMES, "_SUCCESS")):
            found.append((int(name[1:].split("-")[0]), path))
    return sorted(found)


def _parts(spark: SparkSession, log: str) -> tuple[str | None, set[str], list[str]]:
    """(snapshot in force, event files that it names, event files of the tail)."""
    files, whole = _event_files(spark, log), _whole(spark, log)
    if not whole:
        return None, set(), sorted(files)
    newest = whole[-1][1]
    # names of files, some bytes a run: as long as the listing of the log itself
    named = {r[0] for r in spark.read.parquet(os.path.join(newest, _NAMES)).toLocalIterator()}
    return newest, named, sorted(files - named)


def _events(spark: SparkSession, log: str, snapshot: str | None, tail: list[str], schema) -> DataFrame:
    paths = [os.path.join(log, n) for n in tail]
    if snapshot:
        paths.append(os.path.join(snapshot, _EVENTS))
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def latest_events(spark: SparkSession, log: str, keys: Sequence[str], schema) -> DataFrame:
    """The latest event (by `event_seq`) of each key, from the snapshot in force and the tail."""
    snapshot, _, tail = _parts(spark, log)
    return dedup_latest(_events(spark, log, snapshot, tail, schema), keys, [F.col("event_seq").desc()])


def compact(spark: SparkSession, log: str, keys: Sequence[str], schema, due: int = DUE, keep: int = 2) -> str | None:
    """Writes a snapshot when the tail has `due` files or more; returns its folder."""
    snapshot, named, tail = _parts(spark, log)
    if len(tail) < due or not tail:
        return None
    covered = named | set(tail)
    path = os.path.join(_folder(log), f"s{len(covered)}-{uuid.uuid4().hex}")
    state = dedup_latest(_events(spark, log, snapshot, tail, schema), keys, [F.col("event_seq").desc()])
    state.write.parquet(os.path.join(path, _EVENTS))
    spark.createDataFrame([(n,) for n in sorted(covered)], "name STRING").coalesce(1).write.parquet(
        os.path.join(path, _NAMES))
    for _, old in _whole(spark, log)[: -1 - keep]:
        storage.delete(spark, old)
    return path
