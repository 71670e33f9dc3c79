"""Size-checked broadcast.

A side is broadcast only after a bounded probe proves it small: reading at most
``max_rows + 1`` rows costs one short job, and the answer is remembered per
DataFrame. Beyond the bound the plain join is kept, so Catalyst/AQE choose a
shuffle join (and AQE may still demote it at runtime from real statistics).
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (id, bound) -> answer; an entry is dropped when its frame is collected, so a
# reused id never sees a stale answer and the cache does not keep plans alive
_PROBED: dict[tuple[int, int], bool] = {}


def is_small(df: DataFrame, max_rows: int) -> bool:
    key = (id(df), max_rows)
    if key not in _PROBED:
        _PROBED[key] = df.limit(max_rows + 1).count() <= max_rows
        weakref.finalize(df, _PROBED.pop, key, None)
    return _PROBED[key]


def checked_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """broadcast(df) if it has at most max_rows rows, else df unchanged."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def literal_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a frame built from driver-side literals (config seeds, the
    chart of accounts): its size is fixed by construction, not by the data."""
    return F.broadcast(df)
