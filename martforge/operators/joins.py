"""Dimension joins with a checked broadcast (JN-1..3 building block).

A dimension is broadcast only when (a) the caller proves a fixed bound on
its size (``bounded=True``, e.g. the 25-row nation table), or (b) the
optimizer's size estimate of the *pruned* dimension is below a limit.
Beyond the limit the join stays a shuffle join; with adaptive execution
on, Spark may still turn it into a broadcast join once real sizes are
known, and splits hot keys of the large side (skew join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def _parse_bytes(text: str) -> int:
    t = text.strip().lower()
    for suffix in sorted(_UNITS, key=len, reverse=True):
        if t.endswith(suffix) and t[: -len(suffix)].strip().lstrip("-").isdigit():
            return int(t[: -len(suffix)]) * _UNITS[suffix]
    return int(t)


def broadcast_limit(df: DataFrame) -> int:
    """Session's broadcast threshold in bytes (-1: broadcasts disabled)."""
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b")
    try:
        return _parse_bytes(raw)
    except ValueError:
        return 10 << 20


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan, or None if unknown."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return size if isinstance(size, int) else int(size.toString())
    except Exception:
        return None


# Estimates of file scans are on-disk (compressed, encoded) sizes; a
# broadcast hash relation of the same rows is several times larger.  The
# estimate times this factor must fit the limit.
BROADCAST_HEADROOM = 4


def small_enough(df: DataFrame, max_bytes: int | None = None,
                 headroom: int = BROADCAST_HEADROOM, size: int | None = None) -> bool:
    """True when the estimated size (or ``size``; times ``headroom``) is within the limit
    (the session's broadcast threshold unless ``max_bytes`` is given)."""
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    if limit < 0:
        return False
    size = estimated_bytes(df) if size is None else size
    return size is not None and size * headroom <= limit


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   bounded: bool = False, max_broadcast_bytes: int | None = None,
                   size: int | None = None) -> DataFrame:
    """``fact`` ⋈ ``dim``; broadcast ``dim`` only behind a size check (of ``size``
    bytes, where the caller measured them)."""
    if bounded or small_enough(dim, max_broadcast_bytes, size=size):
        dim = F.broadcast(dim)
    return fact.join(dim, on, how)
