"""Broadcast only what has been sized."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bound of a broadcast side, by its rows and the width of its columns.
MAX_BROADCAST_BYTES = 64 << 20

#: Frames that sizing has persisted, until ``release``.
_KEPT: list[DataFrame] = []


def row_bytes(df: DataFrame) -> int:
    """The width of a row: 8 bytes a number, 64 a string, 16 for itself."""
    return 16 + sum(64 if f.dataType.typeName() in ("string", "binary") else 8 for f in df.schema)


def bounded(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Materialise ``df``, count it, and mark it for broadcast only when
    its size is within ``max_bytes``.

    Above the bound the frame is returned unmarked and the join falls back
    to a shuffle join (adaptive execution may still choose a broadcast
    from the measured size).  The persisted copy is recomputed from its
    lineage if an executor holding it is lost, and given up by ``release``.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(kept)
    return F.broadcast(kept) if kept.count() * row_bytes(kept) <= max_bytes else kept


def keep(df: DataFrame) -> DataFrame:
    """Persist until ``release``."""
    _KEPT.append(df.persist(StorageLevel.MEMORY_AND_DISK))
    return _KEPT[-1]


def release() -> None:
    """Unpersist everything that building queries has persisted."""
    while _KEPT:
        _KEPT.pop().unpersist()


def attach(df: DataFrame, small: DataFrame, keys) -> DataFrame:
    """Add the columns of a small per-key table to every row of ``df``.

    With keys: a counted broadcast join on them.  Without keys ``small``
    has one row, attached through one scalar subquery (no join at all).
    """
    keys = list(keys)
    if keys:
        return df.join(bounded(small), keys)
    cols = small.columns
    one = small.select(F.struct(*cols).alias("__one")).scalar()
    return df.select("*", one.alias("__one")).select(*df.columns, *[F.col(f"__one.{c}").alias(c) for c in cols])
