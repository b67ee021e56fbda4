"""Join helpers.

Broadcasting is only done behind a size check: the side is materialised once
on shared storage, the same job adds up its bytes (one number per partition),
and it is broadcast only under the limit.  Past the limit the join is left to the
planner (sort-merge, with AQE skew splitting of hot keys).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .materialize import checkpointed

# Bytes a dimension may hold and still be broadcast.
DEFAULT_BROADCAST_BYTES = 64 << 20
# Counted for every value besides a text's own bytes.
VALUE_BYTES = 16


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: each value's text form and VALUE_BYTES."""
    row = F.lit(0)
    for name in df.columns:
        row = row + VALUE_BYTES + F.coalesce(F.octet_length(df[name].cast("string")), F.lit(0))
    return row.cast("long")


def held_bytes(df: DataFrame) -> int:
    """Bytes of the rows, summed where the rows are."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written to the shared checkpoint folder, and the bytes of its rows, observed by the job that writes
    them (no second job reads the copy)."""
    seen = Observation()
    fixed = checkpointed(df.observe(seen, F.sum(row_bytes(df)).alias("bytes")))
    return fixed, seen.get["bytes"] or 0


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``df`` materialised, hinted for broadcast only if it holds at most
    ``max_bytes``; otherwise returned un-hinted."""
    # A frame whose rows sit in the plan itself (built from driver-side rows)
    # is already materialised; anything else is written out once.
    fixed, size = (df, held_bytes(df)) if df.isLocal() else measured(df)
    return F.broadcast(fixed) if size <= max_bytes else fixed


def bounded_broadcasts(*dfs: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> list[DataFrame]:
    """``bounded_broadcast`` of several independent sides, checked as
    concurrent jobs (the checks are small; their latency adds up)."""
    if len(dfs) < 2:
        return [bounded_broadcast(df, max_bytes) for df in dfs]
    with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
        return list(pool.map(lambda df: bounded_broadcast(df, max_bytes), dfs))


def trimmed_keys(left: DataFrame, right: DataFrame, pairs) -> Column:
    """Equi-join condition on space-trimmed keys; Catalyst extracts the trimmed
    expressions as hash / sort keys on both sides.  A right key that is a Column is taken as trimmed."""
    cond = None
    for lk, rk in pairs:
        c = F.trim(left[lk]) == (rk if isinstance(rk, Column) else F.trim(right[rk]))
        cond = c if cond is None else cond & c
    return cond
