"""Top-K helpers: deterministic order (rounded score, then id) and bounded work.

* ``top_k``: ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``:
  each partition keeps its own k best, only k rows per partition reach the
  final merge.
* ``top_k_per_group``: ``row_number() <= k`` over a window; Spark inserts a
  partial ``WindowGroupLimit`` before the shuffle, so even a group holding a
  third of all rows sends at most k rows per map partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import col, rounded


def sort_keys(by, ascending: bool = False, tiebreak: Sequence = ("ID",), round_to: int | None = 6) -> list[Column]:
    """Score key first (NULLs last either way), then ascending tie-breakers."""
    key = rounded(by, round_to) if round_to is not None else col(by)
    first = key.asc_nulls_last() if ascending else key.desc_nulls_last()
    return [first] + [col(t).asc_nulls_last() for t in tiebreak]


def top_k(df: DataFrame, k: int | None, by, ascending: bool = False, tiebreak: Sequence = ("ID",),
          rank_col: str | None = "rank", round_to: int | None = 6) -> DataFrame:
    """The k best rows by ``by``; ``k=None`` keeps every row (sorted, no rank)."""
    keys = sort_keys(by, ascending, tiebreak, round_to)
    if k is None:
        return df.orderBy(*keys)
    if k < 0:
        raise ValueError("k must be >= 0")
    limited = df.orderBy(*keys).limit(k)
    if rank_col is None:
        return limited
    # At most k rows reach this window.
    return limited.withColumn(rank_col, F.row_number().over(Window.orderBy(*keys)))


def top_k_per_group(df: DataFrame, k: int, partition_by: Sequence, by, ascending: bool = False,
                    tiebreak: Sequence = ("ID",), rank_col: str = "rank", round_to: int | None = 6) -> DataFrame:
    keys = sort_keys(by, ascending, tiebreak, round_to)
    w = Window.partitionBy(*[col(p) for p in partition_by]).orderBy(*keys)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
