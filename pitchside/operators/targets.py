"""One-row targets (one club, one player).

Scoring every player against ONE club, or every club against ONE player,
needs that single row's values in every task; no join is needed for that.
``row_literals`` reads the row once (a bounded one-row action) and returns
typed literals; ``row_values`` keeps it lazy as one struct-valued scalar
subquery, for values that must stay inside the plan (e.g. a vector column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def row_values(one_row: DataFrame, columns: Sequence[str]) -> tuple[dict[str, Column], Column]:
    """({column: scalar value}, present) for a DataFrame holding at most one row.

    ``present`` is a boolean Column, true when the row exists; filter on it so
    an unknown club or player gives an empty result instead of NULL scores.
    """
    agg = one_row.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.max(c).alias(c) for c in columns],
    )
    # One struct-valued subquery; every value is a field of it, so the
    # subquery is planned and run once however many places use it.
    row = agg.select(F.struct(*agg.columns).alias("r")).scalar()
    values = {c: row.getField(c) for c in columns}
    return values, row.getField("__n") == F.lit(1)


def row_literals(one_row: DataFrame, columns: Sequence[str], strict: bool = False,
                 what: str = "target") -> tuple[dict[str, Column], bool]:
    """({column: literal}, present) from a DataFrame holding at most one row.

    One small job reads the row (at most 2 rows are fetched, to reject an
    ambiguous target); its values become typed literals, so the scoring plan
    that uses them is a plain scan + projection that Catalyst can
    constant-fold. This is what a scalar subquery does at run time, without
    carrying the subquery plan into every expression that uses a value.
    A missing row gives NULL values and ``present=False`` (callers return an
    empty result), or raises ``ValueError`` with ``strict=True``.
    """
    picked = one_row.select(*columns)
    rows = picked.limit(2).collect()
    if len(rows) > 1:
        raise ValueError("target is not unique")
    types = dict((f.name, f.dataType) for f in picked.schema.fields)
    if not rows:
        if strict:
            raise ValueError(f"unknown {what}")
        return {c: F.lit(None).cast(types[c]) for c in columns}, False
    return {c: F.lit(rows[0][c]).cast(types[c]) for c in columns}, True


def pick_player(players: DataFrame, player_id=None, name: str | None = None, id_col: str = "ID",
                name_col: str = "Name") -> DataFrame:
    """One player by id, or by name (lowest id wins among duplicate names)."""
    if player_id is not None:
        return players.where(F.col(id_col) == F.lit(player_id))
    if name is not None:
        return players.where(F.col(name_col) == F.lit(name)).orderBy(F.col(id_col)).limit(1)
    raise ValueError("give a player id or a player name")


def pick_club(teams: DataFrame, club: str, club_col: str = "Club") -> DataFrame:
    return teams.where(F.col(club_col) == F.lit(club))


#: Input of an operator that expands its rows: up to so many bytes are dealt out to all cores.
SMALL_BYTES = 64 << 20


def spread_small(df: DataFrame) -> DataFrame:
    """``df``, dealt out to all cores if the plan's size estimate is small: one small file is one task else.

    Larger inputs have enough splits and aren't moved. The estimate is the
    optimizer's; no job is run for it.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SMALL_BYTES else df
