"""Projections, point lookups and row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import position_group
from ..schema import CARD, FEATURES
from .targets import pick_player


def project_features(players: DataFrame, features: Sequence[str] = FEATURES, id_col: str = "ID") -> DataFrame:
    return players.select(id_col, *features)


def col_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Column names from ``first`` to ``last``, both included, in table order."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    if j < i:
        raise ValueError(f"{last!r} comes before {first!r}")
    return cols[i : j + 1]


def project_range(df: DataFrame, first: str, last: str, keep: Sequence[str] = ("ID",)) -> DataFrame:
    return df.select(*keep, *[c for c in col_range(df, first, last) if c not in keep])


def project_ordinal(df: DataFrame, position: int, keep: Sequence[str] = ()) -> DataFrame:
    """One column picked by its 0-based position in the table."""
    return df.select(*keep, df.columns[position])


def unpivot_features(teams: DataFrame, features: Sequence[str] = FEATURES, key: str = "Club") -> DataFrame:
    """Features as rows: (key, feature, value)."""
    return teams.unpivot([key], list(features), "feature", "value")


def lookup_player(players: DataFrame, player_id=None, name: str | None = None,
                  card: Sequence[str] = CARD) -> DataFrame:
    """The player card for one id (or the lowest id carrying ``name``)."""
    return pick_player(players, player_id, name).select(*card)


def club_in_list(players: DataFrame, clubs: Sequence[str], columns: Sequence[str] = ("ID", "Name", "Club", "Age", "Overall")) -> DataFrame:
    return players.where(F.col("Club").isin(list(clubs))).select(*columns)


def club_filter(players: DataFrame, clubs: Sequence[str], masks: Sequence[str] = ("Age",), parity: bool = False,
                columns: Sequence[str] = ("ID", "Name", "Club", "Age", "Overall")) -> DataFrame:
    """Rows of the listed clubs, further masked by integer columns.

    ``parity=True`` reproduces the reference's mask ``isin & col``, a bitwise
    AND that keeps only odd values; the default keeps non-missing values,
    the evident intent.
    """
    cond = F.col("Club").isin(list(clubs))
    for m in masks:
        cond = cond & ((F.col(m).bitwiseAND(F.lit(1)) == 1) if parity else F.col(m).isNotNull())
    return players.where(cond).select(*columns)


def with_group(players: DataFrame, position: str = "Position", out: str = "GroupPosition") -> DataFrame:
    return players.withColumn(out, position_group(position))


def select_ids(players: DataFrame, ids: Sequence[int] | DataFrame, strict: bool = False) -> DataFrame:
    """Rows whose id is in ``ids``, a list (pushed to the scan) or a DataFrame with a column ``ID`` (left semi-join).

    ``strict=True`` raises when some id of a list is missing.
    """
    if isinstance(ids, DataFrame):
        return players.join(ids.select("ID"), "ID", "left_semi")
    picked = players.where(F.col("ID").isin(list(ids)))
    if strict:
        found = {r["ID"] for r in picked.select("ID").collect()}
        missing = sorted(set(ids) - found)
        if missing:
            raise KeyError(f"unknown ids: {missing}")
    return picked
