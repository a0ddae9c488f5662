"""Player x club scores: score(p, c) = sum over a feature list of p[f] / c[f].

Single-target queries (one club, one player) read that one row first (a
bounded one-row action) and score against its values as literals: no join,
no shuffle, filter pushed to the scan. The full matrix (and the window form
of the batch top-K; the default batch form is in ``batch.py``) expands each
player over an array of club weights: output is players x clubs rows, linear in
players, computed in one codegen'd projection per player. Clubs that fit one block
are inlined (a scalar subquery). More go in hash blocks of a bounded size and are
multiplied as a grid: players are cut into row blocks, each side is repeated along
the other's axis only, and a cell (row block, club block) is one key of one join.
The plan reads both tables once, whatever the number of clubs, and nothing is written.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import position_group, reciprocal, weighted_sum
from ..schema import FEATURES, SCORE_SCALE, normalize_group
from .targets import pick_club, pick_player, row_literals
from .topk import top_k, top_k_per_group

BLOCK_ENTRIES = 50_000   # clubs x groups of one block (about 12 MB of weights at 29 features)
CELLS = 4   # cells of the grid a shuffle partition, at least


def team_weights(teams: DataFrame, features: Sequence[str] = FEATURES, on_zero: str = "error",
                 transform: str = "reciprocal", club_col: str = "Club") -> DataFrame:
    """Club plus one weight per feature: 1/mean (``reciprocal``) or the mean itself (``identity``)."""
    return teams.select(F.col(club_col), *[weight(f, on_zero, transform).alias(f) for f in features])


def weight(feature: str, on_zero: str = "error", transform: str = "reciprocal") -> Column:
    if transform == "reciprocal":
        return reciprocal(feature, on_zero)
    if transform == "identity":
        return F.col(feature).cast("double")
    raise ValueError(transform)


def club_scores(players: DataFrame, teams: DataFrame, club: str, features: Sequence[str],
                group_label: str, on_zero: str = "error", transform: str = "reciprocal",
                strict: bool = False) -> DataFrame:
    """Every player scored for one club: (ID, Name, Club, team, grp, score)."""
    w_row = team_weights(pick_club(teams, club), features, on_zero, transform)
    w, found = row_literals(w_row, features, strict, f"club {club!r}")
    present = F.lit(found)
    return players.where(present).select(
        F.col("ID"), F.col("Name"), F.col("Club"),
        F.lit(club).alias("team"),
        F.lit(group_label).alias("grp"),
        weighted_sum(features, [w[f] for f in features]).alias("score"),
    )


def player_scores(players: DataFrame, teams: DataFrame, features: Sequence[str], group_label: str,
                  player_id=None, name: str | None = None, on_zero: str = "error",
                  strict: bool = False) -> DataFrame:
    """One player scored for every club: (ID, Name, Club, team, grp, score)."""
    target = pick_player(players, player_id, name)
    v, found = row_literals(target, ["ID", "Name", "Club", *features], strict, "player")
    present = F.lit(found)
    weights = team_weights(teams, features, on_zero)
    return weights.where(present).select(
        v["ID"].alias("ID"),
        v["Name"].alias("Name"),
        v["Club"].alias("Club"),
        F.col("Club").alias("team"),
        F.lit(group_label).alias("grp"),
        weighted_sum([v[f] for f in features], features).alias("score"),
    )


def mvp_for_team(players, teams, club, features, group_label, k=10, reverse=False, on_zero="error",
                 eligible_group: str | None = None, exclude_own: bool = False, strict: bool = False,
                 digits: int | None = SCORE_SCALE):
    """K most (``reverse=True``: least) valued players for a club.

    Like the reference, every player is a candidate whatever his position;
    ``eligible_group`` keeps only players of one position group and
    ``exclude_own`` leaves out the club's own players. Scores that agree to
    ``digits`` decimals are ties (by id); None ranks the raw scores.
    """
    pool = players
    if eligible_group is not None:
        pool = pool.where(position_group("Position") == F.lit(normalize_group(eligible_group)))
    if exclude_own:
        pool = pool.where(~F.col("Club").eqNullSafe(F.lit(club)))
    scored = club_scores(pool, teams, club, features, group_label, on_zero, strict=strict)
    return top_k(scored, k, "score", ascending=reverse, round_to=digits)


def mvt_for_player(players, teams, features, group_label, player_id=None, name=None, k=10,
                   reverse=False, on_zero="error", strict: bool = False, digits: int | None = SCORE_SCALE):
    """K most (least) valued clubs for a player; ``k=None`` lists every club."""
    scored = player_scores(players, teams, features, group_label, player_id, name, on_zero, strict)
    return top_k(scored, k, "score", ascending=reverse, tiebreak=("team",), round_to=digits)


def worst_in_club(players, teams, club, group, features, on_zero="error", digits: int | None = SCORE_SCALE):
    """A club's own players of one position group, lowest score first (no limit)."""
    label = normalize_group(group)
    own = players.where((F.col("Club") == F.lit(club)) & (position_group("Position") == F.lit(label)))
    scored = club_scores(own, teams, club, features, label, on_zero)
    return top_k(scored, None, "score", ascending=True, round_to=digits)


def lvp_from_list(players, teams, club, ids: Sequence[int] = (), features=FEATURES, on_zero="error",
                  digits: int | None = SCORE_SCALE):
    """The lowest-scored player among ``ids`` for a club on all features; empty list = all players."""
    pool = players.where(F.col("ID").isin(list(ids))) if ids else players
    scored = club_scores(pool, teams, club, features, "ALL", on_zero)
    return top_k(scored, 1, "score", ascending=True, round_to=digits)


# ---------------------------------------------------------------------------
# The full matrix and its batch top-K forms.
# ---------------------------------------------------------------------------

def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of an expanding operator's input over all cores.

    Each player row fans out to clubs x groups score rows, so the shuffle of the
    narrow input is small against the output whatever its size. The number of
    partitions follows the session (cores, ``spark.sql.shuffle.partitions``);
    the input's plan is not run to find it.
    """
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def club_blocks(teams: DataFrame, n_groups: int, n_clubs: int | None = None, block_entries: int = BLOCK_ENTRIES) -> list[DataFrame]:
    """The clubs in hash blocks of about ``block_entries`` clubs x groups; one count if the number isn't known."""
    n_clubs = teams.count() if n_clubs is None else n_clubs
    blocks = max(1, math.ceil(n_clubs * n_groups / block_entries))
    return [teams.where(F.pmod(F.xxhash64("Club"), F.lit(blocks)) == b) for b in range(blocks)] if blocks > 1 else [teams]


def _weight_rows(teams: DataFrame, groups: Mapping[str, Sequence[str]], on_zero: str, transform: str) -> DataFrame:
    """(e: struct<team, grp, w0, w1, ...>) for every club and group; one read of the clubs."""
    width = max(len(f) for f in groups.values())
    entries = []
    for label, features in groups.items():
        ws = [weight(f, on_zero, transform).alias(f"w{i}") for i, f in enumerate(features)]
        ws += [F.lit(None).cast("double").alias(f"w{i}") for i in range(len(ws), width)]
        entries.append(F.struct(F.col("Club").alias("team"), F.lit(label).alias("grp"), *ws))
    return teams.select(F.explode(F.array(*entries)).alias("e"))


def _scored(expanded: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """(ID, Name, Club, team, grp, score) of rows that hold a player and one weight row."""
    score = None
    for g, fl in groups.items():
        s = weighted_sum(fl, [f"w{i}" for i in range(len(fl))])
        score = F.when(F.col("grp") == g, s) if score is None else score.when(F.col("grp") == g, s)
    return expanded.select("ID", "Name", "Club", "team", "grp", score.alias("score"))


def _grid(base: DataFrame, weight_rows: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``base`` beside every weight row, by cells (row block, club block).

    There are ``CELLS`` cells a shuffle partition at least. A cell holds one array of
    weights, about one block; its players stream past it. A row's block follows from
    its content, so a repeated task sends the same rows to the same cells.
    """
    spark = base.sparkSession
    partitions = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    row_blocks = max(1, math.ceil(CELLS * partitions / blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    clubs = weight_rows.groupBy(F.pmod(F.xxhash64("e.team"), F.lit(blocks)).alias("__club_block")).agg(F.collect_list("e").alias("__weights"))
    clubs = clubs.select("__club_block", "__weights", every(row_blocks).alias("__row_block"))
    rows = base.select("*", F.pmod(F.xxhash64(*base.columns), F.lit(row_blocks)).alias("__row_block"), every(blocks).alias("__club_block"))
    return rows.join(clubs, ["__row_block", "__club_block"]).select(*base.columns, F.inline("__weights"))


def matrix_scores(players: DataFrame, teams: DataFrame, groups: Mapping[str, Sequence[str]],
                  on_zero: str = "error", transform: str = "reciprocal",
                  block_entries: int = BLOCK_ENTRIES, n_clubs: int | None = None) -> DataFrame:
    """Long matrix (ID, Name, Club, team, grp, score) for every player, club and group, lazy.

    The number of clubs is counted first (teams is a small materialized table;
    a caller that already knows the count passes ``n_clubs``). Up to
    ``block_entries`` clubs x groups, the weights travel with the stage (in the task
    binary, fetched once per executor); more are joined as a grid of blocks.
    """
    groups = dict(groups)
    needed = list(dict.fromkeys(f for fl in groups.values() for f in fl))
    base = players.select("ID", "Name", "Club", *needed)
    rows = _weight_rows(teams, groups, on_zero, transform)
    n_clubs = teams.count() if n_clubs is None else n_clubs
    blocks = math.ceil(n_clubs * len(groups) / block_entries)
    if blocks > 1:
        return _scored(_grid(base, rows, blocks), groups)
    weights = rows.agg(F.collect_list("e").alias("a")).select("a").scalar()
    return _scored(spread(base).select("*", F.inline(weights)), groups)


def mvp_all_clubs(players, teams, groups, k=10, reverse=False, on_zero="error", n_clubs=None, digits=SCORE_SCALE):
    """Top-K players for every (club, group)."""
    m = matrix_scores(players, teams, groups, on_zero, n_clubs=n_clubs)
    return top_k_per_group(m, k, ["team", "grp"], "score", ascending=reverse, round_to=digits)


def mvt_all_players(players, teams, groups, k=10, reverse=False, on_zero="error", n_clubs=None, digits=SCORE_SCALE):
    """Top-K clubs for every (player, group)."""
    m = matrix_scores(players, teams, groups, on_zero, n_clubs=n_clubs)
    return top_k_per_group(m, k, ["ID", "grp"], "score", ascending=reverse, tiebreak=("team",), round_to=digits)


def raw_dot(players, teams, features=FEATURES):
    """Player x club dot product with the club means (no reciprocal)."""
    return matrix_scores(players, teams, {"RAW": list(features)}, transform="identity")
