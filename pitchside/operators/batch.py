"""Batch top-K over the player x club matrix without materializing it.

``mvp_all_clubs`` (top K players for every club and group) and
``mvt_all_players`` (top K clubs for every player and group) need every
score, but only K per key survive. The window form expands each player to
clubs x groups rows and sorts that expansion in every map task before its
partial limit. Here each Arrow batch of players is scored against a block of club
weights in numpy (blocks have a bounded size and ship with the task like a
broadcast) and only the candidates that can still reach the top K leave the task:
every row within the rounding step of the K-th score that the task has seen so
far, ties included.

Most cells are not scored at all. Players (for a club's best) or clubs (for a
player's best) are taken in order of their mean score, in small blocks with the
least and greatest value of each feature. The sum over the features of the greater
of both products bounds every score of the block; where it is below the running
K-th score, the block is skipped for that club (player). Bounds and scores differ
by rounding only, which a margin covers. An exact Spark window then ranks those few rows. Every block is
cut to its own top K, then the blocks are merged; no matrix is ever written.

Scores are accumulated feature by feature, left to right, with separate
multiply and add: the same IEEE operations, in the same order, as the unrolled
Spark expression, so both paths give bit-identical scores.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..schema import SCORE_SCALE
from .matrix import BLOCK_ENTRIES, club_blocks, spread, team_weights
from .topk import top_k_per_group

TIE_MARGIN = 2e-6   # > the 1e-6 rounding step used for ranking
RELATIVE_MARGIN = 1e-9   # > float noise, for scores of any magnitude
CHUNK_CELLS = 4_000_000   # players x clubs scored at once in a worker (32 MB of doubles)
BLOCK_ROWS, BLOCK_CLUBS = 512, 64   # players, clubs that share a bound
OUT_SCHEMA = "ID long, Name string, Club string, team string, grp string, score double"
OUTSIDE_SCHEMA = "team string, ID long, score double, x array<double>"
PER_PLAYER_SCHEMA = "ID long, Name string, Club string, grp string, teams array<string>, scores array<double>"


def _club_weights(teams: DataFrame, groups: Mapping[str, Sequence[str]], on_zero: str, transform: str = "reciprocal"):
    """Club names (sorted) and, per group, a features x clubs weight matrix (computed by Spark)."""
    needed = list(dict.fromkeys(f for fl in groups.values() for f in fl))
    rows = team_weights(teams, needed, on_zero, transform).orderBy("Club").collect()
    clubs = [r["Club"] for r in rows]
    mats = {}
    for g, fl in groups.items():
        mats[g] = np.array([[np.nan if r[f] is None else r[f] for r in rows] for f in fl], dtype="float64")
    return clubs, mats


def _batch_fn(clubs, mats, groups, k, reverse, per_player: bool, margin: float = TIE_MARGIN,
              chunk_cells: int = CHUNK_CELLS, stats: dict | None = None, outside: bool = False):
    """The task function. Helpers are nested so the closure pickles by value:
    executors need numpy and pandas, not this package. ``stats``: counts the scored cells (tests).
    ``outside``: a club's own players are no candidates for it, and features go along with a candidate."""
    club_arr = np.array(clubs, dtype=object)
    club_ids = np.arange(len(clubs))
    place = {c: i for i, c in enumerate(clubs)}
    block_rows, block_clubs, relative = BLOCK_ROWS, BLOCK_CLUBS, RELATIVE_MARGIN

    def scores(x, w):
        # n x clubs: sum_i x[:, i] * w[i, :], left to right.
        acc = x[:, 0:1] * w[0:1, :]
        for i in range(1, x.shape[1]):
            acc = acc + x[:, i : i + 1] * w[i : i + 1, :]
        if stats is not None:
            stats["cells"] = stats.get("cells", 0) + acc.size
        return acc

    def keyed(s):   # ascending: the best first, NaN (NULL) last
        key = s if reverse else -s
        return np.where(np.isnan(key), np.inf, key)

    def limit(kth):
        with np.errstate(invalid="ignore"):
            return kth + np.maximum(margin, relative * np.abs(kth))

    def least_key(x_lo, x_hi, w):
        """At most the key of any row between x_lo and x_hi, for each column of w."""
        a, b = x_lo[:, None] * w, x_hi[:, None] * w
        least = (np.minimum(a, b) if reverse else -np.maximum(a, b)).sum(0)
        return least - relative * np.maximum(np.abs(a), np.abs(b)).sum(0)

    def first_nulls(key, ids, out, free=True):
        """Of a line's NULL scores, the k least ids can matter."""
        nulls = np.flatnonzero(np.isinf(key) & free)
        out[~np.isinf(key)] = True
        out[nulls[np.argsort(ids[nulls], kind="stable")[:k]]] = True

    def by_club(x, w, ids, best, owner=None):
        """Rows and clubs that can be in a club's top k, scores, and the k best keys of each club so far."""
        mean = x @ np.nan_to_num(w).mean(1)
        order = np.argsort(keyed(mean), kind="stable")
        found = []
        for start in range(0, len(order), block_rows):
            rows = order[start : start + block_rows]
            xb = x[rows]
            cols = club_ids
            if len(best) == k:
                kth = best.max(axis=0)
                whole = xb[~np.isnan(xb).any(1)]
                open_ = np.isinf(kth)
                if len(whole):
                    with np.errstate(invalid="ignore"):
                        open_ |= least_key(whole.min(0), whole.max(0), w) <= limit(kth)
                cols = np.flatnonzero(open_)   # clubs with a NULL weight have no k-th score, and stay
                if not len(cols):
                    continue
            s = scores(xb, w[:, cols])
            key = keyed(s)
            free = np.ones(key.shape, dtype=bool) if owner is None else owner[rows][:, None] != cols
            key[~free] = np.inf
            merged = np.concatenate([best[:, cols], key]) if len(best) else key
            merged = np.partition(merged, k - 1, axis=0)[:k] if len(merged) > k else merged
            if len(best) == k:
                best[:, cols] = merged
            else:
                best = merged
            if len(merged) < k:
                mask = np.ones(key.shape, dtype=bool)
            else:
                kth = merged.max(axis=0)
                mask = key <= limit(kth)
                for j in np.flatnonzero(np.isinf(kth)):
                    mask[:, j] = False
                    first_nulls(key[:, j], ids[rows], mask[:, j], free[:, j])
            r, c = np.nonzero(mask & free)
            found.append((rows[r], cols[c], s[r, c]))
        parts = [np.concatenate(p) for p in zip(*found)] if found else [np.zeros(0, int), np.zeros(0, int), np.zeros(0)]
        return *parts, best

    def by_player(x, w):
        """Rows and clubs that can be in a player's top k, scores; rows ascending."""
        n = len(x)
        if len(clubs) <= k:
            s = scores(x, w)
            return np.repeat(np.arange(n), len(clubs)), np.tile(club_ids, n), s.ravel()
        some = np.flatnonzero(~np.isnan(w).any(0))   # a NULL weight gives NULL scores, which come last
        good = np.flatnonzero(~np.isnan(x).any(1))
        if len(clubs) <= block_clubs:   # one block has nothing to be held against
            s = scores(x, w)
            key = keyed(s)
            kth = np.partition(key, k - 1, axis=1)[:, k - 1]
            mask = key <= limit(kth)[:, None]
            for j in np.flatnonzero(np.isinf(kth)):
                mask[j] = False
                first_nulls(key[j], club_ids, mask[j])
            r, c = np.nonzero(mask)
            return r, c, s[r, c]
        best = np.full((n, k), np.inf)
        found = []
        if len(some) and len(good):
            some = some[np.argsort(keyed(x[good].mean(0) @ w[:, some]), kind="stable")]
            for start in range(0, len(some), block_clubs):
                cols = some[start : start + block_clubs]
                wb = w[:, cols]
                rows = good[least_key(wb.min(1), wb.max(1), x[good].T) <= limit(best[good].max(1))]
                if not len(rows):
                    continue
                s = scores(x[rows], wb)
                key = keyed(s)
                best[rows] = np.partition(np.concatenate([best[rows], key], axis=1), k - 1, axis=1)[:, :k]
                r, c = np.nonzero(key <= limit(best[rows].max(1))[:, None])
                found.append((rows[r], cols[c], s[r, c]))
        kth = best.max(1)
        short = np.flatnonzero(np.isinf(kth))   # fewer than k scores: all clubs count, and the first NULLs
        if len(short):
            s = scores(x[short], w)
            mask = np.zeros(s.shape, dtype=bool)
            for j, key in enumerate(keyed(s)):
                first_nulls(key, club_ids, mask[j])
            r, c = np.nonzero(mask)
        if not found and not len(short):
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        rows, cols, sc = (np.concatenate(p) for p in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        keep = (keyed(sc) <= limit(kth[rows])) & ~np.isinf(kth[rows])
        rows, cols, sc = rows[keep], cols[keep], sc[keep]
        if len(short):
            rows, cols, sc = np.concatenate([rows, short[r]]), np.concatenate([cols, c]), np.concatenate([sc, s[r, c]])
        order = np.argsort(rows, kind="stable")
        return rows[order], cols[order], sc[order]

    # Look at most at about ``chunk_cells`` players x clubs at a time, so a worker's
    # memory stays bounded whatever the batch size and club count. A chunk's
    # candidates are held against the best of the chunks before, which is still
    # exact (the final ranking merges them).
    rows_per_chunk = max(1, chunk_cells // max(1, len(clubs)))

    def run(batches):
        best = {g: np.zeros((0, len(clubs))) for g in groups}
        for whole in batches:
            for start in range(0, len(whole), rows_per_chunk):
                pdf = whole.iloc[start : start + rows_per_chunk]
                ids = pdf["ID"].to_numpy()
                parts = []
                for g, fl in groups.items():
                    x = pdf[list(fl)].to_numpy(dtype="float64", na_value=np.nan)
                    if per_player:
                        # One row per player: its candidate clubs and scores as arrays
                        # (NaN marks a NULL score; Spark turns it back into NULL).
                        ri, ci, sc = by_player(x, mats[g])
                        cuts = np.cumsum(np.bincount(ri, minlength=len(ids)))[:-1]
                        parts.append(pd.DataFrame({
                            "ID": ids, "Name": pdf["Name"].to_numpy(), "Club": pdf["Club"].to_numpy(), "grp": g,
                            "teams": np.split(club_arr[ci], cuts), "scores": np.split(sc, cuts),
                        }))
                        continue
                    owner = np.array([place.get(c, -1) for c in pdf["Club"]]) if outside else None
                    ri, ci, sc, best[g] = by_club(x, mats[g], ids, best[g], owner)
                    if outside:
                        parts.append(pd.DataFrame({
                            "team": club_arr[ci], "ID": ids[ri],
                            "score": pd.array(np.where(np.isnan(sc), None, sc), dtype="Float64"), "x": list(x[ri]),
                        }))
                        continue
                    parts.append(pd.DataFrame({
                        "ID": ids[ri], "Name": pdf["Name"].to_numpy()[ri], "Club": pdf["Club"].to_numpy()[ri],
                        "team": club_arr[ci], "grp": g,
                        "score": pd.array(np.where(np.isnan(sc), None, sc), dtype="Float64"),
                    }))
                if parts:
                    yield pd.concat(parts, ignore_index=True)

    return run


def _partial(base, teams, groups, k, reverse, on_zero, per_player):
    """Candidates of one block of clubs."""
    clubs, mats = _club_weights(teams, groups, on_zero)
    schema = PER_PLAYER_SCHEMA if per_player else OUT_SCHEMA
    fn = _batch_fn(clubs, mats, groups, k, reverse, per_player, chunk_cells=CHUNK_CELLS)
    return base.mapInPandas(fn, schema)


def _input(players, groups):
    needed = list(dict.fromkeys(f for fl in groups.values() for f in fl))
    return spread(players.select("ID", "Name", "Club", *needed))


def _rank_in_row(cand: DataFrame, k: int, reverse: bool, digits: int | None = SCORE_SCALE) -> DataFrame:
    """Exact top k of each row's candidate array: rounded score (NULLs last), then club name."""
    key = (lambda s: s) if digits is None else (lambda s: F.round(s, digits))
    entries = F.transform(
        F.arrays_zip("teams", "scores"),
        lambda e: F.struct(
            e["teams"].alias("team"),
            F.when(F.isnan(e["scores"]), F.lit(None).cast("double")).otherwise(e["scores"]).alias("score"),
        ),
    )

    def order(left, right):
        a, b = key(left["score"]), key(right["score"])
        both = a.isNotNull() & b.isNotNull()
        before, after = (a < b, a > b) if reverse else (a > b, a < b)
        return (F.when(a.isNull() & b.isNotNull(), F.lit(1))
                .when(a.isNotNull() & b.isNull(), F.lit(-1))
                .when(both & before, F.lit(-1))
                .when(both & after, F.lit(1))
                .when(left["team"] < right["team"], F.lit(-1))
                .when(left["team"] > right["team"], F.lit(1))
                .otherwise(F.lit(0)))

    best = F.slice(F.array_sort(entries, order), 1, k)
    return cand.select("ID", "Name", "Club", "grp", F.posexplode(best).alias("pos", "e")).select(
        "ID", "Name", "Club", F.col("e.team").alias("team"), "grp", F.col("e.score").alias("score"),
        (F.col("pos") + 1).alias("rank"),
    )


def mvp_all_clubs(players: DataFrame, teams: DataFrame, groups: Mapping[str, Sequence[str]], k: int = 10,
                  reverse: bool = False, on_zero: str = "error", n_clubs: int | None = None,
                  block_entries: int = BLOCK_ENTRIES, digits: int | None = SCORE_SCALE) -> DataFrame:
    """Top-K players for every (club, group): partial top-K per task, exact window on the survivors.

    A club belongs to one block, so the blocks' candidates are simply put together.
    """
    groups = {g: list(fl) for g, fl in groups.items()}
    base = _input(players, groups)
    parts = [_partial(base, b, groups, k, reverse, on_zero, per_player=False) for b in club_blocks(teams, len(groups), n_clubs, block_entries)]
    return top_k_per_group(reduce(DataFrame.unionByName, parts), k, ["team", "grp"], "score", ascending=reverse, round_to=digits)


def outside_candidates(players: DataFrame, weights: DataFrame, features: Sequence[str], k: int,
                       n_clubs: int | None = None, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """(team, ID, score, x): for every club of ``weights`` (Club and one weight a feature), the players of other
    clubs whose weighted sum can be among its K best. Every task's K best and those within the rounding step
    are there, ties included; where a task has fewer than K scores, also the least ids without one. ``x`` holds
    the features (NaN for NULL). Players without a club are no candidates.
    """
    base = _input(players.where(F.col("Club").isNotNull()), {"W": features})
    parts = []
    for block in club_blocks(weights, 1, n_clubs, block_entries):
        clubs, mats = _club_weights(block, {"W": features}, "null", "identity")
        parts.append(base.mapInPandas(_batch_fn(clubs, mats, {"W": list(features)}, k, False, False, chunk_cells=CHUNK_CELLS, outside=True), OUTSIDE_SCHEMA))
    return reduce(DataFrame.unionByName, parts)


def mvt_all_players(players: DataFrame, teams: DataFrame, groups: Mapping[str, Sequence[str]], k: int = 10,
                    reverse: bool = False, on_zero: str = "error", n_clubs: int | None = None,
                    block_entries: int = BLOCK_ENTRIES, digits: int | None = SCORE_SCALE) -> DataFrame:
    """Top-K clubs for every (player, group).

    All clubs of a block are scored in the same batch, so the task emits one row
    per (player, group) with its candidate clubs as arrays, and the exact ranking
    (Spark's rounding, NULLs last, club name on ties) happens inside the row with
    ``array_sort``: no shuffle. Several blocks are merged by one window over at
    most K rows a block.
    """
    groups = {g: list(fl) for g, fl in groups.items()}
    base = _input(players, groups)
    parts = [_rank_in_row(_partial(base, b, groups, k, reverse, on_zero, per_player=True), k, reverse, digits)
             for b in club_blocks(teams, len(groups), n_clubs, block_entries)]
    if len(parts) == 1:
        return parts[0]
    return top_k_per_group(reduce(DataFrame.unionByName, parts).drop("rank"), k, ["ID", "grp"], "score", ascending=reverse, tiebreak=("team",), round_to=digits)
