"""Replace mode: a club's weak features, the weight vector they induce, the
club's players ranked on those features, and the best outside replacements.

The club's row (weak flags and weights) is read once, a bounded one-row
action, and enters the plans as literals. In replace mode the rest is one
lazy plan: the players are scanned once for the weak players (at most 10,
inlined as an array) and once for the candidates.

Replace mode ranks pairs (weak player p, candidate c) by
sum((c_i - p_i) * w_i) = c.w - p.w. For fixed w the candidate order is the
same for every p, so the global top K pairs use only candidates whose c.w is
within a rounding tolerance of the K-th best c.w: we keep exactly those (all
ties included, no cap), pair them with the <= 10 weak players and rank the
fused value, which is what we report.

``replace_all_clubs`` does the same for every club at once: the weights and weak
players of all clubs are two tables, the candidates of all clubs come from one pass
over the players (``batch.outside_candidates``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import improvement, total, weighted_sum
from ..schema import FEATURES, MAX_WEAK_PLAYERS, WEAK_DIVISOR, WEAK_WEIGHT_FACTOR, WEIGHT_TOTAL
from .batch import outside_candidates
from .targets import pick_club, pick_player, row_literals
from .topk import sort_keys, top_k, top_k_per_group

RANK_TOLERANCE = 1e-5   # > the 1e-6 score rounding step plus float noise
RELATIVE_TOLERANCE = 1e-9   # > float noise, for scores of any magnitude


def _values_array(features: Sequence[str]) -> Column:
    return F.array(*[F.col(f).cast("double") for f in features])


def weak_threshold(features: Sequence[str] = FEATURES) -> Column:
    """sorted(values)[n // 4]: the value at 0-based position n // 4 of the sorted row."""
    return F.element_at(F.sort_array(_values_array(features)), len(features) // WEAK_DIVISOR + 1)


def weak_flags(teams: DataFrame, features: Sequence[str] = FEATURES, club_col: str = "Club") -> DataFrame:
    """Club, threshold, weak count, and one boolean column per feature (strictly below the threshold)."""
    thr = weak_threshold(features)
    flags = [(F.col(f) < F.col("threshold")).alias(f) for f in features]
    with_thr = teams.select(F.col(club_col).alias("Club"), *features, thr.alias("threshold"))
    out = with_thr.select("Club", "threshold", *flags)
    return out.withColumn("n_weak", total([F.col(f).cast("int") for f in features]))


def weak_features(teams: DataFrame, club: str | None = None, features: Sequence[str] = FEATURES) -> DataFrame:
    """(Club, idx, feature, value, threshold) for every weak feature; one club or all."""
    t = teams if club is None else pick_club(teams, club)
    arr = _values_array(features)
    names = F.array(*[F.lit(f) for f in features])
    exploded = t.select(
        "Club", weak_threshold(features).alias("threshold"),
        F.posexplode(arr).alias("idx", "value"),
    )
    return (
        exploded.where(F.col("value") < F.col("threshold"))
        .select("Club", "idx", F.element_at(names, F.col("idx") + 1).alias("feature"), "value", "threshold")
    )


def weight_vector(teams: DataFrame, club: str | None = None, features: Sequence[str] = FEATURES) -> DataFrame:
    """(Club, idx, feature, weak, weight): base = 10 / (n + k), weak features 2 * base; totals 10."""
    t = teams if club is None else pick_club(teams, club)
    f = weak_flags(t, features)
    base = F.lit(WEIGHT_TOTAL) / (F.lit(len(features)) + F.col("n_weak"))
    names = F.array(*[F.lit(x) for x in features])
    exploded = f.select("Club", base.alias("base"), F.posexplode(F.array(*[F.col(x) for x in features])).alias("idx", "weak"))
    return exploded.select(
        "Club", "idx", F.element_at(names, F.col("idx") + 1).alias("feature"), "weak",
        F.when(F.col("weak"), F.lit(WEAK_WEIGHT_FACTOR) * F.col("base")).otherwise(F.col("base")).alias("weight"),
    )


def _club_plan(teams: DataFrame, club: str, features: Sequence[str]):
    """Scalar values of one club: weak flags and weights per feature, plus a presence flag."""
    flags = weak_flags(pick_club(teams, club), features)
    base = F.lit(WEIGHT_TOTAL) / (F.lit(len(features)) + F.col("n_weak"))
    cols = [F.col(f).alias(f"weak_{f}") for f in features]
    cols += [F.when(F.col(f), F.lit(WEAK_WEIGHT_FACTOR) * base).otherwise(base).alias(f"w_{f}") for f in features]
    row = flags.select(*cols)
    values, found = row_literals(row, [f"weak_{f}" for f in features] + [f"w_{f}" for f in features])
    present = F.lit(found)
    weak = [values[f"weak_{f}"] for f in features]
    weights = [values[f"w_{f}"] for f in features]
    return weak, weights, present


def weak_players(players: DataFrame, teams: DataFrame, club: str, k: int | None = MAX_WEAK_PLAYERS,
                 ascending: bool = False, features: Sequence[str] = FEATURES) -> DataFrame:
    """The club's players ranked by the sum of their weak-feature values.

    ``ascending=False`` (default) follows the reference, which sorts this sum
    descending; ``ascending=True`` gives the truly weakest players.
    """
    weak, _, present = _club_plan(teams, club, features)
    weak_sum = total([F.when(w, F.col(f)).otherwise(F.lit(0.0)) for w, f in zip(weak, features)])
    own = players.where((F.col("Club") == F.lit(club)) & present)
    scored = own.select("ID", "Name", "Club", weak_sum.alias("weak_sum"))
    return top_k(scored, k, "weak_sum", ascending=ascending)


def best_replacements(players: DataFrame, teams: DataFrame, club: str, player_id, k: int = 3,
                      features: Sequence[str] = FEATURES) -> DataFrame:
    """Top-K players outside the club by improvement over one player, weighted by the club's weak features."""
    _, weights, present = _club_plan(teams, club, features)
    current, p_found = row_literals(pick_player(players, player_id), features)
    p_present = F.lit(p_found)
    candidates = players.where((F.col("Club") != F.lit(club)) & present & p_present)
    scored = candidates.select(
        F.lit(player_id).cast("long").alias("player_id"),
        F.col("ID").alias("replacement_id"),
        improvement(features, [current[f] for f in features], weights).alias("improvement"),
    )
    return top_k(scored, k, "improvement", tiebreak=("replacement_id",))


def replace_mode(players: DataFrame, teams: DataFrame, club: str, k: int = 3,
                 features: Sequence[str] = FEATURES, n_weak_players: int = MAX_WEAK_PLAYERS) -> DataFrame:
    """(player_id, replacement_id, improvement, rank): the best K swaps over the club's weak players."""
    weak, weights, present = _club_plan(teams, club, features)

    # The club's first players on the weak-feature sum (reference order: descending).
    weak_sum = total([F.when(w, F.col(f)).otherwise(F.lit(0.0)) for w, f in zip(weak, features)])
    own = players.where((F.col("Club") == F.lit(club)) & present).select("ID", *features, weak_sum.alias("weak_sum"))
    worst = top_k(own, n_weak_players, "weak_sum", rank_col="wrank")
    worst_arr = worst.agg(
        F.collect_list(F.struct(F.col("ID").alias("player_id"), F.col("wrank"),
                                *[F.col(f).alias(f"p_{f}") for f in features])).alias("a")
    ).select("a").scalar()

    # Candidates outside the club, scored on the separable part c.w.
    cands = players.where((F.col("Club") != F.lit(club)) & present).select(
        F.col("ID").alias("replacement_id"), *features,
        weighted_sum(features, weights).alias("cw"),
    )
    best = top_k(cands, k, "cw", tiebreak=("replacement_id",), rank_col=None, round_to=None) \
        .agg(F.struct(F.min("cw").alias("kth"), F.count("cw").alias("nn"), F.max(F.abs("cw")).alias("top")).alias("s")).select("s").scalar()
    # Pairs without a score rank last, by weak player and replacement id. A weak player with a NULL feature has no score with
    # anyone, so the k least ids of all can come forward; candidates without a score only where fewer than k have one.
    low = cands.select("replacement_id").orderBy("replacement_id").limit(k).agg(F.max("replacement_id").alias("m")).select("m").scalar()
    survivors = cands.where(
        (F.col("cw") >= best.getField("kth") - F.greatest(F.lit(RANK_TOLERANCE), F.lit(RELATIVE_TOLERANCE) * best.getField("top")))
        | (F.col("replacement_id") <= low)
        | (F.col("cw").isNull() & (best.getField("nn") < F.lit(k)))
    )

    pairs = survivors.select("replacement_id", *features, F.inline(worst_arr))
    scored = pairs.select(
        "player_id", "replacement_id", "wrank",
        improvement(features, [f"p_{f}" for f in features], weights).alias("improvement"),
    )
    return top_k(scored, k, "improvement", tiebreak=("wrank", "replacement_id")).drop("wrank")


def _club_weights(teams: DataFrame, features: Sequence[str]) -> DataFrame:
    """(Club, weak array<boolean>, w array<double>) for every club; all weights are NULL where a mean is."""
    t = teams.where(F.col("Club").isNotNull()).select("Club", _values_array(features).alias("v"), weak_threshold(features).alias("threshold"))
    t = t.select("Club", F.transform("v", lambda x: x < F.col("threshold")).alias("weak"))
    count = F.when(~F.exists("weak", lambda x: x.isNull()), F.size(F.filter("weak", lambda x: x)))
    t = t.select("Club", "weak", (F.lit(WEIGHT_TOTAL) / (F.lit(len(features)) + count)).alias("base"))
    return t.select("Club", "weak", F.transform("weak", lambda x: F.when(x, F.lit(WEAK_WEIGHT_FACTOR) * F.col("base")).otherwise(F.col("base"))).alias("w"))


def replace_all_clubs(players: DataFrame, teams: DataFrame, k: int = 3, features: Sequence[str] = FEATURES,
                      n_weak_players: int = MAX_WEAK_PLAYERS, n_clubs: int | None = None,
                      block_entries: int | None = None) -> DataFrame:
    """(Club, player_id, replacement_id, improvement, rank): ``replace_mode`` of every club, in one job.

    ``teams`` holds a club once; a NULL club gives no rows, and a club without players
    of its own or without others has none. Pairs with a NULL feature on either side
    have no improvement and rank last, by weak player and replacement id; so do all
    pairs of a club with a NULL mean. Players without a club are never replacements.

    The weak players are a top-K per club behind one join with the clubs' weights.
    The candidates' features come along with them, so the players aren't joined
    again. Of candidates with equal features only the K least ids can rank, so a
    player copied a million times costs K rows a club. A weak player with a NULL
    feature has no improvement over anyone, so the K least ids outside the club are
    enough; they are among the 2K least of the K least ids of each club.
    """
    features, n = list(features), len(features)
    plan = _club_weights(teams, features)
    own = players.select("ID", "Club", *features).join(plan, "Club").select(
        "Club", F.col("ID").alias("player_id"), _values_array(features).alias("p"), "w",
        total([F.when(F.get("weak", F.lit(i)), F.col(f)).otherwise(F.lit(0.0)) for i, f in enumerate(features)]).alias("weak_sum"))
    worst = top_k_per_group(own, n_weak_players, ["Club"], "weak_sum", tiebreak=("player_id",), rank_col="wrank").drop("weak_sum")
    worst = worst.withColumn("blank", F.exists("p", lambda v: v.isNull()))

    weights = plan.select("Club", *[F.get("w", F.lit(i)).alias(f) for i, f in enumerate(features)])
    extra = {} if block_entries is None else {"block_entries": block_entries}
    found = outside_candidates(players, weights, features, k, n_clubs, **extra)
    found = top_k_per_group(found, k, ["team", "x"], "score", round_to=None, rank_col="copy").drop("copy")
    team = Window.partitionBy("team")
    place = F.row_number().over(team.orderBy(*sort_keys("score", round_to=None)))
    found = found.withColumn("place", place).withColumn("kth", F.min(F.when(F.col("place") <= k, F.col("score"))).over(team)) \
        .withColumn("top", F.max(F.when(F.col("place") <= k, F.abs("score"))).over(team))
    near = F.greatest(F.lit(RANK_TOLERANCE), F.lit(RELATIVE_TOLERANCE) * F.col("top"))
    survivors = found.where((F.col("place") <= k) | (F.col("score") >= F.col("kth") - near)).select(F.col("team").alias("Club"), F.col("ID").alias("replacement_id"), "score", "x")

    fused = improvement([F.get("x", F.lit(i)) for i in range(n)], [F.get("p", F.lit(i)) for i in range(n)], [F.get("w", F.lit(i)) for i in range(n)])
    pairs = worst.where(~F.col("blank")).join(survivors, "Club").select(
        "Club", "player_id", "wrank", "replacement_id", F.when(F.col("score").isNotNull(), fused).alias("improvement"))

    ids = top_k_per_group(players.where(F.col("Club").isNotNull()).select("ID", "Club"), k, ["Club"], "ID", ascending=True, round_to=None, tiebreak=())
    least = ids.orderBy("ID").limit(2 * k).agg(F.array_sort(F.collect_list(F.struct("ID", F.col("Club").alias("of")))).alias("a")).select("a").scalar()
    blank = worst.where("blank").select("Club", "player_id", "wrank", least.alias("least")).select(
        "Club", "player_id", "wrank", F.explode(F.slice(F.filter("least", lambda e: e["of"] != F.col("Club")), 1, k)).alias("e"))
    pairs = pairs.unionByName(blank.select("Club", "player_id", "wrank", F.col("e.ID").alias("replacement_id"), F.lit(None).cast("double").alias("improvement")))
    return top_k_per_group(pairs, k, ["Club"], "improvement", tiebreak=("wrank", "replacement_id")).drop("wrank")
