"""Most similar players: top-K by the projection of each candidate on the target.

The target row is read once and enters as literals (no join); candidates are
scored in one codegen'd projection and cut by ``TakeOrderedAndProject``.
The card columns come from the same scan, so no join back is needed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import norm, projection_similarity, weighted_sum
from ..schema import FEATURES
from .targets import pick_player, row_literals
from .topk import top_k

SIMILAR_CARD = ["Name", "Age", "Nationality", "Club", "Height_cm", "Weight_lbs"]


def similar_players(players: DataFrame, player_id=None, name: str | None = None, k: int = 10,
                    features: Sequence[str] = FEATURES, card: Sequence[str] = SIMILAR_CARD,
                    metric: str = "projection", strict: bool = False) -> DataFrame:
    """Top-K players most similar to one player (excluded from the result).

    ``metric="projection"`` (the reference's measure): |c| cos(c, t), the
    length of the candidate projected on the target, so big all-round
    players rank high. ``metric="cosine"``: cos(c, t) alone.
    """
    target = pick_player(players, player_id, name)
    v, found = row_literals(target, ["ID", *features], strict, "player")
    present = F.lit(found)
    t = [v[f] for f in features]
    if metric == "projection":
        score = projection_similarity(features, t, norm(t))
    elif metric == "cosine":
        score = F.try_divide(weighted_sum(features, t), norm(features) * norm(t))
    else:
        raise ValueError(f"metric must be 'projection' or 'cosine', not {metric!r}")
    scored = players.where((F.col("ID") != v["ID"]) & present).select("ID", *card, score.alias("score"))
    return top_k(scored.where(F.col("score").isNotNull()), k, "score")


def similar_embeddings(embeddings: DataFrame, vec_id, k: int = 10, id_col: str = "vec_id",
                       vec_col: str = "embedding", extra: Sequence[str] = ("label",)) -> DataFrame:
    """The same similarity on array columns (higher-order functions over the vectors); an unknown or NULL target gives no row."""
    # One row is read; its vector enters the plan as a literal and its norm as a number.
    found = embeddings.where(F.col(id_col) == F.lit(vec_id)).select(vec_col).limit(1).collect()
    vector = [float(x) for x in found[0][0]] if found and found[0][0] is not None else []
    rows = embeddings.where((F.col(id_col) != F.lit(vec_id)) & F.lit(bool(vector)))
    t = F.lit(vector) if vector else F.array().cast("array<double>")
    c = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    dot = F.aggregate(F.zip_with(c, t, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    c_norm = F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x * x))
    t_norm = F.lit(math.sqrt(sum(x * x for x in vector)))
    score = c_norm * F.try_divide(dot, c_norm * t_norm)
    scored = rows.select(F.col(id_col), *extra, score.alias("score"))
    return top_k(scored.where(F.col("score").isNotNull()), k, "score", tiebreak=(id_col,))
