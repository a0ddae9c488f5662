"""Feature voting: which features matter for each position group.

Each rating column (LS ... RB) ranks the features by correlation and its top
12 vote for the rating's group; each group keeps its 12 most voted features,
ties going to the feature seen first (rating order, then rank within the
rating). The correlation step is the only pass over the players; the rest
runs on the 29 x 26 correlation rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..schema import CORR_SCALE, FEATURES, FEATURES_PER_GROUP, RATINGS, TOP_FEATURES_PER_RATING
from ..functions.columns import position_group
from .corr import corr_between


def rating_votes(corr_long: DataFrame, n_top: int = TOP_FEATURES_PER_RATING) -> DataFrame:
    """(rating, rating_idx, grp, feature, feature_idx, rank) for each rating's top features.

    ``corr_long`` has x (feature), x_idx, y (rating), y_idx, corr.

    NULL correlations (constant columns) never vote.
    """
    # Rating order (first-seen tie-break) is the position of the rating in the caller's list.
    rating_idx = F.col("y_idx").cast("int")
    w = Window.partitionBy("y").orderBy(F.round("corr", CORR_SCALE).desc(), F.col("x_idx"))
    ranked = (
        corr_long.where(F.col("corr").isNotNull())
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= n_top)
    )
    return ranked.select(
        F.col("y").alias("rating"), rating_idx.alias("rating_idx"), position_group("y").alias("grp"),
        F.col("x").alias("feature"), F.col("x_idx").alias("feature_idx"), "rank",
    )


def vote_features(corr_long: DataFrame, n_top: int = TOP_FEATURES_PER_RATING,
                  n_keep: int = FEATURES_PER_GROUP) -> DataFrame:
    """Votes from long correlations (x = feature, y = rating):
    (grp, rank, feature, votes, first_rating_idx, first_rank) for each group's kept features."""
    votes = rating_votes(corr_long, n_top).where(F.col("grp").isNotNull())
    agg = votes.groupBy("grp", "feature").agg(
        F.count(F.lit(1)).alias("votes"),
        F.min(F.struct("rating_idx", "rank")).alias("first"),
    )
    w = Window.partitionBy("grp").orderBy(F.col("votes").desc(), F.col("first"))
    return (
        agg.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= n_keep)
        .select(
            "grp", "rank", "feature", "votes",
            F.col("first.rating_idx").alias("first_rating_idx"), F.col("first.rank").alias("first_rank"),
        )
    )


def feature_votes(players: DataFrame, ratings: Sequence[str] = RATINGS, features: Sequence[str] = FEATURES,
                  n_top: int = TOP_FEATURES_PER_RATING, n_keep: int = FEATURES_PER_GROUP,
                  method: str = "auto") -> DataFrame:
    """Correlate every feature with every rating, then vote (see ``vote_features``)."""
    return vote_features(corr_between(players, features, ratings, method), n_top, n_keep)


def group_features(votes: DataFrame) -> dict[str, list[str]]:
    """Collect the kept feature names per group (at most 3 x 12 strings) plus ALL = every feature."""
    out: dict[str, list[str]] = {}
    for row in votes.orderBy("grp", "rank").select("grp", "feature").collect():
        out.setdefault(row["grp"], []).append(row["feature"])
    return out


def top_columns_per_row(df: DataFrame, key: str, columns: Sequence[str], n: int) -> DataFrame:
    """Row-wise top-n columns: (key, rank, feature, value); ties go to the earlier column, NULLs never rank."""
    cols = list(columns)
    long = df.select(
        key, F.posexplode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                                    for c in cols])).alias("idx", "e")
    ).select(key, "idx", "e.feature", "e.value").where(F.col("value").isNotNull())
    w = Window.partitionBy(key).orderBy(F.col("value").desc(), F.col("idx"))
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n) \
        .select(key, "rank", "feature", "value")
