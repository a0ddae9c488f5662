"""Poisson bootstrap: intervals of group means and bands of linear fits.

A row enters replicate b with a Poisson(1) weight that depends only on a seed, the
row's key and b: 16 bits of an MD5 held against the distribution's steps. Weights need no
row order and no exchange, so reruns, other partitions and lost executors give the same
replicates. Each replicate is a handful of weighted sums, which merge in one partial
aggregate by (group, replicate): what is shuffled follows groups x replicates, not rows,
and a hot group is combined in each task. Percentiles are over at most ``replicates`` values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import total
from .profile import club_overall_ci

REPLICATES, SEED, LEVEL = 1000, 7, 0.95
PIECES = 8   # replicates of one MD5, 16 bits each


def poisson_steps() -> list[int]:
    """Of 65,536 draws, the first that gives weight 1, 2, ...: the cumulative Poisson(1) distribution."""
    steps, below = [], 0.0
    for j in range(16):
        below += math.exp(-1) / math.factorial(j)
        if (step := round(65536 * below)) < 65536:
            steps.append(step)
    return steps


def resampled(df: DataFrame, key: str, replicates: int = REPLICATES, seed: int = SEED) -> DataFrame:
    """``df`` with columns ``replicate`` and ``weight``: a row for each replicate that holds the row at all.

    Rows with equal keys share their weights; a NULL key counts as an empty text.
    """
    blocks = df.select("*", F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // PIECES))).alias("__block"))
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")), F.col("__block").cast("string"))
    draws = F.array(*[F.conv(F.substring("__md5", 4 * i + 1, 4), 16, 10).cast("int") for i in range(PIECES)])
    drawn = blocks.select("*", F.md5(text).alias("__md5")).select(*df.columns, "__block", F.posexplode(draws).alias("__piece", "__draw"))
    weight = total([(F.col("__draw") >= s).cast("int") for s in poisson_steps()])
    return drawn.select(*df.columns, (F.col("__block") * PIECES + F.col("__piece")).alias("replicate"), weight.alias("weight")) \
        .where((F.col("weight") > 0) & (F.col("replicate") < replicates))


def _interval(value: Column, level: float, low: str, high: str) -> list[Column]:
    return [F.percentile(value, F.lit((1 - level) / 2)).alias(low), F.percentile(value, F.lit((1 + level) / 2)).alias(high)]


def club_bootstrap_ci(players: DataFrame, value: str = "Overall", key: str = "ID", replicates: int = REPLICATES,
                      level: float = LEVEL, seed: int = SEED) -> DataFrame:
    """(Club, mean, std, n, ci_low, ci_high, boot_low, boot_high): the normal interval and the bootstrap's.

    NULL values are left out, as is a NULL club. A club without a value has NULL
    intervals; a replicate that draws none of a club's rows doesn't count for it.
    """
    rows = players.where(F.col("Club").isNotNull() & F.col(value).isNotNull()).select("Club", key, F.col(value).cast("double").alias("v"))
    means = resampled(rows, key, replicates, seed).groupBy("Club", "replicate") \
        .agg((F.sum(F.col("weight") * F.col("v")) / F.sum("weight")).alias("m"))
    boot = means.groupBy("Club").agg(*_interval(F.col("m"), level, "boot_low", "boot_high"))
    return club_overall_ci(players, value=value).join(boot, "Club", "left")


def fit_bands(df: DataFrame, x: str, ys: Sequence[str], key: str = "ID", points: int = 100, replicates: int = REPLICATES,
              level: float = LEVEL, seed: int = SEED) -> DataFrame:
    """(feature, point, x, fit, low, high): the line y ~ x on ``points`` places of x, with the bootstrap's band.

    A feature's rows are those with both values. Sums are taken around the floor of
    the means, so large offsets cost no precision and whole numbers stay exact. A
    replicate without two different x has no line and doesn't count; a feature
    whose x are all equal has no fit and no band.
    """
    ys = list(ys)
    pair = {i: (F.when(F.col(y).isNotNull(), F.col(x).cast("double")), F.when(F.col(x).isNotNull(), F.col(y).cast("double"))) for i, y in enumerate(ys)}
    pairs = df.select(key, *[c.alias(f"{n}{i}") for i, xy in pair.items() for n, c in zip("xy", xy)])

    def stacked(agg: DataFrame, names: Sequence[str], *keep: str) -> DataFrame:
        entries = [e for i, y in enumerate(ys) for e in (F.lit(y), *[F.col(f"{n}{i}") for n in names])]
        return agg.select(*keep, F.stack(F.lit(len(ys)), *entries).alias("feature", *names))

    whole = pairs.agg(*[e for i in pair for e in (
        F.min(f"x{i}").alias(f"lo{i}"), F.max(f"x{i}").alias(f"hi{i}"), F.floor(F.avg(f"x{i}")).cast("double").alias(f"cx{i}"),
        F.floor(F.avg(f"y{i}")).cast("double").alias(f"cy{i}"),
        F.regr_slope(f"y{i}", f"x{i}").alias(f"slope{i}"), F.regr_intercept(f"y{i}", f"x{i}").alias(f"intercept{i}"))])
    middle = whole.select(F.struct(*[f"c{n}{i}" for i in pair for n in "xy"]).alias("c")).select("c").scalar()
    rows = resampled(pairs.select(key, *[f"{n}{i}" for i in pair for n in "xy"], middle.alias("c")), key, replicates, seed)
    aggs = []
    for i in pair:
        dx, dy, w = F.col(f"x{i}") - F.col(f"c.cx{i}"), F.col(f"y{i}") - F.col(f"c.cy{i}"), F.col("weight")
        aggs += [F.sum(F.when(dx.isNotNull(), w)).alias(f"n{i}"), F.sum(w * dx).alias(f"sx{i}"), F.sum(w * dy).alias(f"sy{i}"),
                 F.sum(w * dx * dx).alias(f"sxx{i}"), F.sum(w * dx * dy).alias(f"sxy{i}")]
    sums = stacked(rows.groupBy("replicate").agg(*aggs), ("n", "sx", "sy", "sxx", "sxy"), "replicate")
    ends = stacked(whole, ("lo", "hi", "cx", "cy", "slope", "intercept"))
    lines = sums.select("feature", F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")).alias("b"), "n", "sx", "sy") \
        .select("feature", "b", ((F.col("sy") - F.col("b") * F.col("sx")) / F.col("n")).alias("a"))
    on_grid = lines.join(ends, "feature").select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")) \
        .withColumn("x", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("point") / F.lit(max(1, points - 1)))
    line = F.col("cy") + F.col("a") + F.col("b") * (F.col("x") - F.col("cx"))
    return on_grid.groupBy("feature", "point", "x").agg(
        F.max(F.col("intercept") + F.col("slope") * F.col("x")).alias("fit"), *_interval(line, level, "low", "high"))
