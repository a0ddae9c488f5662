"""Pearson correlation matrices in long form (x, y, corr).

Null-free input (the default) uses Spark ML's ``Correlation``: one distributed
pass builds the Gram matrix with a tree aggregate, so the shuffle is
columns^2 per partition whatever the row count; only the cols x cols result
reaches the driver. ``method="pairwise"`` handles NULLs: pairwise-complete
moments per Arrow batch, summed per column pair by Spark (see
``pairwise_corr``). A constant column has no correlation: it comes back as NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, functions as F, types as T

from ..schema import CORR_SCALE

CORR_SCHEMA = T.StructType([
    T.StructField("x", T.StringType()),
    T.StructField("x_idx", T.IntegerType()),
    T.StructField("y", T.StringType()),
    T.StructField("y_idx", T.IntegerType()),
    T.StructField("corr", T.DoubleType()),
])


def corr_matrix(df: DataFrame, columns: Sequence[str], method: str = "auto") -> DataFrame:
    """Long (x, x_idx, y, y_idx, corr) for every pair of ``columns``.

    ``method="auto"`` runs the ML path and only if its result has a NaN
    (a NULL in the data, or a constant column) counts NULLs; with NULLs it
    switches to ``"pairwise"``. Complete data pays for nothing extra.
    """
    cols = list(columns)
    spark = df.sparkSession
    if method in ("auto", "ml"):
        assembled = VectorAssembler(inputCols=cols, outputCol="__v", handleInvalid="keep") \
            .transform(df.select(*[F.col(c).cast("double") for c in cols]))
        m = Correlation.corr(assembled, "__v").head()[0].toArray()
        if method == "auto" and np.isnan(m).any():
            counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                            *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(cols)]).head()
            if any(counts[f"c{i}"] != counts["__rows"] for i in range(len(cols))):
                return pairwise_corr(df, cols)
        rows = [
            (x, i, y, j, None if m[i][j] != m[i][j] else float(m[i][j]))
            for i, x in enumerate(cols) for j, y in enumerate(cols)
        ]
        return spark.createDataFrame(rows, CORR_SCHEMA)
    if method == "pairwise":
        return pairwise_corr(df, cols)
    raise ValueError(method)


def _moments_fn(d: int):
    """Task function: pairwise-complete moments of one Arrow batch, d x d of them.

    Nested helpers only, so the closure pickles by value (executors need numpy
    and pandas, not this package)."""

    def run(batches):
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64", na_value=np.nan)
            m = (~np.isnan(x)).astype("float64")          # 1 where present
            z = np.where(m > 0, x, 0.0)                     # shifted values, 0 where missing
            n = m.T @ m                                     # rows where both are present
            sx = z.T @ m                                    # sum of x_i over rows where x_j is present
            sxx = (z * z).T @ m
            sxy = z.T @ z
            i, j = np.meshgrid(np.arange(d), np.arange(d), indexing="ij")
            yield pd.DataFrame({
                "i": i.ravel(), "j": j.ravel(), "n": n.ravel(), "sx": sx.ravel(), "sy": sx.T.ravel(),
                "sxx": sxx.ravel(), "syy": sxx.T.ravel(), "sxy": sxy.ravel(),
            })

    return run


def pairwise_corr(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation over pairwise-complete rows, for data with NULLs.

    One cheap pass takes column means (used as shifts for numerical
    stability); then every Arrow batch emits the masked moments of all column
    pairs (matrix products in numpy), which Spark sums per pair: the shuffle is
    columns^2 rows per batch whatever the row count. A constant column (zero
    variance) gives NULL.
    """
    cols = list(columns)
    d = len(cols)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).head()
    shifted = df.select(*[
        (F.col(c).cast("double") - F.lit(means[f"m{i}"] if means[f"m{i}"] is not None else 0.0)).alias(f"v{i}")
        for i, c in enumerate(cols)
    ])
    schema = "i long, j long, n double, sx double, sy double, sxx double, syy double, sxy double"
    sums = shifted.mapInPandas(_moments_fn(d), schema).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    )
    cov = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    raw = F.try_divide(cov, F.sqrt(vx * vy))
    # Clamp rounding overshoot into [-1, 1]; greatest/least skip NULLs, so guard them.
    r = F.when((vx > 0) & (vy > 0), F.least(F.greatest(raw, F.lit(-1.0)), F.lit(1.0)))
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(
        F.element_at(names, F.col("i").cast("int") + 1).alias("x"), F.col("i").cast("int").alias("x_idx"),
        F.element_at(names, F.col("j").cast("int") + 1).alias("y"), F.col("j").cast("int").alias("y_idx"),
        r.alias("corr"),
    )


def numeric_columns(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """The candidates with a numeric type, in the given order; one that ``df`` lacks raises."""
    types = {f.name: f.dataType for f in df.schema.fields}
    absent = [c for c in candidates if c not in types]
    if absent:
        raise KeyError(f"absent columns: {absent}")
    return [c for c in candidates if isinstance(types[c], T.NumericType)]


def corr_between(df: DataFrame, xs: Sequence[str], ys: Sequence[str], method: str = "auto") -> DataFrame:
    """(x, x_idx, y, y_idx, corr) for x in xs, y in ys; indices are positions in xs / ys."""
    xs, ys = list(xs), list(ys)
    both = xs + [c for c in ys if c not in xs]
    m = corr_matrix(df, both, method)
    x_idx = F.array_position(F.array(*[F.lit(c) for c in xs]), F.col("x")).cast("int") - 1
    y_idx = F.array_position(F.array(*[F.lit(c) for c in ys]), F.col("y")).cast("int") - 1
    return (
        m.where(F.col("x").isin(xs) & F.col("y").isin(ys))
        .select("x", x_idx.alias("x_idx"), "y", y_idx.alias("y_idx"), "corr")
    )


def corr_top_for_rating(df: DataFrame, rating: str, features: Sequence[str], k: int = 5,
                        ascending: bool = False) -> DataFrame:
    """The k features most correlated with one rating column."""
    m = corr_between(df, features, [rating])
    key = F.round("corr", CORR_SCALE)
    order = key.asc_nulls_last() if ascending else key.desc_nulls_last()
    return m.orderBy(order, F.col("x_idx")).limit(k).select(
        F.col("x").alias("feature"), F.col("x_idx").alias("idx"), "corr"
    )
