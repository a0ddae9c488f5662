"""Kernel densities per group: exact for few values, linear binning within its stated error for many."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchside.operators import profile as P


def brute(v, grid=100, cut=2.0):
    v = np.asarray(v, float)
    h = v.std(ddof=1) * len(v) ** -0.2
    x = v.min() - cut * h + np.arange(grid) * (v.max() - v.min() + 2 * cut * h) / (grid - 1)
    return x, np.array([np.exp(-0.5 * ((g - v) / h) ** 2).sum() for g in x]) / (len(v) * h * np.sqrt(2 * np.pi)), h


@pytest.mark.parametrize("exact,nodes", [(P.EXACT_VALUES, P.NODES), (100, 400), (10 ** 9, 2)])
def test_against_brute_force(spark, exact, nodes):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 10 > 1, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 3)).alias("g"),
        F.when(F.col("id") % 10 > 1, F.exp(F.randn(3))).otherwise(F.floor(F.rand(5) * 30)).alias("v"), F.lit(1).alias("lo"), F.lit(1).alias("w")).cache()
    got = {}
    for r in P.group_density(df.select("g", "v"), "g", "v", exact_values=exact, nodes=nodes).collect():
        got.setdefault(r.g, {})[r.grid_idx] = (r.x, r.density)
    pdf = df.toPandas()
    assert set(got) == {"hot", "g0", "g1", "g2"}
    for g, points in got.items():
        own = pdf[pdf.g == g].v
        x, want, h = brute(own)
        assert len(points) == 100
        assert [points[i][0] for i in range(100)] == pytest.approx(x.tolist(), abs=1e-9)
        binned = own.nunique() > 1.1 * exact   # the number of distinct values is an estimate
        s = (own.max() - own.min()) / (nodes - 1)
        err = 0.05 * (s / h) ** 2 / h if binned else 0.0
        assert max(abs(points[i][1] - want[i]) for i in range(100)) <= err + 1e-9
    hot = pdf[pdf.g == "hot"].v
    if nodes == 400:
        assert hot.nunique() > 20_000


def test_nodes_bound_the_kernel_sum(spark):
    """The pairs of grid points and values follow the nodes, not the rows."""
    df = spark.range(50_000).select(F.substring(F.concat(F.lit("a"), "id"), 1, 1).alias("g"), F.rand(2).alias("v"))
    plan = P.group_density(df, "g", "v", exact_values=50, nodes=200)
    assert plan.count() == 100
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    nodes = P.group_density(df, "g", "v", grid=1, exact_values=50, nodes=200)
    assert nodes.count() == 1


def test_flat_and_single_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 2.0), (None, 3.0), ("c", None), ("d", 1.0), ("d", 2.0)], "g string, v double")
    got = {}
    for r in P.group_density(df, "g", "v").collect():
        got.setdefault(r.g, []).append(r.density)
    assert set(got) == {"a", "b", "d"} and all(len(x) == 100 for x in got.values())
    assert all(x is not None for x in got["d"]) and all(x is None for x in got["a"] + got["b"])
