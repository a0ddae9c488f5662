"""Exact quantiles by radix selection, by group and of whole columns, against numpy."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchside.operators.profile import describe, group_quartiles
from pitchside.operators.quantiles import column_quantiles, exact_quantiles, key_value, order_key, quantile_rows

EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, math.nextafter(1.0, 0), math.nextafter(1.0, 2), 2.0, 1.7976931348623157e308,
         -1.7976931348623157e308, 0.1, -0.1, 1e-310, 3.0, 1e300, -1e-300, 2.0 ** 1023, 2.0 ** -1074, 2.0 ** -1022, 123456789.125, math.inf, -math.inf]


def test_keys_are_the_bits_and_go_back(spark):
    r = np.random.default_rng(3)
    some = np.frombuffer(r.integers(0, 2 ** 64, 4000, dtype=np.uint64).tobytes(), np.float64)
    near = [math.nextafter(2.0 ** e, d) for e in range(-1040, 1024, 37) for d in (0, math.inf)] + [2.0 ** e for e in range(-1074, 1024, 29)]
    values = [*EDGES, *near, *map(float, some[~np.isnan(some)])]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {x.i: x for x in order_key(df, "v").withColumn("back", F.expr(key_value("z_key"))).collect()}
    for i, v in enumerate(values):
        bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert got[i].z_key == (-bits if v < 0 else bits) and got[i].back == v, v
    nan = order_key(spark.createDataFrame([(math.nan,), (None,), (math.inf,)], "v double"), "v").orderBy("z_key").collect()
    assert len(nan) == 2 and math.isnan(nan[1].v)


@pytest.mark.parametrize("limit", [20_000, 2, 0])
def test_exact_quantiles_match_numpy(spark, limit):
    n = 40_000
    df = spark.range(n).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 3 == 0, F.randn(7)).otherwise(F.floor(F.rand(3) * 40)).alias("v"),
    ).cache()
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r.g, r.q): r.v for r in exact_quantiles(df, ["g"], "v", probs, limit).collect()}
    pdf = df.toPandas()
    for g in range(3):
        exp = np.quantile(pdf[pdf.g == g].v.to_numpy(), probs)
        for i in range(len(probs)):
            assert got[(g, i)] == pytest.approx(exp[i], abs=1e-12)


def test_column_quantiles_match_numpy(spark):
    """NULLs, a column of NULLs alone, very different magnitudes, negative values."""
    df = spark.range(60_000).select(
        F.col("id").cast("double").alias("a"), F.when(F.col("id") % 3 > 0, F.randn(5)).alias("b"), (F.col("id") % 7).alias("c"),
        (F.pow(F.lit(10.0), F.randn(9) * 60) * F.when(F.rand(1) < 0.5, 1).otherwise(-1)).alias("d"), F.lit(None).cast("double").alias("none"),
    ).cache()
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = column_quantiles(df, ["a", "b", "c", "d", "none"], probs)
    pdf = df.toPandas()
    for c in "abcd":
        assert got[c] == pytest.approx(np.quantile(pdf[c].dropna().to_numpy(dtype=float), probs).tolist(), abs=1e-12, rel=1e-12)
    assert got["none"] == [None] * 5


@pytest.mark.parametrize("n", [1, 2, 3, 7, 1999])
def test_few_values(spark, n):
    df = spark.range(n).select(F.lit(1).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 7).alias("v"))
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    exp = np.quantile(df.toPandas().v.to_numpy(), probs)
    assert column_quantiles(df, ["v"], probs)["v"] == pytest.approx(exp.tolist(), abs=1e-12)
    assert [r.v for r in sorted(exact_quantiles(df, ["g"], "v", probs).collect(), key=lambda r: r.q)] == pytest.approx(exp.tolist(), abs=1e-12)


def test_a_million_distinct_values_and_a_hot_group(spark):
    n = 1_000_000
    df = spark.range(n).select(
        F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 70)).alias("g"),
        (F.col("id") * 0.37 - 1e5).alias("v"),
    )
    got = {r.g: r for r in group_quartiles(df, "g", "v").collect()}
    ids = np.arange(n)
    v = ids * 0.37 - 1e5
    for g, own in [("hot", ids % 10 > 0), *[(f"g{k}", (ids % 10 == 0) & (ids % 70 == k)) for k in range(0, 70, 10)]]:
        assert [got[g].q25, got[g].q50, got[g].q75] == pytest.approx(np.quantile(v[own], [0.25, 0.5, 0.75]).tolist(), abs=1e-9)
        assert got[g].n == own.sum()
    assert len(got) == 8


def test_counters_are_bounded(spark):
    """No aggregate of a scan holds more rows than its digits, whatever the number of distinct values."""
    from pitchside.operators import quantiles as Q

    df = spark.range(300_000).select(F.lit(0).alias("c"), (F.rand(4) + 1).alias("v"))
    data = order_key(df, "v")
    first = data.groupBy("c", F.shiftright("z_key", Q.SHIFTS[0])).count().count()
    assert first <= 256   # one octave: 8 bits of the mantissa
    assert [a - b for a, b in zip((64, *Q.SHIFTS), Q.SHIFTS)] == [20, 22, 22]


def test_plans(spark):
    """Without Python, cross joins or Spark's percentile; with many groups no job runs before the result is asked for."""
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.rand(1).alias("v"), F.lit(None).cast("int").alias("w"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "no job at call time")
    lazy = quantile_rows(df, ["g"], "v", [0.5], limit=0)
    assert list(tracker.getJobIdsForGroup("lazy")) == []
    for p in [lazy, group_quartiles(df, "g", "v"), describe(df, ["v", "w"])]:
        text = p._jdf.queryExecution().toString()
        for word in ("Python", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin", "percentile"):
            assert word not in text
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_describe_of_nothing(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert [tuple(r) for r in describe(df).orderBy("column").collect()] == [("a", 0, *[None] * 7), ("b", 0, *[None] * 7)]
    assert describe(spark.createDataFrame([("x",)], "s string")).collect() == []
