"""Distinct counts by bitmaps against brute force; what is shuffled follows the range of the values."""

import random

import pytest
from pyspark.sql import functions as F

from pitchside.operators import profile as P


def rows(n=3000, seed=1):
    r = random.Random(seed)
    edges = [0, -1, 63, 64, -64, -65, 2 ** 63 - 1, -(2 ** 63)]
    return [(i * 7 - 5000, r.choice([None, *range(-3, 90)]), None, r.choice([-128, 127, 0, None]), r.choice([*edges, None, r.randint(-10 ** 9, 10 ** 9)]),
             r.choice([0.5, -0.0, 0.0, None, r.random()]), r.choice(["a", "", None, f"t{r.randint(0, 50)}"]), r.choice([True, False, None])) for i in range(n)]


SCHEMA = "id long, age int, none int, tiny byte, edge long, real double, `a.b's` string, flag boolean"


@pytest.mark.parametrize("limits", [(64, 2048), (1, 1), (10 ** 6, 3)])
def test_against_brute_force(spark, monkeypatch, limits):
    monkeypatch.setattr(P, "WORDS", limits[0])
    monkeypatch.setattr(P, "NARROW_WORDS", limits[1])
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = {r["column"]: r["nunique"] for r in P.nunique(df).collect()}
    want = {c: len({x[i] for x in data if x[i] is not None}) for i, c in enumerate(df.columns)}
    assert got == want
    assert {r["column"]: r["nunique"] for r in P.nunique(df, ["age", "none"]).collect()} == {"age": want["age"], "none": 0}


def test_empty(spark):
    assert {tuple(r) for r in P.nunique(spark.createDataFrame([], "a int, b string, c double")).collect()} == {("a", 0), ("b", 0), ("c", 0)}


def test_shuffle_follows_the_range(spark):
    """A unique id column leaves a task as one row for 64 neighbours; a narrow column as words of one row."""
    df = spark.range(0, 640_000, 1, 4).select(F.col("id"), (F.col("id") % 100).cast("int").alias("age"))
    words = df.selectExpr("spark_partition_id() AS p", "id >> 6 AS word").distinct().count()
    assert words == 10_000
    assert {r["column"]: r["nunique"] for r in P.nunique(df).collect()} == {"id": 640_000, "age": 100}
    plan = P.nunique(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bit_or") >= 2 and "Expand" not in plan
    # only the wide column is turned into rows
    generated = [x for x in plan.splitlines() if "Generate" in x or "named_struct" in x or "struct(i" in x]
    assert generated and not any("age" in x for x in generated)
