"""The matrix as a grid of blocks: equal to the inlined form, one plan whatever the number of clubs."""

import random

import pytest
from pyspark.sql import functions as F

from pitchside.operators import matrix as M

GROUPS = {"G": ["a", "b"], "H": ["b"], "I": ["b", "a"]}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("transform", ["reciprocal", "identity"])
def test_grid_equals_inlined(spark, transform):
    r = random.Random(3)
    draw = lambda: r.choice([None, 0.0, 1.0, 2.5, 7.0])
    rows = [(i if i % 9 else None, f"n{i % 4}", r.choice(["X", None]), draw(), draw()) for i in range(80)]
    rows += [(5, "same", "X", 1.0, 2.0)] * 50   # repeated rows
    players = spark.createDataFrame(rows, "ID long, Name string, Club string, a double, b double")
    teams = spark.createDataFrame([(f"t{i}", draw(), draw()) for i in range(23)], "Club string, a double, b double")
    want = sorted(map(tuple, M.matrix_scores(players, teams, GROUPS, "null", transform).collect()), key=repr)
    for entries in (1, 7, 30):
        got = M.matrix_scores(players, teams, GROUPS, "null", transform, block_entries=entries)
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert len(want) == len(rows) * 23 * 3


def test_empty_tables(spark):
    players = spark.createDataFrame([(1, "n", "X", 1.0, 2.0)], "ID long, Name string, Club string, a double, b double")
    teams = spark.createDataFrame([(f"t{i}", 1.0, 2.0) for i in range(9)], "Club string, a double, b double")
    assert M.matrix_scores(players.limit(0), teams, GROUPS, block_entries=3).count() == 0
    assert M.matrix_scores(players, teams.limit(0), GROUPS, block_entries=3, n_clubs=9).count() == 0


def test_a_million_entries_are_one_plan(spark):
    clubs = 333_334
    teams = spark.range(clubs).select(F.col("id").cast("string").alias("Club"), (1.0 + F.col("id")).alias("a"), F.lit(2.0).alias("b"))
    players = spark.createDataFrame([(i, "n", "X", 1.0 + i, 3.0) for i in range(3)], "ID long, Name string, Club string, a double, b double")
    df = M.matrix_scores(players, teams, GROUPS, n_clubs=clubs)
    p = physical(df)
    assert "Union" not in p and "CartesianProduct" not in p and "NestedLoop" not in p
    assert p.count("Range (") == 1 and p.count("Scan ExistingRDD") == 1   # each side is read once
    small = physical(M.matrix_scores(players, teams.limit(40_000), GROUPS, n_clubs=40_000))
    assert p.count("Exchange") <= small.count("Exchange") + 1 and p.count("Join") == small.count("Join")
    got = df.groupBy("grp").agg(F.count("*").alias("n"), F.countDistinct("team").alias("t"), F.sum("score").alias("s")).collect()
    assert {r.grp: (r.n, r.t) for r in got} == {g: (3 * clubs, clubs) for g in GROUPS}
    assert abs(next(r.s for r in got if r.grp == "H") - 3 * clubs * 1.5) < 1e-3
