"""Replace mode for every club at once: equal to replace_mode club by club, NULLs, ties and own players included."""

import random

import pytest

from pitchside.operators import batch as B
from pitchside.operators import replace as R

FEATS = ["a", "b", "c", "d", "e"]
PLAYER = "ID long, Name string, Club string, a double, b double, c double, d double, e double"
TEAM = "Club string, a double, b double, c double, d double, e double"


def tables(spark, seed):
    r = random.Random(seed)
    draw = (lambda: float(r.randint(0, 3))) if seed % 2 else (lambda: r.uniform(0, 100))   # many ties, or none
    hole = lambda v, p: None if r.random() < p else v
    rows = [(i, f"n{i}", r.choice(["X", "X", "Y", "Z", "Only", None]) if i else "Only", *[hole(draw(), 0.1 if seed > 1 else 0.0) for _ in FEATS]) for i in range(70)]
    rows += [(100 + i, "copy", "Y", 3.0, 3.0, 3.0, 3.0, 3.0) for i in range(20)]
    rows += [(200 + i, "blank", "Blank", None, 1.0, 1.0, 1.0, 1.0) for i in range(3)]   # every weak player has a NULL
    clubs = [(c, *[draw() + i for i in range(5)]) for c in ("X", "Y", "Z", "Only", "Blank", "Empty")]
    clubs += [("NoMean", None, 1.0, 2.0, 3.0, 4.0), (None, 1.0, 2.0, 3.0, 4.0, 5.0)]
    rows += [(300, "m", "NoMean", 1.0, 2.0, 3.0, 4.0, 5.0)]
    return spark.createDataFrame(rows, PLAYER).repartition(3), spark.createDataFrame(clubs, TEAM), [c[0] for c in clubs]


@pytest.mark.parametrize("seed, k, entries", [(0, 1, None), (3, 4, 3)])
def test_equals_replace_mode_of_each_club(spark, monkeypatch, seed, k, entries):
    monkeypatch.setattr(B, "BLOCK_ROWS", 4)   # several row blocks a task
    players, teams, clubs = tables(spark, seed)
    got: dict = {}
    for r in R.replace_all_clubs(players, teams, k, FEATS, block_entries=entries).collect():
        got.setdefault(r.Club, []).append((r["rank"], r.player_id, r.replacement_id, None if r.improvement is None else round(r.improvement, 6)))
    for c in clubs:
        want = [] if c is None else [(r["rank"], r.player_id, r.replacement_id, None if r.improvement is None else round(r.improvement, 6))
                                     for r in R.replace_mode(players, teams, c, k=k, features=FEATS).collect()]
        assert sorted(got.get(c, []), key=str) == sorted(want, key=str), c


def test_empty_tables(spark):
    players, teams, _ = tables(spark, 0)
    assert R.replace_all_clubs(players.limit(0), teams, 3, FEATS).count() == 0
    assert R.replace_all_clubs(players, teams.limit(0), 3, FEATS).count() == 0


def test_copies_cost_k_rows_a_club(spark):
    """5,000 players with equal features tie at the top: K of them reach the pairs, with the least ids."""
    rows = [(i, "s", "S", 9.0, 9.0, 9.0, 9.0, 9.0) for i in range(5000)] + [(9000 + i, "x", "X", 1.0, 2.0, 3.0, 4.0, 5.0) for i in range(12)]
    players, teams = spark.createDataFrame(rows, PLAYER), spark.createDataFrame([("X", 1.0, 2.0, 3.0, 4.0, 5.0)], TEAM)
    got = R.replace_all_clubs(players, teams, 3, FEATS).orderBy("rank").collect()
    assert [(r.player_id, r.replacement_id) for r in got] == [(9000, 0), (9000, 1), (9000, 2)]
