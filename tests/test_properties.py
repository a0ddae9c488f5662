"""Property tests: the numpy batch top-K equals the pure-window form on random tables."""

import pytest
from hypothesis import HealthCheck, example, given, settings, strategies as st

from pitchside.operators import batch as B
from pitchside.operators import matrix as M

FEATS = ["a", "b", "c"]
value = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.0, 3.0, 5.0, 10.0, 2.5]))
player = st.tuples(st.sampled_from(["X", "Y", "Z", None]), value, value, value)
team_value = st.sampled_from([0.0, 1.0, 2.0, 4.0, 7.5])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(player, min_size=1, max_size=25),
    teams=st.lists(st.tuples(team_value, team_value, team_value), min_size=1, max_size=4),
    k=st.integers(min_value=1, max_value=6),
    reverse=st.booleans(),
)
def test_batch_equals_window(spark, rows, teams, k, reverse):
    p = spark.createDataFrame(
        [(i, f"n{i % 3}", c, a, b, d) for i, (c, a, b, d) in enumerate(rows)],
        "ID long, Name string, Club string, a double, b double, c double",
    )
    t = spark.createDataFrame([(f"T{j}", *v) for j, v in enumerate(teams)], "Club string, a double, b double, c double")
    groups = {"G1": FEATS, "G2": ["c", "a"]}
    for fast, slow in ((B.mvp_all_clubs, M.mvp_all_clubs), (B.mvt_all_players, M.mvt_all_players)):
        a = sorted(map(tuple, fast(p, t, groups, k, reverse, on_zero="null").collect()), key=repr)
        b = sorted(map(tuple, slow(p, t, groups, k, reverse, on_zero="null").collect()), key=repr)
        assert a == b


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@example(rows=[("X", None, None, None), ("Y", None, None, None), ("Y", 0.0, 0.0, 0.0)], club=(0.0, 0.0, 0.0, 0.0, 0.0), k=1)
@example(rows=[("X", 1.0, None, 2.0), ("X", 3.0, 1.0, 2.0), ("Y", None, 1.0, 2.0), ("Y", 9.0, 9.0, 9.0), ("Y", 0.0, 0.0, 0.0)], club=(1.0, 2.0, 3.0, 4.0, 5.0), k=5)
@given(
    rows=st.lists(st.tuples(st.sampled_from(["X", "Y", None]), value, value, value), min_size=2, max_size=16),
    club=st.tuples(team_value, team_value, team_value, team_value, team_value),
    k=st.integers(min_value=1, max_value=5),
)
def test_replace_mode_equals_per_player_loop(spark, rows, club, k):
    from pitchside.operators import replace as R

    feats = ["a", "b", "c", "d", "e"]
    p = spark.createDataFrame(
        [(i, f"n{i}", c, a, b, d, a, b) for i, (c, a, b, d) in enumerate(rows)],
        "ID long, Name string, Club string, a double, b double, c double, d double, e double",
    )
    t = spark.createDataFrame([("X", *club), ("Y", 1.0, 2.0, 3.0, 4.0, 5.0)],
                              "Club string, a double, b double, c double, d double, e double")
    fast = [(r.player_id, r.replacement_id, None if r.improvement is None else round(r.improvement, 6))
            for r in R.replace_mode(p, t, "X", k=k, features=feats).collect()]
    worst = [r.ID for r in R.weak_players(p, t, "X", features=feats).collect()]
    pairs = []
    for pid in worst:   # the reference's loop: best k per weak player, then the best k overall
        pairs += [(pid, r.replacement_id, None if r.improvement is None else round(r.improvement, 6))
                  for r in R.best_replacements(p, t, "X", pid, k=k, features=feats).collect()]
    pairs.sort(key=lambda x: (x[2] is None, -(x[2] or 0.0), worst.index(x[0]), x[1]))
    assert fast == pairs[:k]


@pytest.mark.parametrize("scale", [1e-7, 1.0, 1e12])
def test_raw_score_ranking_at_any_scale(spark, scale):
    """digits=None ranks raw scores: equal to a brute-force sort whatever the magnitude."""
    import random

    from pitchside.operators import batch as B, matrix as M

    r = random.Random(11)
    feats = ["a", "b"]
    prows = [(i, f"p{i}", f"c{i % 5}", r.random() * scale, r.random() * scale) for i in range(60)]
    trows = [(f"c{i}", 0.5 + r.random(), 0.5 + r.random()) for i in range(5)]
    players = spark.createDataFrame(prows, "ID long, Name string, Club string, a double, b double")
    teams = spark.createDataFrame(trows, "Club string, a double, b double")
    score = {(p[0], t[0]): p[3] * (1.0 / t[1]) + p[4] * (1.0 / t[2]) for p in prows for t in trows}
    best = {t[0]: sorted((p[0] for p in prows), key=lambda i: (-score[i, t[0]], i))[:4] for t in trows}
    got = [x.ID for x in M.mvp_for_team(players, teams, "c2", feats, "G", 4, digits=None).orderBy("rank").collect()]
    assert got == best["c2"]
    every = B.mvp_all_clubs(players, teams, {"G": feats}, 4, digits=None).orderBy("team", "rank").collect()
    assert [x.ID for x in every] == [i for t in sorted(best) for i in best[t]]
    clubs = B.mvt_all_players(players, teams, {"G": feats}, 2, digits=None).where("ID = 7").orderBy("rank").collect()
    assert [x.team for x in clubs] == sorted(best, key=lambda t: (-score[7, t], t))[:2]
