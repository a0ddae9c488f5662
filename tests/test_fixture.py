"""Golden micro-fixture: hand-computed answers from FIXTURES.md section 3."""

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from fixture_data import F5, players, teams
from pitchside.functions.columns import position_group, projection_similarity
from pitchside.operators import matrix as M
from pitchside.operators import profile as PR
from pitchside.operators import projections as PJ
from pitchside.operators import replace as R
from pitchside.operators import similar as S
from pitchside.operators.votes import vote_features


def r6(x):
    return None if x is None else round(x, 6)


def test_group_position(spark):
    got = players(spark).select("ID", position_group("Position").alias("g")).orderBy("ID").collect()
    assert [r.g for r in got] == ["DEF", "MID", "FWD", None, "DEF", "FWD"]


def test_projection_similarity(spark):
    df = spark.createDataFrame([(3.0, 4.0, 0.0, 2.0), (6.0, 8.0, 3.0, 4.0)], "a double, b double, x double, y double")
    got = [r.s for r in df.select(projection_similarity(["a", "b"], ["x", "y"]).alias("s")).collect()]
    assert got == [pytest.approx(4.0), pytest.approx(10.0)]


def test_weak_features_and_threshold(spark):
    got = R.weak_features(teams(spark), "X", F5).collect()
    assert [(r.feature, r.threshold) for r in got] == [("f2", 2.0)]


def test_weight_vector_five_features(spark):
    got = R.weight_vector(teams(spark), "X", F5).orderBy("idx").collect()
    assert [r6(r.weight) for r in got] == [1.666667, 3.333333, 1.666667, 1.666667, 1.666667]
    assert sum(r.weight for r in got) == pytest.approx(10.0)


def test_weight_vector_29_features(spark):
    names = [f"c{i}" for i in range(29)]
    # Seven values below the 8th smallest: 0..6 are weak, 7.. are not.
    row = [("T", *[float(i) for i in range(29)])]
    t = spark.createDataFrame(row, "Club string, " + ", ".join(f"{n} double" for n in names))
    got = R.weight_vector(t, "T", names).orderBy("idx").collect()
    assert sum(r.weak for r in got) == 7
    assert {r6(r.weight) for r in got if r.weak} == {0.555556}
    assert {r6(r.weight) for r in got if not r.weak} == {0.277778}
    assert sum(r.weight for r in got) == pytest.approx(10.0)


def test_weak_players_both_orders(spark):
    desc = R.weak_players(players(spark), teams(spark), "X", features=F5).collect()
    assert [(r.ID, r.weak_sum) for r in desc] == [(1, 40.0), (2, 20.0)]
    asc = R.weak_players(players(spark), teams(spark), "X", ascending=True, features=F5).collect()
    assert [(r.ID, r.weak_sum) for r in asc] == [(2, 20.0), (1, 40.0)]


def test_replace_mode_all_pairs(spark):
    got = R.replace_mode(players(spark), teams(spark), "X", k=10, features=F5).collect()
    assert [(r.player_id, r.replacement_id, r6(r.improvement)) for r in got] == [
        (2, 3, 316.666667), (1, 3, 283.333333), (2, 5, 216.666667),
        (1, 5, 183.333333), (2, 4, -83.333333), (1, 4, -116.666667),
    ]
    assert [r["rank"] for r in got] == [1, 2, 3, 4, 5, 6]


def test_replace_mode_matches_brute_force(spark):
    p, t = players(spark), teams(spark)
    fast = R.replace_mode(p, t, "X", k=3, features=F5).collect()
    allp = R.replace_mode(p, t, "X", k=100, features=F5).collect()
    assert fast == allp[:3]


def test_best_replacements_single_player(spark):
    got = R.best_replacements(players(spark), teams(spark), "X", 2, k=2, features=F5).collect()
    assert [(r.replacement_id, r6(r.improvement)) for r in got] == [(3, 316.666667), (5, 216.666667)]


def test_similar_players(spark):
    got = S.similar_players(players(spark), 3, k=10, features=F5).collect()
    assert [(r.ID, r6(r.score)) for r in got] == [
        (6, 178.885438), (5, 111.803399), (1, 67.082039), (2, 67.082039), (4, 44.72136),
    ]


def test_similar_by_duplicate_name_takes_lowest_id(spark):
    got = S.similar_players(players(spark), name="C. Three", k=1, features=F5).collect()
    assert got[0].ID == 6  # target is id 3, so 3 itself is excluded


def test_similar_zero_candidate_is_null_and_dropped(spark):
    p = players(spark).unionByName(
        players(spark).where("ID = 4").withColumn("ID", F.lit(9).cast("long"))
        .select(*[F.lit(0.0).alias(f) if f in F5 else F.col(f) for f in players(spark).columns]))
    got = S.similar_players(p, 3, k=10, features=F5).collect()
    assert 9 not in [r.ID for r in got]


def _club_scores(spark, club, feats, on_zero="error"):
    df = M.club_scores(players(spark), teams(spark), club, feats, "ALL", on_zero)
    return {r.ID: r6(r.score) for r in df.collect()}


def test_matrix_scores_club_x(spark):
    assert _club_scores(spark, "X", F5) == {1: 71.111111, 2: 57.555556, 3: 128.666667, 4: 42.888889,
                                             5: 89.0, 6: 171.555556}


def test_matrix_scores_club_y(spark):
    assert _club_scores(spark, "Y", F5) == {1: 43.5, 2: 22.5, 3: 66.0, 4: 22.0, 5: 59.0, 6: 88.0}


def test_matrix_scores_two_features(spark):
    assert _club_scores(spark, "X", ["f1", "f2"]) == {1: 50, 2: 22, 3: 72, 4: 24, 5: 64, 6: 96}


def test_zero_team_feature(spark):
    with pytest.raises(Exception) as e:
        _club_scores(spark, "Z", F5)
    assert "DIVIDE_BY_ZERO" in str(e.value) or isinstance(e.value, ArithmeticException)
    assert set(_club_scores(spark, "Z", F5, on_zero="null").values()) == {None}


def test_full_matrix_equals_single_club(spark):
    m = M.matrix_scores(players(spark), teams(spark).where("Club != 'Z'"), {"ALL": F5})
    got = {(r.ID, r.team): r6(r.score) for r in m.collect()}
    assert got[(1, "X")] == 71.111111 and got[(6, "Y")] == 88.0
    assert len(got) == 12


def test_lvp_from_list(spark):
    got = M.lvp_from_list(players(spark), teams(spark), "X", [3, 5], F5).collect()
    assert [r.ID for r in got] == [5]
    got = M.lvp_from_list(players(spark), teams(spark), "X", [], F5).collect()
    assert [r.ID for r in got] == [4]


def test_worst_in_club(spark):
    got = M.worst_in_club(players(spark), teams(spark), "X", "DEF", F5).collect()
    assert [(r.ID, r6(r.score)) for r in got] == [(1, 71.111111)]


def test_mvp_and_unknown_club(spark):
    top = M.mvp_for_team(players(spark), teams(spark), "X", F5, "ALL", k=2).collect()
    assert [r.ID for r in top] == [6, 3]
    assert M.mvp_for_team(players(spark), teams(spark), "nope", F5, "ALL", k=2).count() == 0


def test_k_above_row_count(spark):
    assert M.mvp_for_team(players(spark), teams(spark), "X", F5, "ALL", k=100).count() == 6


def test_null_feature_gives_null_score_sorted_last(spark):
    p = players(spark).withColumn("f1", F.when(F.col("ID") == 6, None).otherwise(F.col("f1")))
    got = M.mvp_for_team(p, teams(spark), "X", F5, "ALL", k=10).collect()
    assert got[-1].ID == 6 and got[-1].score is None


def test_mvt_for_player_and_empty(spark):
    got = M.mvt_for_player(players(spark), teams(spark).where("Club != 'Z'"), F5, "ALL", player_id=1, k=None).collect()
    assert [(r.team, r6(r.score)) for r in got] == [("X", 71.111111), ("Y", 43.5)]
    assert M.mvt_for_player(players(spark), teams(spark), F5, "ALL", player_id=99).count() == 0


def test_vote_tie_break_first_seen(spark):
    rows = [("a", 0, "LB", 0, 0.9), ("b", 1, "LB", 0, 0.8), ("c", 2, "LB", 0, 0.1),
            ("a", 0, "CB", 1, 0.1), ("b", 1, "CB", 1, 0.9), ("c", 2, "CB", 1, 0.8)]
    corr = spark.createDataFrame(rows, "x string, x_idx int, y string, y_idx int, corr double")
    got = vote_features(corr, n_top=2, n_keep=2).orderBy("rank").collect()
    assert [(r.feature, r.votes) for r in got] == [("b", 2), ("a", 1)]


def test_constant_column_never_votes(spark):
    rows = [("a", 0, "LB", 0, None), ("b", 1, "LB", 0, 0.5)]
    corr = spark.createDataFrame(rows, "x string, x_idx int, y string, y_idx int, corr double")
    got = vote_features(corr, n_top=2, n_keep=2).collect()
    assert [r.feature for r in got] == ["b"]


def test_club_filter_parity(spark):
    df = spark.createDataFrame([(1, "X", 27, 60), (2, "X", 28, 61), (3, "Y", 31, 62)],
                               "ID long, Club string, Age int, Overall int")
    got = PJ.club_filter(df, ["X", "Y"], masks=("Age",), parity=True, columns=("ID", "Age")).orderBy("ID").collect()
    assert [r.Age for r in got] == [27, 31]


def test_histogram_clamps_max(spark):
    df = spark.createDataFrame([(1,), (2,), (4,)], "v int")
    got = PR.histogram(df, "v", bins=3).orderBy("bin").collect()
    assert [r["count"] for r in got] == [1, 1, 1]
    assert sum(r.density * (r.bin_hi - r.bin_lo) for r in got) == pytest.approx(1.0)


def test_empty_players(spark):
    empty = players(spark).where("false")
    assert M.mvp_for_team(empty, teams(spark), "X", F5, "ALL").count() == 0
    assert S.similar_players(empty, 3, features=F5).count() == 0
    assert R.replace_mode(empty, teams(spark), "X", features=F5).count() == 0


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("k", [1, 2, 10])
def test_batch_topk_equals_window(spark, k, reverse):
    from pitchside.operators import batch as B

    p = players(spark).withColumn("f3", F.when(F.col("ID").isin(2, 5), None).otherwise(F.col("f3")))
    t = teams(spark)
    groups = {"A": F5, "B": ["f1", "f2"], "C": ["f3", "f5"]}
    for fast, slow in ((B.mvp_all_clubs, M.mvp_all_clubs), (B.mvt_all_players, M.mvt_all_players)):
        a = sorted(map(tuple, fast(p, t, groups, k, reverse, on_zero="null").collect()), key=repr)
        b = sorted(map(tuple, slow(p, t, groups, k, reverse, on_zero="null").collect()), key=repr)
        assert a == b


def test_recommend_dispatch(spark):
    from pitchside.plans.model import ScoutModel, recommend

    m = ScoutModel(players(spark), teams(spark), {"DEF": F5, "MID": F5, "FWD": F5}, "null", 3)
    with pytest.raises(RuntimeError):
        recommend(m)
    assert [r.ID for r in recommend(m, team="X", position="DEF", k=2).collect()] == [6, 3]
    by_name = recommend(m, player="A. One", position="ATK", k=None).collect()
    assert [r.team for r in by_name][:2] == ["X", "Y"] and by_name[-1].score is None
    with pytest.raises(ValueError):
        m.mvp_for_team("X", "GK")


def test_replace_mode_with_null_features_matches_loop(spark):
    p = players(spark).withColumn("f1", F.when(F.col("ID") == 3, None).otherwise(F.col("f1")))
    t = teams(spark)
    fast = [(r.player_id, r.replacement_id, r6(r.improvement)) for r in R.replace_mode(p, t, "X", k=6, features=F5).collect()]
    worst = [r.ID for r in R.weak_players(p, t, "X", features=F5).collect()]
    pairs = []
    for pid in worst:
        pairs += [(pid, r.replacement_id, r6(r.improvement)) for r in R.best_replacements(p, t, "X", pid, k=6, features=F5).collect()]
    pairs.sort(key=lambda x: (x[2] is None, -(x[2] or 0), worst.index(x[0]), x[1]))
    assert fast == pairs[:6]
    assert fast[-1][2] is None


def test_strict_unknown_targets_raise(spark):
    with pytest.raises(ValueError):
        M.mvp_for_team(players(spark), teams(spark), "nope", F5, "ALL", strict=True)
    with pytest.raises(ValueError):
        M.mvt_for_player(players(spark), teams(spark), F5, "ALL", player_id=99, strict=True)
    with pytest.raises(ValueError):
        S.similar_players(players(spark), 99, features=F5, strict=True)


def test_mvp_options(spark):
    only_def = M.mvp_for_team(players(spark), teams(spark), "X", F5, "ALL", k=10, eligible_group="DEF").collect()
    assert sorted(r.ID for r in only_def) == [1, 5]
    outside = M.mvp_for_team(players(spark), teams(spark), "X", F5, "ALL", k=10, exclude_own=True).collect()
    assert sorted(r.ID for r in outside) == [3, 4, 5, 6]   # the NULL club counts as outside


def test_cosine_metric(spark):
    got = S.similar_players(players(spark), 3, k=10, features=F5, metric="cosine").collect()
    # Every constant vector has cosine 1 with the constant target; ties by id.
    assert [r.ID for r in got[:2]] == [4, 6] and r6(got[0].score) == 1.0


def test_fit_on_custom_columns(spark):
    from pitchside.plans.model import fit

    # Ratings named like position codes; features named freely.
    rows = [(i, f"p{i}", "X" if i % 2 else "Y", "CB", float(i), float(i % 5), float(10 - i), float(i), float(-i))
            for i in range(1, 13)]
    p = spark.createDataFrame(rows, "ID long, Name string, Club string, Position string, "
                                    "u double, v double, w double, LB double, ST double")
    m = fit(p, features=["u", "v", "w"], ratings=["LB", "ST"], on_zero="null")
    assert set(m.groups) == {"DEF", "FWD"}
    assert m.groups["DEF"][0] == "u" and m.groups["FWD"][0] == "w"   # LB follows u, ST follows -u
    assert m.all_groups()["ALL"] == ["u", "v", "w"]
    assert m.mvp_for_team("X", "DEF", k=3).count() == 3


def test_matrix_hash_blocks_equal_single_block(spark):
    t = teams(spark).where("Club != 'Z'")
    groups = {"A": F5, "B": ["f1", "f2"]}
    one = sorted(map(tuple, M.matrix_scores(players(spark), t, groups).collect()), key=repr)
    many = sorted(map(tuple, M.matrix_scores(players(spark), t, groups, block_entries=1).collect()), key=repr)
    assert one == many and len(one) == 6 * 2 * 2


def test_batch_in_club_blocks(spark):
    from pitchside.operators import batch as B

    t = teams(spark).where("Club != 'Z'")
    groups = {"A": F5}
    for f in (B.mvp_all_clubs, B.mvt_all_players):
        small, full = f(players(spark), t, groups, 2, block_entries=1), f(players(spark), t, groups, 2)
        cols = sorted(full.columns)
        assert sorted(map(tuple, small.select(cols).collect()), key=repr) == sorted(map(tuple, full.select(cols).collect()), key=repr)


@pytest.mark.parametrize("reverse", [False, True])
def test_batch_topk_in_small_chunks(spark, monkeypatch, reverse):
    from pitchside.operators import batch as B

    monkeypatch.setattr(B, "CHUNK_CELLS", 2)   # one or two players per chunk
    p = players(spark).withColumn("f3", F.when(F.col("ID").isin(2, 5), None).otherwise(F.col("f3")))
    t = teams(spark)
    groups = {"A": F5, "B": ["f1", "f2"]}
    for fast, slow in ((B.mvp_all_clubs, M.mvp_all_clubs), (B.mvt_all_players, M.mvt_all_players)):
        a = sorted(map(tuple, fast(p, t, groups, 2, reverse, on_zero="null").collect()), key=repr)
        b = sorted(map(tuple, slow(p, t, groups, 2, reverse, on_zero="null").collect()), key=repr)
        assert a == b
