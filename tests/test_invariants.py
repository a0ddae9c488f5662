
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pitchside.operators import corr as C
from pitchside.operators import profile as PR
from pitchside.operators import replace as R
from pitchside.plans.catalog import CLUB, _model
from pitchside.schema import FEATURES, GROUP_PATTERNS, RATINGS
from pitchside.sources.views import load_views


@pytest.fixture(scope="module")
def views(spark):
    return load_views(spark, SF001)


@pytest.fixture(scope="module")
def model(spark):
    return _model(spark, SF001)


def test_weights_total_ten_and_few_weak(views):
    _, teams = views
    rows = R.weight_vector(teams).groupBy("Club").agg(
        F.sum("weight").alias("total"), F.sum(F.col("weak").cast("int")).alias("n_weak")
    ).collect()
    assert len(rows) == 25
    for r in rows:
        assert r.total == pytest.approx(10.0)
        assert r.n_weak <= len(FEATURES) // 4


def test_corr_symmetric_and_bounded(views):
    players, _ = views
    m = {(r.x, r.y): r.corr for r in C.corr_matrix(players, FEATURES[:6] + ["Overall"]).collect()}
    for (x, y), v in m.items():
        assert -1.0 - 1e-12 <= v <= 1.0 + 1e-12
        assert v == pytest.approx(m[(y, x)], abs=1e-12)
        if x == y:
            assert v == pytest.approx(1.0)


def test_corr_ml_equals_pairwise(views):
    players, _ = views
    cols = FEATURES[:5] + ["LS", "RB"]
    a = {(r.x, r.y): r.corr for r in C.corr_matrix(players, cols, "ml").collect()}
    b = {(r.x, r.y): r.corr for r in C.corr_matrix(players, cols, "pairwise").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-12)


def test_histogram_integrates_to_one(views):
    players, _ = views
    rows = PR.histogram(players, "Age").collect()
    assert len(rows) == 60
    assert sum(r.density * (r.bin_hi - r.bin_lo) for r in rows) == pytest.approx(1.0)
    assert sum(r["count"] for r in rows) == players.count()


def test_single_club_equals_batch_slice(model):
    one = {(r.ID, r["rank"]) for r in model.mvp_for_team(CLUB, "DEF", 10).collect()}
    batch = {(r.ID, r["rank"]) for r in model.mvp_all_clubs(10).where((F.col("team") == CLUB) & (F.col("grp") == "DEF")).collect()}
    assert one == batch


def test_single_player_equals_matrix_slice(model):
    one = {(r.team, round(r.score, 9)) for r in model.mvt_for_player("MID", player_id=7, k=None).collect()}
    m = model.matrix().where((F.col("ID") == 7) & (F.col("grp") == "MID"))
    assert one == {(r.team, round(r.score, 9)) for r in m.collect()}


def test_replace_mode_equals_reference_loop(views):
    players, teams = views
    fast = [(r.player_id, r.replacement_id, round(r.improvement, 6)) for r in R.replace_mode(players, teams, CLUB, k=3).collect()]
    worst = [r.ID for r in R.weak_players(players, teams, CLUB).collect()]
    pairs = []
    for pid in worst:   # the reference's loop: best K per weak player, then global best K
        pairs += [(pid, r.replacement_id, round(r.improvement, 6))
                  for r in R.best_replacements(players, teams, CLUB, pid, k=3).collect()]
    pairs.sort(key=lambda t: (-t[2], worst.index(t[0]), t[1]))
    assert fast == pairs[:3]


def test_votes_equal_pandas_counter(spark, views, model):
    players, _ = views
    pdf = players.select(*FEATURES, *RATINGS).toPandas()
    corr = pdf.corr()
    counters = {g: Counter() for g, _ in GROUP_PATTERNS}
    for rating in RATINGS:
        top = corr.loc[FEATURES, rating].round(10).nlargest(12).index
        for g, pat in GROUP_PATTERNS:
            if re.match(pat, rating):
                for f in top:
                    counters[g][f] += 1
    expected = {g: [f for f, _ in c.most_common(12)] for g, c in counters.items()}
    assert model.groups == expected


def test_pairwise_corr_with_gaps_matches_pandas(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    n = 400
    a = rng.normal(size=n) * 100 + 1e6
    pdf = pd.DataFrame({"a": a, "b": a * 0.5 + rng.normal(size=n), "c": rng.normal(size=n), "k": np.full(n, 7.0)})
    for col, frac in (("a", 0.1), ("b", 0.2), ("c", 0.05)):
        pdf.loc[rng.random(n) < frac, col] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double").repartition(3)
    got = {(r.x, r.y): r.corr for r in C.corr_matrix(df, ["a", "b", "c", "k"]).collect()}   # auto -> pairwise
    exp = pdf.corr()
    for (x, y), v in got.items():
        if np.isnan(exp.loc[x, y]):
            assert v is None
        else:
            assert v == pytest.approx(exp.loc[x, y], abs=1e-9)


@pytest.fixture(scope="module")
def players_pdf(views):
    return views[0].toPandas()


def test_describe_equals_pandas(views, players_pdf):
    cols = ["ID", "Age", "Overall", "Crossing", "LS"]
    got = {r.column: r for r in PR.describe(views[0], cols).collect()}
    exp = players_pdf[cols].describe()
    for c in cols:
        e = exp[c]
        r = got[c]
        assert r["count"] == e["count"]
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"),
                             ("q75", "75%"), ("max", "max")):
            assert r[mine] == pytest.approx(e[theirs], rel=1e-12, abs=1e-9), (c, mine)


def test_nunique_and_nulls_equal_pandas(views, players_pdf):
    got = {r.column: r.nunique for r in PR.nunique(views[0]).collect()}
    assert got == players_pdf.nunique().to_dict()
    flags = {r.column: r.has_null for r in PR.null_flags(views[0]).collect()}
    assert flags == players_pdf.isnull().any().to_dict()


def test_position_top3_equals_pandas_nlargest(views, players_pdf):
    from pitchside.operators.votes import top_columns_per_row

    means = PR.group_means(views[0], "Position", FEATURES)
    got = {}
    for r in top_columns_per_row(means, "Position", FEATURES, 3).orderBy("Position", "rank").collect():
        got.setdefault(r.Position, []).append(r.feature)
    exp = {pos: list(row.nlargest(3).index) for pos, row in players_pdf.groupby("Position")[FEATURES].mean().iterrows()}
    assert got == exp


def test_age_histogram_equals_numpy(views, players_pdf):
    import numpy as np

    counts, edges = np.histogram(players_pdf["Age"].to_numpy(dtype=float), 60)
    dens, _ = np.histogram(players_pdf["Age"].to_numpy(dtype=float), 60, density=True)
    got = PR.histogram(views[0], "Age").orderBy("bin").collect()
    assert [r["count"] for r in got] == list(counts)
    assert [r.bin_lo for r in got] == pytest.approx(list(edges[:-1]))
    assert [r.density for r in got] == pytest.approx(list(dens))


def test_hexbin_of_one_row_and_of_missing_partners(spark):
    from pitchside.operators import profile as PR

    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert [r["count"] for r in PR.hexbin_counts(one, "x", "y", "auto").collect()] == [1]
    rows = [(float(i % 7), float(i % 5)) for i in range(60)]
    plain = spark.createDataFrame(rows, "x double, y double")
    more = spark.createDataFrame(rows + [(1000.0, None), (None, -1000.0)], "x double, y double")
    for grid in (10, "auto"):
        assert sorted(PR.hexbin_counts(plain, "x", "y", grid).collect()) == sorted(PR.hexbin_counts(more, "x", "y", grid).collect())


def test_numeric_columns_raise_when_absent(spark):
    import pytest

    from pitchside.operators.corr import numeric_columns

    df = spark.createDataFrame([(1, "a")], "x int, s string")
    assert numeric_columns(df, ["x", "s"]) == ["x"]
    with pytest.raises(KeyError, match="gone"):
        numeric_columns(df, ["x", "gone"])


def test_batch_top_k_by_blocks_equals_one_block(spark):
    """More clubs than one block: the same rows, and nothing is written."""
    import random

    from pitchside.operators import batch as B, matrix as M

    r = random.Random(3)
    feats = ["a", "b"]
    players = spark.createDataFrame([(i, f"p{i}", f"c{i % 9}", r.random(), r.random()) for i in range(120)], "ID long, Name string, Club string, a double, b double")
    teams = spark.createDataFrame([(f"c{i}", 0.1 + r.random(), 0.1 + r.random()) for i in range(40)], "Club string, a double, b double")
    groups = {"G": feats}
    for f in (B.mvp_all_clubs, B.mvt_all_players):
        one, many = f(players, teams, groups, 3), f(players, teams, groups, 3, block_entries=7)
        cols = sorted(one.columns)
        assert sorted(map(tuple, one.select(cols).collect())) == sorted(map(tuple, many.select(cols).collect()))
    whole = M.matrix_scores(players, teams, groups, block_entries=7)
    assert "Scan parquet" not in whole._jdf.queryExecution().toString() and whole.count() == 120 * 40
