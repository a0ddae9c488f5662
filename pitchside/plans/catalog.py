"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each reads the players / teams tables derived from the test tables (written
once per data folder, see ``sources.views.load_views``) and runs one
operator over the whole table. Doubles are rounded to 6 decimals (9 for
correlations) so results compare exactly with the SQL oracle.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import bootstrap as BS
from ..operators import corr as C
from ..operators import matrix as M
from ..operators import profile as PR
from ..operators import projections as PJ
from ..operators import replace as R
from ..operators import similar as S
from ..operators import votes as V
from ..operators.topk import top_k
from ..schema import FEATURES, FIT_X, FIT_YS, NOT_DERIVED, PLAYER_SCHEMA, PROFILE_COLUMNS, RADAR_FEATURES, SCORE_SCALE
from ..session import work_path, stable_key
from ..sources import csv as CSV
from ..sources.views import load_views, table
from .model import fit, recommend

# Query parameters (present at every scale factor).
CLUB = "Brand#1"
PLAYER_ID = 7
LIST_IDS = [3, 17, 42, 101, 150, 199]
SIX_CLUBS = ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5", "Brand#6"]
VEC_ID = 0
K = 10
REPLACE_K = 3
REPLICATES = 200   # of the registered bootstraps; the library's default is 1000
BAND_POINTS = 25
HEX_GRID = "auto"
HOLE_COLUMNS = ["Age", "Crossing", "Finishing", "Dribbling", "Overall"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, scale: int = SCORE_SCALE) -> DataFrame:
    """Round every double column (results compare value by value with the oracle)."""
    return df.select(*[
        F.round(F.col(f.name), scale).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _players(spark, sf_dir):
    return load_views(spark, sf_dir)[0]


def _teams(spark, sf_dir):
    return load_views(spark, sf_dir)[1]


_MODELS: dict = {}
_LOCK = threading.RLock()


def _model(spark, sf_dir):
    """The fitted model, once per application and data folder (fit, then query many times)."""
    memo = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        return _fitted(spark, sf_dir, memo)


def _fitted(spark, sf_dir, memo):
    if memo not in _MODELS:
        players, teams = load_views(spark, sf_dir)
        # A zero club mean gives NULL scores for that club (sf0.001 has two) instead of an error.
        _MODELS[memo] = fit(players, teams, on_zero="null")
    return _MODELS[memo]


_CSV: dict = {}


def _players_csv(spark, sf_dir) -> str:
    """The players table written once as a header CSV file (the reference's input format)."""
    memo = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if memo not in _CSV:
            path = work_path(spark, "csv", stable_key(sf_dir), "players")
            CSV.write_players(_players(spark, sf_dir), path)
            _CSV[memo] = path
        return _CSV[memo]


# --- sources -------------------------------------------------------------

@query
def scan_players(spark, sf_dir):
    return rounded(CSV.read_players(spark, _players_csv(spark, sf_dir)))


@query
def scan_blank_as_empty(spark, sf_dir):
    return rounded(CSV.blanks_as_empty(CSV.read_players(spark, _players_csv(spark, sf_dir))))


@query
def scan_strict(spark, sf_dir):
    return rounded(CSV.read_strict(spark, _players_csv(spark, sf_dir)))


@query
def scan_malformed_count(spark, sf_dir):
    return CSV.count_malformed(spark, _players_csv(spark, sf_dir))


_RAW_CSV: dict = {}
RAW_SCHEMA = T.StructType([PLAYER_SCHEMA[c] for c in ("ID", "Name", "Club", "Overall")])


def _raw_csv(spark, sf_dir) -> str:
    """Four player columns as a less tidy CSV: another column order, commas inside quotes, blank clubs, bad numbers.

    ID mod 10 is 3: no Club; 5: Overall is no number.
    """
    memo = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if memo not in _RAW_CSV:
            path = work_path(spark, "csv", stable_key(sf_dir), "raw")
            m = F.col("ID") % 10
            CSV.write_players(_players(spark, sf_dir).select(
                F.when(m == 5, F.lit("bad")).otherwise(F.col("Overall").cast("string")).alias("Overall"),
                F.concat("Name", F.lit(", Jr.")).alias("Name"), "ID", F.when(m != 3, F.col("Club")).alias("Club")), path)
            _RAW_CSV[memo] = path
        return _RAW_CSV[memo]


@query
def scan_untidy(spark, sf_dir):
    """Columns matched by header name, quoting, blanks as NULL, records with a bad number left out."""
    return CSV.read_strict(spark, _raw_csv(spark, sf_dir), RAW_SCHEMA)


@query
def scan_untidy_malformed(spark, sf_dir):
    return CSV.count_malformed(spark, _raw_csv(spark, sf_dir), RAW_SCHEMA)


@query
def scan_untidy_ledger(spark, sf_dir):
    """Every rejected record with the column and the reason."""
    return CSV.reject_ledger(spark, _raw_csv(spark, sf_dir), RAW_SCHEMA).drop("file")


@query
def scan_untidy_rejects(spark, sf_dir):
    """The rejected fields by column and reason."""
    return CSV.reject_counts(CSV.reject_ledger(spark, _raw_csv(spark, sf_dir), RAW_SCHEMA))


@query
def scan_inferred(spark, sf_dir):
    """Types inferred from the data (opt-in)."""
    df = CSV.read_players(spark, _players_csv(spark, sf_dir), schema=None)
    return df.select(F.col("ID").cast("long").alias("ID"), "Name", "Club", F.col("Overall").cast("int").alias("Overall"), F.round("Crossing", SCORE_SCALE).alias("Crossing"))


@query
def preview(spark, sf_dir):
    return rounded(PR.preview(_players(spark, sf_dir)))


@query
def table_info(spark, sf_dir):
    return PR.table_info(_players(spark, sf_dir))


# --- projections and filters ---------------------------------------------

@query
def project_features(spark, sf_dir):
    return rounded(PJ.project_features(_players(spark, sf_dir)))


@query
def project_range(spark, sf_dir):
    return rounded(PJ.project_range(_players(spark, sf_dir), "LS", "RB"))


@query
def project_ordinal(spark, sf_dir):
    return PJ.project_ordinal(_players(spark, sf_dir), 1, keep=("ID",))


@query
def unpivot_features(spark, sf_dir):
    return rounded(PJ.unpivot_features(_teams(spark, sf_dir)))


@query
def lookup_player(spark, sf_dir):
    return PJ.lookup_player(_players(spark, sf_dir), PLAYER_ID)


@query
def club_in_list(spark, sf_dir):
    return PJ.club_in_list(_players(spark, sf_dir), SIX_CLUBS)


@query
def club_filter_parity(spark, sf_dir):
    return PJ.club_filter(_players(spark, sf_dir), SIX_CLUBS, masks=("Age", "Overall"), parity=True)


@query
def club_filter_nonnull(spark, sf_dir):
    return PJ.club_filter(_players(spark, sf_dir), SIX_CLUBS, masks=("Age", "Overall"), parity=False)


@query
def group_position(spark, sf_dir):
    return PJ.with_group(_players(spark, sf_dir)).select("ID", "Position", "GroupPosition")


# --- joins / matrix --------------------------------------------------------

@query
def matrix_scores(spark, sf_dir):
    return rounded(_model(spark, sf_dir).matrix())


@query
def matrix_raw_dot(spark, sf_dir):
    players, teams = load_views(spark, sf_dir)
    return rounded(M.raw_dot(players, teams).select("ID", "team", "score"))


@query
def reciprocal_weights(spark, sf_dir):
    w = M.team_weights(_teams(spark, sf_dir), FEATURES, on_zero="null")
    return rounded(w.unpivot(["Club"], FEATURES, "feature", "weight"))


# --- aggregates -------------------------------------------------------------

@query
def topk(spark, sf_dir):
    p = _players(spark, sf_dir).select("ID", "Name", "Overall")
    return top_k(p, K, "Overall", round_to=None)


@query
def club_means(spark, sf_dir):
    return rounded(_teams(spark, sf_dir))


@query
def embedding_means(spark, sf_dir):
    df = PR.vector_group_means(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return df.select("label", "n", F.transform("mean", lambda x: F.round(x, SCORE_SCALE)).alias("mean"))


@query
def club_means_int(spark, sf_dir):
    t = _teams(spark, sf_dir)
    return t.select("Club", *[F.col(f).cast("int").alias(f) for f in FEATURES])


@query
def clubs_age_sum_top(spark, sf_dir):
    return rounded(PR.clubs_age_sum(_players(spark, sf_dir), 5, ascending=False))


@query
def clubs_age_sum_bottom(spark, sf_dir):
    return rounded(PR.clubs_age_sum(_players(spark, sf_dir), 5, ascending=True))


@query
def position_means(spark, sf_dir):
    return rounded(PR.group_means(_players(spark, sf_dir), "Position", FEATURES))


@query
def club_overall_ci(spark, sf_dir):
    return rounded(PR.club_overall_ci(_players(spark, sf_dir)))


@query
def position_counts(spark, sf_dir):
    return PR.value_counts(_players(spark, sf_dir), "Position")


@query
def nunique(spark, sf_dir):
    return PR.nunique(_players(spark, sf_dir))


@query
def null_flags(spark, sf_dir):
    return PR.null_flags(_players(spark, sf_dir))


@query
def describe(spark, sf_dir):
    return rounded(PR.describe(_players(spark, sf_dir)))   # every numeric column


@query
def corr_matrix(spark, sf_dir):
    p = _players(spark, sf_dir)
    return rounded(C.corr_matrix(p, PJ.col_range(p, "LS", "SlidingTackle")), 9)


@query
def corr_with_overall(spark, sf_dir):
    return rounded(C.corr_matrix(_players(spark, sf_dir), FEATURES + ["Overall"]), 9)


@query
def corr_profile(spark, sf_dir):
    p = _players(spark, sf_dir)
    listed = [c for c in PROFILE_COLUMNS if c not in NOT_DERIVED]
    return rounded(C.corr_matrix(p, C.numeric_columns(p, listed)), 9)


@query
def corr_top_for_rating(spark, sf_dir):
    return rounded(C.corr_top_for_rating(_players(spark, sf_dir), "LB", FEATURES, 5), 9)


@query
def feature_votes(spark, sf_dir):
    return V.feature_votes(_players(spark, sf_dir))


@query
def age_histogram(spark, sf_dir):
    return rounded(PR.histogram(_players(spark, sf_dir), "Age"))


@query
def club_age_quartiles(spark, sf_dir):
    return rounded(PR.group_quartiles(_players(spark, sf_dir), "Club", "Age"))


@query
def club_age_density(spark, sf_dir):
    return rounded(PR.group_density(_players(spark, sf_dir), "Club", "Age"))


@query
def club_overall_bootstrap(spark, sf_dir):
    return rounded(BS.club_bootstrap_ci(_players(spark, sf_dir), replicates=REPLICATES))


@query
def linear_fit_bands(spark, sf_dir):
    return rounded(BS.fit_bands(_players(spark, sf_dir), FIT_X, FIT_YS, points=BAND_POINTS, replicates=REPLICATES))


@query
def linear_fits(spark, sf_dir):
    return rounded(PR.linear_fits(_players(spark, sf_dir), FIT_X, FIT_YS))


@query
def hexbin_counts(spark, sf_dir):
    return PR.hexbin_counts(_players(spark, sf_dir), "Dribbling", "Crossing", HEX_GRID)


@query
def scatter_grid(spark, sf_dir):
    return rounded(PR.scatter_grid(_players(spark, sf_dir), "Crossing", "Dribbling", "Finishing"))


# --- sorts, top-K, recommendations -----------------------------------------

@query
def oldest_players(spark, sf_dir):
    return PR.extreme_rows(_players(spark, sf_dir), "Age", 10, ascending=False)


@query
def youngest_players(spark, sf_dir):
    return PR.extreme_rows(_players(spark, sf_dir), "Age", 10, ascending=True)


@query
def position_top_features(spark, sf_dir):
    means = PR.group_means(_players(spark, sf_dir), "Position", FEATURES)
    return rounded(V.top_columns_per_row(means, "Position", FEATURES, 3))


@query
def position_radar_features(spark, sf_dir):
    means = PR.group_means(_players(spark, sf_dir), "Position", RADAR_FEATURES)
    return rounded(V.top_columns_per_row(means, "Position", RADAR_FEATURES, 5))


@query
def similar_players(spark, sf_dir):
    return rounded(S.similar_players(_players(spark, sf_dir), PLAYER_ID, k=K))


@query
def similar_embeddings(spark, sf_dir):
    return rounded(S.similar_embeddings(table(spark, sf_dir, "embeddings"), VEC_ID, k=K))


@query
def weak_features(spark, sf_dir):
    return rounded(R.weak_features(_teams(spark, sf_dir)))


@query
def weight_vector(spark, sf_dir):
    return rounded(R.weight_vector(_teams(spark, sf_dir)))


@query
def weak_players(spark, sf_dir):
    players, teams = load_views(spark, sf_dir)
    return rounded(R.weak_players(players, teams, CLUB))


@query
def weak_players_asc(spark, sf_dir):
    players, teams = load_views(spark, sf_dir)
    return rounded(R.weak_players(players, teams, CLUB, ascending=True))


@query
def best_replacements(spark, sf_dir):
    players, teams = load_views(spark, sf_dir)
    return rounded(R.best_replacements(players, teams, CLUB, PLAYER_ID, k=K))


@query
def replace_mode(spark, sf_dir):
    players, teams = load_views(spark, sf_dir)
    return rounded(R.replace_mode(players, teams, CLUB, k=REPLACE_K))


@query
def replace_all_clubs(spark, sf_dir):
    players, teams = load_views(spark, sf_dir)
    return rounded(R.replace_all_clubs(players, teams, k=REPLACE_K))


@query
def mvp_for_team(spark, sf_dir):
    return rounded(_model(spark, sf_dir).mvp_for_team(CLUB, "DEF", K))


@query
def lvp_for_team(spark, sf_dir):
    return rounded(_model(spark, sf_dir).mvp_for_team(CLUB, "DEF", K, reverse=True))


@query
def mvt_for_player(spark, sf_dir):
    return rounded(_model(spark, sf_dir).mvt_for_player("ATK", player_id=PLAYER_ID, k=K))


@query
def lvt_for_player(spark, sf_dir):
    return rounded(_model(spark, sf_dir).mvt_for_player("ATK", player_id=PLAYER_ID, k=K, reverse=True))


@query
def mvt_for_player_all(spark, sf_dir):
    return rounded(_model(spark, sf_dir).mvt_for_player("MID", player_id=PLAYER_ID, k=None))


@query
def worst_in_club(spark, sf_dir):
    return rounded(_model(spark, sf_dir).worst_in_club("DEF", CLUB))


@query
def lvp_from_list(spark, sf_dir):
    return rounded(_model(spark, sf_dir).lvp_from_list(LIST_IDS, CLUB))


@query
def lvp_all(spark, sf_dir):
    return rounded(_model(spark, sf_dir).lvp_from_list([], CLUB))


@query
def recommend_players(spark, sf_dir):
    return rounded(recommend(_model(spark, sf_dir), team=CLUB, position="DEF", k=K))


@query
def recommend_clubs(spark, sf_dir):
    return rounded(recommend(_model(spark, sf_dir), player=PLAYER_ID, position="ATK", k=K))


@query
def select_ids(spark, sf_dir):
    return PJ.select_ids(_players(spark, sf_dir), LIST_IDS).select("ID", "Name", "Club", "Overall")


@query
def select_ids_joined(spark, sf_dir):
    """Ids that come as a table: the parts with an even size."""
    ids = table(spark, sf_dir, "part").where(F.col("p_size") % 2 == 0).select(F.col("p_partkey").cast("long").alias("ID"))
    return PJ.select_ids(_players(spark, sf_dir), ids).select("ID", "Name", "Club", "Overall")


def _with_holes(spark, sf_dir):
    """Players without Age (ID mod 7 is 0), Club (mod 9), Crossing (mod 5) and Finishing (mod 4)."""
    holes = {"Age": 7, "Club": 9, "Crossing": 5, "Finishing": 4}
    return _players(spark, sf_dir).withColumns({c: F.when(F.col("ID") % m != 0, F.col(c)) for c, m in holes.items()})


@query
def null_flags_holes(spark, sf_dir):
    return PR.null_flags(_with_holes(spark, sf_dir))


@query
def corr_holes(spark, sf_dir):
    """Pairwise-complete correlations of columns with NULLs."""
    return rounded(C.corr_matrix(_with_holes(spark, sf_dir), HOLE_COLUMNS), 9)


@query
def mvp_all_clubs(spark, sf_dir):
    return rounded(_model(spark, sf_dir).mvp_all_clubs(K))


@query
def mvt_all_players(spark, sf_dir):
    return rounded(_model(spark, sf_dir).mvt_all_players(K))
