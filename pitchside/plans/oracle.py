"""DuckDB SQL oracle for every registered query.

Written independently of the Spark code: each statement starts from the raw
test tables (``part``, ``nation``, ``lineitem``, ``embeddings``) through the
``players`` / ``teams`` CTEs of FIXTURES.md section 2, and states the
operator in plain SQL. Doubles are rounded like the Spark side (6 decimals,
9 for correlations); ranking uses the rounded score, then ids.
"""

from __future__ import annotations

from ..schema import FEATURES, FIT_X, FIT_YS, PROFILE_COLUMNS, RADAR_FEATURES, RATINGS
from ..operators.bootstrap import PIECES, SEED, poisson_steps
from .catalog import BAND_POINTS, CLUB, HOLE_COLUMNS, K, LIST_IDS, PLAYER_ID, REPLACE_K, REPLICATES, SIX_CLUBS, VEC_ID


def q(name: str) -> str:
    return '"' + name + '"'


def _sql_list(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


POSITIONS = RATINGS + ["GK"]
NUMERIC = ["ID", "Age", "Overall", "Height_cm", "Weight_lbs", *RATINGS, *FEATURES]
PLAYER_COLS = ["ID", "Name", "Age", "Nationality", "Overall", "Club", "Position", "Height_cm", "Weight_lbs",
               *RATINGS, *FEATURES]


def _base_ctes() -> str:
    rating_sums = ",\n    ".join(
        f"SUM(CASE WHEN (l_orderkey + l_suppkey) % 26 = {i} THEN l_quantity END) AS {q(c)}" for i, c in enumerate(RATINGS)
    )
    feature_sums = ",\n    ".join(
        f"SUM(CASE WHEN l_orderkey % 29 = {i} THEN l_quantity END) AS {q(c)}" for i, c in enumerate(FEATURES)
    )
    coalesced = ",\n    ".join(f"COALESCE(li.{q(c)}, 0.0) AS {q(c)}" for c in RATINGS + FEATURES)
    means = ",\n    ".join(f"AVG({q(c)}) AS {q(c)}" for c in FEATURES)
    return f"""li AS MATERIALIZED (
  SELECT l_partkey,
    {rating_sums},
    {feature_sums}
  FROM lineitem GROUP BY l_partkey
),
players AS MATERIALIZED (
  SELECT CAST(p.p_partkey AS BIGINT) AS "ID", p.p_name AS "Name", CAST(p.p_size AS INTEGER) AS "Age",
    n.n_name AS "Nationality", CAST(round(p.p_retailprice - 850) AS INTEGER) AS "Overall",
    p.p_brand AS "Club", [{_sql_list(POSITIONS)}][CAST(p.p_partkey % 27 AS INTEGER) + 1] AS "Position",
    CAST(150 + p.p_size AS INTEGER) AS "Height_cm", CAST(100 + 2 * p.p_size AS INTEGER) AS "Weight_lbs",
    {coalesced}
  FROM part p
  LEFT JOIN li ON li.l_partkey = p.p_partkey
  LEFT JOIN nation n ON n.n_nationkey = p.p_partkey % 25
),
teams AS MATERIALIZED (
  SELECT "Club",
    {means}
  FROM players WHERE "Club" IS NOT NULL GROUP BY "Club"
)"""


def _index_table(name: str, col: str, values) -> str:
    rows = ", ".join(f"('{v}', {i})" for i, v in enumerate(values))
    return f"{name} AS (SELECT * FROM (VALUES {rows}) t({col}, {col}_idx))"


GROUP_CASE = """CASE WHEN regexp_full_match({c}, '\\w*B') THEN 'DEF'
         WHEN regexp_full_match({c}, '\\w*M') THEN 'MID'
         WHEN regexp_full_match({c}, '\\w*[FSTW]') THEN 'FWD' END"""


def _long(table: str, key: str, cols, name: str, value: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {q(key)} AS {q(key)}, '{c}' AS {name}, CAST({q(c)} AS DOUBLE) AS {value} FROM {table}" for c in cols
    )
    return parts


def _vote_ctes() -> str:
    """Correlation of each feature with each rating, top 12 per rating, top 12 voted per group."""
    return f""",
{_index_table("fidx", "feature", FEATURES)},
{_index_table("ridx", "rating", RATINGS)},
plong AS ({_long("players", "ID", FEATURES, "feature", "fv")}),
rlong AS ({_long("players", "ID", RATINGS, "rating", "rv")}),
corrs AS (
  SELECT rating, feature, corr(fv, rv) AS c FROM plong JOIN rlong USING ("ID") GROUP BY rating, feature
),
ranked AS (
  SELECT r.rating, ri.rating_idx, {GROUP_CASE.format(c="r.rating")} AS grp, r.feature, fi.feature_idx,
    row_number() OVER (PARTITION BY r.rating ORDER BY round(r.c, 10) DESC, fi.feature_idx) AS rk
  FROM corrs r JOIN ridx ri USING (rating) JOIN fidx fi USING (feature)
  WHERE r.c IS NOT NULL AND NOT isnan(r.c)
),
voted AS (
  SELECT grp, feature, count(*) AS votes, min(rating_idx * 1000 + rk) AS first_key,
    arg_min(rating_idx, rating_idx * 1000 + rk) AS first_rating_idx, arg_min(rk, rating_idx * 1000 + rk) AS first_rank
  FROM ranked WHERE rk <= 12 AND grp IS NOT NULL GROUP BY grp, feature
),
gfeat AS (
  SELECT grp, feature, votes, first_rating_idx, first_rank,
    row_number() OVER (PARTITION BY grp ORDER BY votes DESC, first_key) AS rank
  FROM voted QUALIFY rank <= 12
),
groupfeat AS (
  SELECT grp, feature FROM gfeat UNION ALL SELECT 'ALL' AS grp, feature FROM fidx
),
tlong AS ({_long("teams", "Club", FEATURES, "feature", "tv")})"""


def with_views(body: str, votes: bool = False) -> str:
    return "WITH " + _base_ctes() + (_vote_ctes() if votes else "") + "\n" + body


def r6(expr: str, alias: str, scale: int = 6) -> str:
    return f"round({expr}, {scale}) AS {q(alias)}"


def _all_cols_rounded(cols=PLAYER_COLS) -> str:
    doubles = set(RATINGS + FEATURES)
    return ", ".join(r6(q(c), c) if c in doubles else q(c) for c in cols)


ORACLE_SQL: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE_SQL[name] = sql


# --- sources / projections ---------------------------------------------------

oracle("scan_players", with_views(f"SELECT {_all_cols_rounded()} FROM players"))
oracle("scan_strict", with_views(f"SELECT {_all_cols_rounded()} FROM players"))
oracle("scan_blank_as_empty", with_views(
    "SELECT " + ", ".join(
        f"COALESCE({q(c)}, '') AS {q(c)}" if c in ("Name", "Nationality", "Club", "Position")
        else (r6(q(c), c) if c in RATINGS + FEATURES else q(c))
        for c in PLAYER_COLS
    ) + " FROM players"))
oracle("preview", with_views(f"SELECT {_all_cols_rounded()} FROM players ORDER BY \"ID\" LIMIT 5"))

_dtypes = {"ID": "bigint", "Name": "string", "Age": "int", "Nationality": "string", "Overall": "int",
           "Club": "string", "Position": "string", "Height_cm": "int", "Weight_lbs": "int"}
oracle("table_info", with_views(" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{_dtypes.get(c, 'double')}' AS dtype, "
    f"count({q(c)}) AS non_null, count(*) AS \"rows\" FROM players"
    for i, c in enumerate(PLAYER_COLS))))

oracle("scan_malformed_count", with_views('SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS malformed FROM players'))
oracle("project_ordinal", with_views('SELECT "ID", "Name" FROM players'))
oracle("project_features", with_views(f"SELECT {_all_cols_rounded(['ID', *FEATURES])} FROM players"))
oracle("project_range", with_views(f"SELECT {_all_cols_rounded(['ID', *RATINGS])} FROM players"))
oracle("unpivot_features", with_views(
    " UNION ALL ".join(f"SELECT \"Club\", '{f}' AS feature, round({q(f)}, 6) AS value FROM teams" for f in FEATURES)))
oracle("lookup_player", with_views(
    f"SELECT \"ID\", \"Name\", \"Age\", \"Nationality\", \"Overall\", \"Club\", \"Position\" FROM players WHERE \"ID\" = {PLAYER_ID}"))
_six = _sql_list(SIX_CLUBS)
oracle("club_in_list", with_views(
    f"SELECT \"ID\", \"Name\", \"Club\", \"Age\", \"Overall\" FROM players WHERE \"Club\" IN ({_six})"))
oracle("club_filter_parity", with_views(
    f"SELECT \"ID\", \"Name\", \"Club\", \"Age\", \"Overall\" FROM players WHERE \"Club\" IN ({_six}) "
    "AND \"Age\" % 2 = 1 AND \"Overall\" % 2 = 1"))
oracle("club_filter_nonnull", with_views(
    f"SELECT \"ID\", \"Name\", \"Club\", \"Age\", \"Overall\" FROM players WHERE \"Club\" IN ({_six}) "
    "AND \"Age\" IS NOT NULL AND \"Overall\" IS NOT NULL"))
oracle("group_position", with_views(
    f"SELECT \"ID\", \"Position\", {GROUP_CASE.format(c='\"Position\"')} AS \"GroupPosition\" FROM players"))

# --- matrix ---------------------------------------------------------------------

_SCORES = """,
scores AS (
  SELECT p."ID", p."Name", p."Club", t."Club" AS team, g.grp,
    CASE WHEN bool_or(t.tv = 0 OR t.tv IS NULL OR p.fv IS NULL) THEN NULL ELSE SUM(p.fv / t.tv) END AS score
  FROM groupfeat g
  JOIN (SELECT pl.*, pp."Name", pp."Club" FROM plong pl JOIN players pp USING ("ID")) p ON p.feature = g.feature
  JOIN tlong t ON t.feature = g.feature
  {where}
  GROUP BY p."ID", p."Name", p."Club", t."Club", g.grp
)
"""


def with_scores(body: str, where: str = "") -> str:
    return "WITH " + _base_ctes() + _vote_ctes() + _SCORES.format(where=where) + body


oracle("matrix_scores", with_scores(
    "SELECT \"ID\", \"Name\", \"Club\", team, grp, round(score, 6) AS score FROM scores"))
oracle("matrix_raw_dot", with_views(
    "SELECT p.\"ID\", t.\"Club\" AS team, round(" + " + ".join(f"p.{q(f)} * t.{q(f)}" for f in FEATURES)
    + ", 6) AS score FROM players p, teams t", votes=False))
oracle("reciprocal_weights", with_views(
    " UNION ALL ".join(f"SELECT \"Club\", '{f}' AS feature, round(1.0 / nullif({q(f)}, 0), 6) AS weight FROM teams" for f in FEATURES)))

# --- aggregates -----------------------------------------------------------------

oracle("topk", with_views(
    f"SELECT \"ID\", \"Name\", \"Overall\", CAST(row_number() OVER (ORDER BY \"Overall\" DESC, \"ID\") AS INTEGER) AS rank "
    f"FROM players ORDER BY \"Overall\" DESC, \"ID\" LIMIT {K}"))
oracle("club_means", with_views(
    "SELECT \"Club\", " + ", ".join(r6(q(f), f) for f in FEATURES) + " FROM teams"))
oracle("embedding_means", """WITH e AS (
  SELECT label, CAST(x AS DOUBLE) AS x, i FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, i)
  WHERE label IS NOT NULL
), m AS (SELECT label, i, avg(x) AS m, count(x) AS n FROM e GROUP BY label, i)
SELECT label, max(n) AS n, list(round(m, 6) ORDER BY i) AS mean FROM m GROUP BY label""")
oracle("club_means_int", with_views(
    "SELECT \"Club\", " + ", ".join(f"CAST(trunc({q(f)}) AS INTEGER) AS {q(f)}" for f in FEATURES) + " FROM teams"))
for _name, _dir in (("clubs_age_sum_top", "DESC"), ("clubs_age_sum_bottom", "ASC")):
    oracle(_name, with_views(
        f"""SELECT "Club", age_sum, round(age_mean, 6) AS age_mean, players,
  CAST(row_number() OVER (ORDER BY age_sum {_dir}, "Club") AS INTEGER) AS rank
FROM (SELECT "Club", CAST(sum("Age") AS BIGINT) AS age_sum, avg("Age") AS age_mean, count(*) AS players
      FROM players WHERE "Club" IS NOT NULL GROUP BY "Club")
ORDER BY age_sum {_dir}, "Club" LIMIT 5"""))
oracle("position_means", with_views(
    "SELECT \"Position\", " + ", ".join(r6(f"avg({q(f)})", f) for f in FEATURES)
    + " FROM players WHERE \"Position\" IS NOT NULL GROUP BY \"Position\""))
oracle("club_overall_ci", with_views(
    """SELECT "Club", round(m, 6) AS mean, round(s, 6) AS std, n,
  round(m - 1.96 * s / sqrt(n), 6) AS ci_low, round(m + 1.96 * s / sqrt(n), 6) AS ci_high
FROM (SELECT "Club", avg("Overall") AS m, stddev_samp("Overall") AS s, count("Overall") AS n
      FROM players WHERE "Club" IS NOT NULL GROUP BY "Club")"""))
oracle("position_counts", with_views("SELECT \"Position\", count(*) AS count FROM players GROUP BY \"Position\""))
oracle("nunique", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {q(c)}) AS nunique FROM players" for c in PLAYER_COLS)))
oracle("null_flags", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", coalesce(bool_or({q(c)} IS NULL), false) AS has_null FROM players" for c in PLAYER_COLS)))
oracle("describe", with_views(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({q(c)}) AS count, round(avg({q(c)}), 6) AS mean,
  round(stddev_samp({q(c)}), 6) AS std, round(CAST(min({q(c)}) AS DOUBLE), 6) AS min,
  round(quantile_cont({q(c)}, 0.25), 6) AS q25, round(quantile_cont({q(c)}, 0.5), 6) AS q50,
  round(quantile_cont({q(c)}, 0.75), 6) AS q75, round(CAST(max({q(c)}) AS DOUBLE), 6) AS max FROM players"""
    for c in NUMERIC)))


def _corr_sql(cols) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{x}' AS x, {i} AS x_idx, '{y}' AS y, {j} AS y_idx, corr({q(x)}, {q(y)}) AS c FROM players"
        for i, x in enumerate(cols) for j, y in enumerate(cols)
    )
    return f"SELECT x, x_idx, y, y_idx, round(CASE WHEN isnan(c) THEN NULL ELSE c END, 9) AS corr FROM ({rows})"


_corr_cols = RATINGS + FEATURES
oracle("corr_matrix", with_views(_corr_sql(_corr_cols)))
oracle("corr_with_overall", with_views(_corr_sql(FEATURES + ["Overall"])))
_profile = [c for c in PROFILE_COLUMNS if c in NUMERIC]
oracle("corr_profile", with_views(_corr_sql(_profile)))
oracle("corr_top_for_rating", with_views(
    "SELECT feature, idx, round(c, 9) AS corr FROM (" + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {i} AS idx, corr({q(f)}, \"LB\") AS c FROM players" for i, f in enumerate(FEATURES))
    + ") WHERE NOT isnan(c) ORDER BY round(c, 10) DESC NULLS LAST, idx LIMIT 5"))
oracle("feature_votes", with_views(
    "SELECT grp, CAST(rank AS INTEGER) AS rank, feature, votes, CAST(first_rating_idx AS INTEGER) AS first_rating_idx, "
    "CAST(first_rank AS INTEGER) AS first_rank FROM gfeat", votes=True))
oracle("age_histogram", with_views(""", stats AS (
  SELECT CASE WHEN min("Age") = max("Age") THEN min("Age") - 0.5 ELSE CAST(min("Age") AS DOUBLE) END AS lo,
         CASE WHEN min("Age") = max("Age") THEN max("Age") + 0.5 ELSE CAST(max("Age") AS DOUBLE) END AS hi,
         count("Age") AS n FROM players
), raw AS (
  SELECT CAST("Age" AS DOUBLE) AS x, lo, hi, (hi - lo) / 60 AS step,
    least(CAST(floor(("Age" - lo) * (60 / (hi - lo))) AS INTEGER), 59) AS r
  FROM players, stats WHERE "Age" IS NOT NULL
), dec AS (
  SELECT x, lo, hi, step,
    CASE WHEN x < (CASE WHEN r >= 60 THEN hi ELSE r * step + lo END) THEN r - 1 ELSE r END AS r
  FROM raw
), fixed AS (
  SELECT CASE WHEN x >= (CASE WHEN r + 1 >= 60 THEN hi ELSE (r + 1) * step + lo END) AND r <> 59 THEN r + 1 ELSE r END AS bin
  FROM dec
), binned AS (SELECT bin, count(*) AS cnt FROM fixed GROUP BY bin),
edges AS (
  SELECT b.bin, CASE WHEN b.bin >= 60 THEN hi ELSE b.bin * ((hi - lo) / 60) + lo END AS e0,
    CASE WHEN b.bin + 1 >= 60 THEN hi ELSE (b.bin + 1) * ((hi - lo) / 60) + lo END AS e1, n
  FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(60)) b CROSS JOIN stats
)
SELECT e.bin, round(e0, 6) AS bin_lo, round(e1, 6) AS bin_hi,
  CAST(coalesce(cnt, 0) AS BIGINT) AS count, round(coalesce(cnt, 0) / (n * (e1 - e0)), 6) AS density
FROM edges e LEFT JOIN binned USING (bin)"""))

oracle("club_age_quartiles", with_views(
    """SELECT "Club", count("Age") AS n, CAST(min("Age") AS DOUBLE) AS min,
  round(quantile_cont("Age", 0.25), 6) AS q25, round(quantile_cont("Age", 0.5), 6) AS q50,
  round(quantile_cont("Age", 0.75), 6) AS q75, CAST(max("Age") AS DOUBLE) AS max
FROM players WHERE "Club" IS NOT NULL GROUP BY "Club\""""))

oracle("club_age_density", with_views(f""", sel AS (
  SELECT "Club", CAST("Age" AS DOUBLE) AS v FROM players
  WHERE "Club" IS NOT NULL AND "Age" IS NOT NULL
), st AS (
  SELECT "Club", count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h, min(v) AS lo, max(v) AS hi
  FROM sel GROUP BY "Club"
), grid AS (
  SELECT st.*, g.range AS g, lo - 2.0 * h + g.range * ((hi - lo + 2 * 2.0 * h) / 99) AS x
  FROM st CROSS JOIN range(100) g
)
SELECT grid."Club", CAST(g AS INTEGER) AS grid_idx, round(x, 6) AS x,
  round(sum(exp(-0.5 * ((x - v) / h) * ((x - v) / h))) / (n * h * sqrt(2 * pi())), 6) AS density
FROM grid JOIN sel ON sel."Club" = grid."Club"
GROUP BY grid."Club", g, x, n, h"""))

oracle("linear_fits", with_views(" UNION ALL ".join(
    f"""SELECT '{y}' AS feature, round(regr_slope({q(y)}, {q(FIT_X)}), 6) AS slope,
  round(regr_intercept({q(y)}, {q(FIT_X)}), 6) AS intercept, round(regr_r2({q(y)}, {q(FIT_X)}), 6) AS r2,
  CAST(regr_count({q(y)}, {q(FIT_X)}) AS BIGINT) AS n FROM players""" for y in FIT_YS)))

_DRAWS = f""", md AS (
  SELECT p."ID", b.b, md5('{SEED}:' || p."ID" || ':' || b.b) AS h
  FROM players p, range({(REPLICATES - 1) // PIECES + 1}) AS b(b)
), draws AS (
  SELECT "ID", b * {PIECES} + i.i AS replicate, CAST('0x' || substr(h, CAST(4 * i.i + 1 AS INTEGER), 4) AS INTEGER) AS d
  FROM md, range({PIECES}) AS i(i)
), weights AS MATERIALIZED (
  SELECT "ID", replicate, {" + ".join(f"CASE WHEN d >= {s} THEN 1 ELSE 0 END" for s in poisson_steps())} AS w
  FROM draws WHERE replicate < {REPLICATES}
)"""
oracle("club_overall_bootstrap", with_views(_DRAWS + """, boot AS (
  SELECT "Club", quantile_cont(m, 0.025) AS lo, quantile_cont(m, 0.975) AS hi FROM (
    SELECT "Club", replicate, sum(w * "Overall") / CAST(sum(w) AS DOUBLE) AS m FROM players JOIN weights USING ("ID")
    WHERE "Club" IS NOT NULL AND "Overall" IS NOT NULL GROUP BY "Club", replicate HAVING sum(w) > 0
  ) GROUP BY "Club"
)
SELECT s."Club", round(m, 6) AS mean, round(s, 6) AS std, n,
  round(m - 1.96 * s / sqrt(n), 6) AS ci_low, round(m + 1.96 * s / sqrt(n), 6) AS ci_high,
  round(lo, 6) AS boot_low, round(hi, 6) AS boot_high
FROM (SELECT "Club", avg("Overall") AS m, stddev_samp("Overall") AS s, count("Overall") AS n
      FROM players WHERE "Club" IS NOT NULL GROUP BY "Club") s LEFT JOIN boot USING ("Club")"""))
oracle("linear_fit_bands", with_views(_DRAWS + ", xy AS (" + " UNION ALL ".join(
    f"""SELECT '{y}' AS feature, "ID", CAST({q(FIT_X)} AS DOUBLE) AS x, CAST({q(y)} AS DOUBLE) AS y FROM players
  WHERE {q(FIT_X)} IS NOT NULL AND {q(y)} IS NOT NULL""" for y in FIT_YS) + f"""
), ends AS (
  SELECT feature, min(x) AS lo, max(x) AS hi, avg(x) AS mx, avg(y) AS my, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept
  FROM xy GROUP BY feature
), sums AS (
  SELECT feature, replicate, sum(w) AS n, sum(w * (x - mx)) AS sx, sum(w * (y - my)) AS sy,
    sum(w * (x - mx) * (x - mx)) AS sxx, sum(w * (x - mx) * (y - my)) AS sxy, any_value(mx) AS mx, any_value(my) AS my
  FROM xy JOIN ends USING (feature) JOIN weights USING ("ID") WHERE w > 0 GROUP BY feature, replicate
), lines AS (
  SELECT feature, mx, my, n, sx, sy, (n * sxy - sx * sy) / nullif(n * sxx - sx * sx, 0) AS b FROM sums
), grid AS (
  SELECT feature, g.i AS point, lo + (hi - lo) * g.i / {BAND_POINTS - 1} AS x, slope, intercept FROM ends, range({BAND_POINTS}) AS g(i)
)
SELECT g.feature, CAST(g.point AS INTEGER) AS point, round(g.x, 6) AS x, round(max(g.intercept + g.slope * g.x), 6) AS fit,
  round(quantile_cont(my + (sy - b * sx) / n + b * (g.x - mx), 0.025), 6) AS low,
  round(quantile_cont(my + (sy - b * sx) / n + b * (g.x - mx), 0.975), 6) AS high
FROM grid g JOIN lines USING (feature) GROUP BY g.feature, g.point, g.x"""))

oracle("hexbin_counts", with_views(""", xy AS (
  SELECT CAST("Dribbling" AS DOUBLE) AS x, CAST("Crossing" AS DOUBLE) AS y FROM players
  WHERE "Dribbling" IS NOT NULL AND "Crossing" IS NOT NULL
), fdx AS (
  SELECT count(x) AS n, min(x) AS lo, max(x) AS hi,
    2 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / pow(count(x), 1.0 / 3) AS h FROM xy
), fdy AS (
  SELECT count(y) AS n, min(y) AS lo, max(y) AS hi,
    2 * (quantile_cont(y, 0.75) - quantile_cont(y, 0.25)) / pow(count(y), 1.0 / 3) AS h FROM xy
), bins AS (
  SELECT least(CASE WHEN n < 2 THEN 1 WHEN h = 0 THEN CAST(floor(sqrt(n)) AS INTEGER)
                    ELSE CAST(ceil((hi - lo) / h) AS INTEGER) END, 50) AS b FROM fdx
  UNION ALL
  SELECT least(CASE WHEN n < 2 THEN 1 WHEN h = 0 THEN CAST(floor(sqrt(n)) AS INTEGER)
                    ELSE CAST(ceil((hi - lo) / h) AS INTEGER) END, 50) AS b FROM fdy
), grid AS (
  SELECT CAST(floor(sum(b) / 2) AS INTEGER) AS nx,
         CAST(floor(CAST(floor(sum(b) / 2) AS INTEGER) / sqrt(3)) AS INTEGER) AS ny FROM bins
), st0 AS (
  SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.1 ELSE min(x) END AS xlo,
         CASE WHEN min(x) = max(x) THEN max(x) + 0.1 ELSE max(x) END AS xhi,
         CASE WHEN min(y) = max(y) THEN min(y) - 0.1 ELSE min(y) END AS ylo,
         CASE WHEN min(y) = max(y) THEN max(y) + 0.1 ELSE max(y) END AS yhi
  FROM xy
), st AS (
  SELECT xlo - 1e-9 * (xhi - xlo) AS xlo, xhi + 1e-9 * (xhi - xlo) AS xhi,
         ylo - 1e-9 * (yhi - ylo) AS ylo, yhi + 1e-9 * (yhi - ylo) AS yhi FROM st0
), pts AS (
  SELECT (x - xlo) / ((xhi - xlo) / nx) AS px, (y - ylo) / ((yhi - ylo) / ny) AS py
  FROM xy, st, grid
), d AS (
  SELECT px, py, round_even(px, 0) AS ix1, round_even(py, 0) AS iy1, floor(px) AS ix2, floor(py) AS iy2,
    (px - round_even(px, 0)) ** 2 + 3.0 * (py - round_even(py, 0)) ** 2 AS d1,
    (px - floor(px) - 0.5) ** 2 + 3.0 * (py - floor(py) - 0.5) ** 2 AS d2
  FROM pts
)
SELECT CASE WHEN d1 < d2 THEN 1 ELSE 2 END AS lattice,
  CAST(CASE WHEN d1 < d2 THEN ix1 ELSE ix2 END AS BIGINT) AS i,
  CAST(CASE WHEN d1 < d2 THEN iy1 ELSE iy2 END AS BIGINT) AS j, count(*) AS count
FROM d GROUP BY 1, 2, 3"""))

oracle("scatter_grid", with_views(
    """SELECT "Crossing", "Dribbling", count(*) AS count, round(avg("Finishing"), 6) AS hue_mean
FROM players WHERE "Crossing" IS NOT NULL AND "Dribbling" IS NOT NULL GROUP BY "Crossing", "Dribbling\""""))

# --- sorts / top-K ------------------------------------------------------------------

for _name, _dir in (("oldest_players", "DESC"), ("youngest_players", "ASC")):
    oracle(_name, with_views(
        f"""SELECT "ID", "Name", "Age", "Club", "Overall", CAST(row_number() OVER (ORDER BY "Age" {_dir}, "ID") AS INTEGER) AS rank
FROM players ORDER BY "Age" {_dir}, "ID" LIMIT 10"""))


def _row_top(cols, n: int) -> str:
    means = ", ".join(f"avg({q(c)}) AS {q(c)}" for c in cols)
    long = " UNION ALL ".join(f"SELECT \"Position\", {i} AS idx, '{c}' AS feature, {q(c)} AS value FROM m"
                              for i, c in enumerate(cols))
    return with_views(f""", m AS (SELECT "Position", {means} FROM players WHERE "Position" IS NOT NULL GROUP BY "Position"),
l AS ({long})
SELECT "Position", CAST(rank AS INTEGER) AS rank, feature, round(value, 6) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY "Position" ORDER BY value DESC, idx) AS rank FROM l WHERE value IS NOT NULL
) WHERE rank <= {n}""")


oracle("position_top_features", _row_top(FEATURES, 3))
oracle("position_radar_features", _row_top(RADAR_FEATURES, 5))

_dot_t = " + ".join(f"c.{q(f)} * t.{q(f)}" for f in FEATURES)
_norm_c = "sqrt(" + " + ".join(f"c.{q(f)} * c.{q(f)}" for f in FEATURES) + ")"
_norm_t = "sqrt(" + " + ".join(f"t.{q(f)} * t.{q(f)}" for f in FEATURES) + ")"
oracle("similar_players", with_views(f""", t AS (SELECT * FROM players WHERE "ID" = {PLAYER_ID}),
s AS (
  SELECT c."ID", c."Name", c."Age", c."Nationality", c."Club", c."Height_cm", c."Weight_lbs",
    ({_dot_t}) / nullif({_norm_t}, 0) AS score, {_norm_c} AS cn
  FROM players c, t WHERE c."ID" <> t."ID"
)
SELECT "ID", "Name", "Age", "Nationality", "Club", "Height_cm", "Weight_lbs", round(score, 6) AS score,
  CAST(row_number() OVER (ORDER BY round(score, 6) DESC, "ID") AS INTEGER) AS rank
FROM s WHERE cn > 0 AND score IS NOT NULL
ORDER BY round(score, 6) DESC, "ID" LIMIT {K}"""))

oracle("similar_embeddings", f"""WITH e AS (
  SELECT vec_id, label, CAST(x AS DOUBLE) AS x, i FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, i)
), t AS (SELECT i, x AS tx FROM e WHERE vec_id = {VEC_ID}),
tn AS (SELECT sqrt(sum(tx * tx)) AS n FROM t),
s AS (
  SELECT e.vec_id, e.label, sum(e.x * t.tx) AS dot, sqrt(sum(e.x * e.x)) AS cn
  FROM e JOIN t USING (i) WHERE e.vec_id <> {VEC_ID} GROUP BY e.vec_id, e.label
)
SELECT vec_id, label, round(dot / nullif(tn.n, 0), 6) AS score,
  CAST(row_number() OVER (ORDER BY round(dot / nullif(tn.n, 0), 6) DESC, vec_id) AS INTEGER) AS rank
FROM s, tn WHERE cn > 0 AND tn.n > 0
ORDER BY round(dot / nullif(tn.n, 0), 6) DESC, vec_id LIMIT {K}""")

# --- weak features, weights, replace mode ---------------------------------------------

_team_long = " UNION ALL ".join(f"SELECT \"Club\", {i} AS idx, '{f}' AS feature, {q(f)} AS value FROM teams"
                               for i, f in enumerate(FEATURES))
_WEAK = f""", tl AS MATERIALIZED ({_team_long}),
thr AS MATERIALIZED (
  SELECT "Club", value AS threshold FROM (
    SELECT "Club", value, row_number() OVER (PARTITION BY "Club" ORDER BY value) AS rn FROM tl
  ) WHERE rn = {len(FEATURES) // 4 + 1}
),
flags AS (
  SELECT tl."Club", tl.idx, tl.feature, tl.value, thr.threshold, tl.value < thr.threshold AS weak,
    sum(CASE WHEN tl.value < thr.threshold THEN 1 ELSE 0 END) OVER (PARTITION BY tl."Club") AS n_weak
  FROM tl JOIN thr USING ("Club")
),
wv AS (
  SELECT *, CASE WHEN weak THEN 2 * 10.0 / ({len(FEATURES)} + n_weak) ELSE 10.0 / ({len(FEATURES)} + n_weak) END AS weight
  FROM flags
)"""

oracle("weak_features", with_views(_WEAK + """
SELECT "Club", CAST(idx AS INTEGER) AS idx, feature, round(value, 6) AS value, round(threshold, 6) AS threshold
FROM flags WHERE weak"""))
oracle("weight_vector", with_views(_WEAK + """
SELECT "Club", CAST(idx AS INTEGER) AS idx, feature, weak, round(weight, 6) AS weight FROM wv"""))

_plong_idx = " UNION ALL ".join(f"SELECT \"ID\", \"Name\", \"Club\", {i} AS idx, {q(f)} AS value FROM players"
                               for i, f in enumerate(FEATURES))
_WEAK_PLAYERS = _WEAK + f""",
pl AS ({_plong_idx}),
wsum AS (
  SELECT p."ID", p."Name", p."Club", sum(CASE WHEN w.weak THEN p.value ELSE 0 END) AS weak_sum
  FROM pl p JOIN wv w ON w."Club" = p."Club" AND w.idx = p.idx
  WHERE p."Club" = '{CLUB}' GROUP BY p."ID", p."Name", p."Club"
)"""
for _name, _dir in (("weak_players", "DESC"), ("weak_players_asc", "ASC")):
    oracle(_name, with_views(_WEAK_PLAYERS + f"""
SELECT "ID", "Name", "Club", round(weak_sum, 6) AS weak_sum,
  CAST(row_number() OVER (ORDER BY round(weak_sum, 6) {_dir}, "ID") AS INTEGER) AS rank
FROM wsum ORDER BY round(weak_sum, 6) {_dir}, "ID" LIMIT 10"""))

_IMPROVE = _WEAK + f""",
pl AS ({_plong_idx}),
w AS (SELECT idx, weight FROM wv WHERE "Club" = '{CLUB}'),
cur AS (SELECT idx, value FROM pl WHERE "ID" = {{pid}}),
imp AS (
  SELECT {{pid}} AS player_id, c."ID" AS replacement_id, sum((c.value - cur.value) * w.weight) AS improvement
  FROM pl c JOIN cur USING (idx) JOIN w USING (idx)
  WHERE c."Club" <> '{CLUB}' AND EXISTS (SELECT 1 FROM w)
  GROUP BY c."ID"
)"""
oracle("best_replacements", with_views(_IMPROVE.format(pid=PLAYER_ID) + f"""
SELECT CAST(player_id AS BIGINT) AS player_id, replacement_id, round(improvement, 6) AS improvement,
  CAST(row_number() OVER (ORDER BY round(improvement, 6) DESC, replacement_id) AS INTEGER) AS rank
FROM imp ORDER BY round(improvement, 6) DESC, replacement_id LIMIT {K}"""))

oracle("replace_mode", with_views(_WEAK_PLAYERS + f""",
w AS (SELECT idx, weight FROM wv WHERE "Club" = '{CLUB}'),
worst AS (
  SELECT "ID", row_number() OVER (ORDER BY round(weak_sum, 6) DESC, "ID") AS wrank FROM wsum
  ORDER BY wrank LIMIT 10
),
pairs AS (
  SELECT wp."ID" AS player_id, wp.wrank, c."ID" AS replacement_id, sum((c.value - cur.value) * w.weight) AS improvement
  FROM worst wp
  JOIN pl cur ON cur."ID" = wp."ID"
  JOIN pl c ON c.idx = cur.idx AND c."Club" <> '{CLUB}'
  JOIN w ON w.idx = cur.idx
  GROUP BY wp."ID", wp.wrank, c."ID"
)
SELECT player_id, replacement_id, round(improvement, 6) AS improvement,
  CAST(row_number() OVER (ORDER BY round(improvement, 6) DESC, wrank, replacement_id) AS INTEGER) AS rank
FROM pairs ORDER BY round(improvement, 6) DESC, wrank, replacement_id LIMIT {REPLACE_K}"""))

_weak_total = " + ".join(f"CASE WHEN w.weak[{i + 1}] THEN p.{q(f)} ELSE 0 END" for i, f in enumerate(FEATURES))
_fused = " + ".join(f"(c.{q(f)} - cur.{q(f)}) * w.weight[{i + 1}]" for i, f in enumerate(FEATURES))
oracle("replace_all_clubs", with_views(_WEAK + f""",
w AS MATERIALIZED (
  SELECT "Club", list(weak ORDER BY idx) AS weak, list(weight ORDER BY idx) AS weight FROM wv GROUP BY "Club"
),
worst AS MATERIALIZED (
  SELECT "Club", "ID", row_number() OVER (PARTITION BY "Club" ORDER BY round(weak_sum, 6) DESC, "ID") AS wrank
  FROM (SELECT p."Club", p."ID", {_weak_total} AS weak_sum FROM players p JOIN w ON w."Club" = p."Club")
  QUALIFY wrank <= 10
),
pairs AS (
  SELECT wp."Club", wp."ID" AS player_id, wp.wrank, c."ID" AS replacement_id, {_fused} AS improvement
  FROM worst wp
  JOIN players cur ON cur."ID" = wp."ID"
  JOIN w ON w."Club" = wp."Club"
  JOIN players c ON c."Club" <> wp."Club"
)
SELECT "Club", player_id, replacement_id, round(improvement, 6) AS improvement,
  CAST(row_number() OVER (PARTITION BY "Club" ORDER BY round(improvement, 6) DESC, wrank, replacement_id) AS INTEGER) AS rank
FROM pairs QUALIFY rank <= {REPLACE_K}"""))

# --- matrix recommendations -----------------------------------------------------------

_club = f"WHERE t.\"Club\" = '{CLUB}'"


def _mvp(grp: str, direction: str, k) -> str:
    return with_scores(f"""SELECT "ID", "Name", "Club", team, grp, round(score, 6) AS score,
  CAST(row_number() OVER (ORDER BY round(score, 6) {direction} NULLS LAST, "ID") AS INTEGER) AS rank
FROM scores WHERE grp = '{grp}'
ORDER BY round(score, 6) {direction} NULLS LAST, "ID" LIMIT {k}""", where=_club)


oracle("mvp_for_team", _mvp("DEF", "DESC", K))
oracle("lvp_for_team", _mvp("DEF", "ASC", K))
_player = f"WHERE p.\"ID\" = {PLAYER_ID}"
oracle("mvt_for_player", with_scores(f"""SELECT "ID", "Name", "Club", team, grp, round(score, 6) AS score,
  CAST(row_number() OVER (ORDER BY round(score, 6) DESC NULLS LAST, team) AS INTEGER) AS rank
FROM scores WHERE grp = 'FWD'
ORDER BY round(score, 6) DESC NULLS LAST, team LIMIT {K}""", where=_player))
oracle("lvt_for_player", with_scores(f"""SELECT "ID", "Name", "Club", team, grp, round(score, 6) AS score,
  CAST(row_number() OVER (ORDER BY round(score, 6) ASC NULLS LAST, team) AS INTEGER) AS rank
FROM scores WHERE grp = 'FWD'
ORDER BY round(score, 6) ASC NULLS LAST, team LIMIT {K}""", where=_player))
oracle("mvt_for_player_all", with_scores("""SELECT "ID", "Name", "Club", team, grp, round(score, 6) AS score
FROM scores WHERE grp = 'MID'""", where=_player))
oracle("worst_in_club", with_scores(f"""SELECT s."ID", s."Name", s."Club", team, grp, round(score, 6) AS score
FROM scores s JOIN players p USING ("ID")
WHERE grp = 'DEF' AND s."Club" = '{CLUB}' AND {GROUP_CASE.format(c='p."Position"')} = 'DEF'""", where=_club))
_ids = ", ".join(str(i) for i in LIST_IDS)
oracle("lvp_from_list", with_scores(f"""SELECT "ID", "Name", "Club", team, grp, round(score, 6) AS score,
  CAST(row_number() OVER (ORDER BY round(score, 6) ASC NULLS LAST, "ID") AS INTEGER) AS rank
FROM scores WHERE grp = 'ALL' AND "ID" IN ({_ids})
ORDER BY round(score, 6) ASC NULLS LAST, "ID" LIMIT 1""", where=_club))
oracle("lvp_all", with_scores("""SELECT "ID", "Name", "Club", team, grp, round(score, 6) AS score,
  CAST(row_number() OVER (ORDER BY round(score, 6) ASC NULLS LAST, "ID") AS INTEGER) AS rank
FROM scores WHERE grp = 'ALL'
ORDER BY round(score, 6) ASC NULLS LAST, "ID" LIMIT 1""", where=_club))
oracle("mvp_all_clubs", with_scores(f"""SELECT "ID", "Name", "Club", team, grp, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY team, grp ORDER BY round(score, 6) DESC NULLS LAST, "ID") AS rank FROM scores)
WHERE rank <= {K}"""))
oracle("mvt_all_players", with_scores(f"""SELECT "ID", "Name", "Club", team, grp, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY "ID", grp ORDER BY round(score, 6) DESC NULLS LAST, team) AS rank FROM scores)
WHERE rank <= {K}"""))


def _positive_zero(sql: str) -> str:
    """Wrap every round(...) as (round(...) + 0.0): DuckDB rounds a tiny negative to -0.0,
    Spark to 0.0; adding +0.0 turns -0.0 into 0.0 and leaves every other value alone."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i : j + 6])
            i = j + 6
            continue
        k, depth = j + 6, 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "(round(" + _positive_zero(sql[j + 6 : k - 1]) + ") + 0.0)")
        i = k


ORACLE_SQL = {name: _positive_zero(sql) for name, sql in ORACLE_SQL.items()}

# --- cases with other column orders, NULLs and bad fields --------------------------------

oracle("scan_untidy", with_views("""SELECT "ID", "Name" || ', Jr.' AS "Name", CASE WHEN "ID" % 10 <> 3 THEN "Club" END AS "Club", "Overall"
FROM players WHERE "ID" % 10 <> 5"""))
oracle("scan_untidy_malformed", with_views('SELECT count(*) AS "rows", count(*) FILTER ("ID" % 10 = 5) AS malformed FROM players'))
oracle("scan_untidy_ledger", with_views("""SELECT 'Overall' AS "column", 'cast' AS reason,
'bad,"' || "Name" || ', Jr.",' || "ID" || ',' || "Club" AS record FROM players WHERE "ID" % 10 = 5"""))
oracle("scan_untidy_rejects", with_views("""SELECT 'Overall' AS "column", 'cast' AS reason, count(*) AS fields
FROM players WHERE "ID" % 10 = 5 HAVING count(*) > 0"""))
oracle("scan_inferred", with_views('SELECT "ID", "Name", "Club", "Overall", round("Crossing", 6) AS "Crossing" FROM players'))
oracle("recommend_players", ORACLE_SQL["mvp_for_team"])
oracle("recommend_clubs", ORACLE_SQL["mvt_for_player"])
oracle("select_ids", with_views(f'SELECT "ID", "Name", "Club", "Overall" FROM players WHERE "ID" IN ({", ".join(map(str, LIST_IDS))})'))
oracle("select_ids_joined", with_views('SELECT "ID", "Name", "Club", "Overall" FROM players WHERE "Age" % 2 = 0'))

_HOLES = {"Age": 7, "Club": 9, "Crossing": 5, "Finishing": 4}
_holes = """, holes AS (SELECT * REPLACE (""" + ", ".join(f'CASE WHEN "ID" % {m} <> 0 THEN {q(c)} END AS {q(c)}' for c, m in _HOLES.items()) + """) FROM players)
"""
oracle("null_flags_holes", with_views(_holes + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", coalesce(bool_or({q(c)} IS NULL), false) AS has_null FROM holes" for c in PLAYER_COLS)))
oracle("corr_holes", with_views(_holes + _corr_sql(HOLE_COLUMNS).replace("FROM players", "FROM holes")))
