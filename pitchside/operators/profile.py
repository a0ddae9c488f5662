"""Table profiling: shape, counts, summary statistics, distributions.

Every function is one or two aggregates with map-side partial aggregation, so
a hot club or position (even a third of all rows) is combined per partition
before the shuffle. Per-column results are returned long, one row per column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import HIST_BINS
from .quantiles import column_quantiles, quantile_rows, unpivoted
from .targets import row_values
from .topk import top_k


def preview(df: DataFrame, n: int = 5, order_by: str = "ID") -> DataFrame:
    """First n rows in id order (the head of the table, made deterministic)."""
    return df.orderBy(order_by).limit(n)


def table_info(df: DataFrame) -> DataFrame:
    """(position, column, dtype, non_null, rows): one aggregate for every column."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(cols)])
    entries = []
    for i, (c, t) in enumerate(df.dtypes):
        entries += [F.lit(i), F.lit(c), F.lit(t), F.col(f"n{i}")]
    return agg.select(
        F.stack(F.lit(len(cols)), *entries).alias("position", "column", "dtype", "non_null"),
        F.col("__rows").alias("rows"),
    )


def clubs_age_sum(players: DataFrame, k: int = 5, ascending: bool = False, club: str = "Club",
                  age: str = "Age") -> DataFrame:
    """Clubs ranked by the SUM of player ages (the reference's 'oldest team'), with mean and size."""
    agg = players.where(F.col(club).isNotNull()).groupBy(club).agg(
        F.sum(age).cast("long").alias("age_sum"), F.avg(age).alias("age_mean"), F.count(F.lit(1)).alias("players"),
    )
    return top_k(agg, k, "age_sum", ascending=ascending, tiebreak=(club,), round_to=None)


def group_means(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Mean of each column per key (NULL key left out, as a group-by in pandas does)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(c).alias(c) for c in columns])


def club_overall_ci(players: DataFrame, clubs: Sequence[str] | None = None, value: str = "Overall",
                    z: float = 1.96) -> DataFrame:
    """Per club: mean, sample std, count and the normal interval mean +- z * s / sqrt(n)."""
    p = players.where(F.col("Club").isNotNull())
    if clubs is not None:
        p = p.where(F.col("Club").isin(list(clubs)))
    agg = p.groupBy("Club").agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(F.col(value)).alias("n"),
    )
    half = F.lit(z) * F.col("std") / F.sqrt(F.col("n"))
    return agg.select("Club", "mean", "std", "n", (F.col("mean") - half).alias("ci_low"),
                      (F.col("mean") + half).alias("ci_high"))


def vector_group_means(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Element-wise mean of an array column per group: (key, n, mean array).

    Each vector is exploded into (key, position, value) and averaged per
    (key, position) with partial aggregation, so a hot group is combined per
    partition; each group's result is gathered back into one array of the
    vector's length (bounded by the dimension, not by the group size).
    """
    exploded = df.where(F.col(key).isNotNull()).select(key, F.posexplode(vector).alias("pos", "v"))
    per_pos = exploded.groupBy(key, "pos").agg(F.avg(F.col("v").cast("double")).alias("m"), F.count("v").alias("n"))
    gathered = per_pos.groupBy(key).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("s")
    )
    return gathered.select(key, "n", F.transform("s", lambda e: e["m"]).alias("mean"))


def value_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


#: Columns of integers whose range fits in so many words of 64 bits are counted without a shuffle of values,
#: at most NARROW_WORDS words in all.
WORDS, NARROW_WORDS = 64, 2048


def nunique(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """(column, nunique): distinct non-NULL values per column.

    Exact. Integers set bits: value v is bit v mod 64 of word v div 64, and words are
    merged by ``bit_or``, so what is shuffled follows the range of the values, not
    the rows. Columns of a narrow range keep their few words as plain aggregate
    columns (one row a task leaves it); wider ones, such as ids, are grouped by
    (column, word). The ranges are read first: two numbers a column. Other types
    become narrow (column, value) pairs, de-duplicated per partition before one
    shuffle: doubles as doubles, the rest as text. ``approx=True`` uses fixed-size
    HyperLogLog sketches instead.
    """
    cols = list(columns or df.columns)
    if approx:
        agg = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(cols)])
        entries = []
        for i, c in enumerate(cols):
            entries += [F.lit(c), F.col(f"d{i}")]
        return agg.select(F.stack(F.lit(len(cols)), *entries).alias("column", "nunique"))
    spark, types = df.sparkSession, {f.name: f.dataType for f in df.schema.fields}
    whole = {i: c for i, c in enumerate(cols) if isinstance(types[c], (T.ByteType, T.ShortType, T.IntegerType, T.LongType))}
    real = {i: c for i, c in enumerate(cols) if isinstance(types[c], (T.FloatType, T.DoubleType))}
    text = {i: c for i, c in enumerate(cols) if i not in whole and i not in real}
    parts, narrow = [], {}
    if whole:
        ends = df.selectExpr(*[f"{f}(`{c}`) AS {f}{i}" for i, c in whole.items() for f in ("min", "max")]).first()
        ranges = {i: (ends[f"min{i}"] >> 6, (ends[f"max{i}"] >> 6) - (ends[f"min{i}"] >> 6) + 1) for i in whole if ends[f"min{i}"] is not None}
        left = NARROW_WORDS
        for i, (first, n) in sorted(ranges.items(), key=lambda x: x[1][1]):
            if n <= min(WORDS, left):
                narrow[i] = (first, n)
                left -= n
        wide = [i for i in ranges if i not in narrow]
        if narrow:
            parts.append(_narrow_counts(df, {i: (whole[i], *narrow[i]) for i in narrow}))
        if wide:
            parts.append(_word_counts(df, {i: whole[i] for i in wide}))
    for family, kind in ((real, "double"), (text, "string")):
        if family:
            pairs = df.select(F.expr("array(" + ", ".join(f"named_struct('i', {i}, 'v', cast(`{c}` AS {kind}))" for i, c in family.items()) + ")").alias("a"))
            pairs = pairs.select(F.inline("a")).where(F.col("v").isNotNull())
            parts.append(pairs.distinct().groupBy("i").agg(F.count(F.lit(1)).alias("nunique")))
    # Columns that are entirely NULL still get a row (0).
    every = spark.createDataFrame([(i, c) for i, c in enumerate(cols)], "i int, column string")
    if not parts:
        return every.select("column", F.lit(0).cast("long").alias("nunique"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return every.join(F.broadcast(out), "i", "left").select("column", F.coalesce(F.col("nunique"), F.lit(0)).cast("long").alias("nunique"))


def _narrow_counts(df: DataFrame, ranges: dict[int, tuple[str, int, int]]) -> DataFrame:
    """(i, nunique) of integer columns: i -> (column, first word, number of words), a word an aggregate."""
    words, counts = [], []
    for i, (c, first, n) in ranges.items():
        v = f"cast(`{c}` AS bigint)"
        bit = f"shiftleft(1L, cast({v} & 63 AS int))"
        words += [f"bit_or({bit}) AS w{i}_0"] if n == 1 else [f"bit_or(CASE WHEN {v} >> 6 = {first + k}L THEN {bit} END) AS w{i}_{k}" for k in range(n)]
        counts.append(f"{i}, cast(" + " + ".join(f"coalesce(bit_count(w{i}_{k}), 0)" for k in range(n)) + " AS bigint)")
    return df.agg(*map(F.expr, words)).selectExpr(f"stack({len(counts)}, {', '.join(counts)}) AS (i, nunique)")


def _word_counts(df: DataFrame, columns: dict[int, str]) -> DataFrame:
    """(i, nunique) of integer columns of any range, by the words that occur."""
    pairs = df.select(F.expr("array(" + ", ".join(f"named_struct('i', {i}, 'v', cast(`{c}` AS bigint))" for i, c in columns.items()) + ")").alias("a"))
    words = pairs.select(F.inline("a")).where(F.col("v").isNotNull()).selectExpr("i", "v >> 6 AS word", "shiftleft(1L, cast(v & 63 AS int)) AS bit")
    merged = words.groupBy("i", "word").agg(F.bit_or("bit").alias("bits"))
    return merged.groupBy("i").agg(F.sum(F.bit_count("bits")).cast("long").alias("nunique"))


def null_flags(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, has_null)."""
    cols = list(columns or df.columns)
    agg = df.agg(*[F.bool_or(F.col(f"`{c}`").isNull()).alias(f"h{i}") for i, c in enumerate(cols)])
    entries = []
    for i, c in enumerate(cols):
        entries += [F.lit(c), F.coalesce(F.col(f"h{i}"), F.lit(False))]
    return agg.select(F.stack(F.lit(len(cols)), *entries).alias("column", "has_null"))


def describe(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) for numeric columns
    (every numeric column when ``columns`` is None, as pandas does).

    Quartiles interpolate linearly between order statistics, like pandas, and
    are exact with bounded memory (radix selection, ``quantiles``);
    ``approx=True`` switches to one-pass ``percentile_approx``. The quartiles are
    found at call time, by at most three jobs; every step is an aggregate of the
    values by column, with partial sums. A column of NULLs alone has count 0 and NULLs.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    columns = list(columns)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double")
    probs = [0.25, 0.5, 0.75]
    long = unpivoted(df, columns)
    v = F.col("v")
    more = [F.percentile_approx(v, probs, 100000).alias("b")] if approx else []
    stats = long.groupBy("c").agg(F.count(v).alias("n"), F.avg(v).alias("a"), F.stddev_samp(v).alias("s"), F.min(v).alias("l"), F.max(v).alias("h"), *more)
    exact = {} if approx else column_quantiles(df, columns, probs)   # three numbers a column
    names = df.sparkSession.createDataFrame([(i, c, exact.get(c)) for i, c in enumerate(columns)], "c int, column string, q array<double>")
    out = names.join(F.broadcast(stats), "c", "left")
    return out.select("column", F.coalesce("n", F.lit(0)).cast("long").alias("count"), F.col("a").alias("mean"), F.col("s").alias("std"), F.col("l").alias("min"),
                      *[F.get("b" if approx else "q", F.lit(i)).alias(q) for i, q in enumerate(("q25", "q50", "q75"))], F.col("h").alias("max"))


def histogram(df: DataFrame, column: str, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width density histogram: (bin, bin_lo, bin_hi, count, density), empty bins included.

    Bins follow the usual uniform-bin rule: edges lo + i * (hi - lo) / bins
    (the last edge is hi itself), a value goes to bin
    floor((x - lo) * (bins / (hi - lo))), corrected by one when float rounding
    puts it on the wrong side of an edge; the maximum falls into the last bin.
    A constant column uses [v - 0.5, v + 0.5]. density = count / (n * width).
    """
    x = F.col(column).cast("double")
    stats = df.agg(F.min(x).alias("lo0"), F.max(x).alias("hi0"), F.count(x).alias("n"))
    stats = stats.select(
        F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
        F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"),
        "n",
    )
    s, present = _stats_values(stats)
    # Bind the two statistics once as columns: expressions below use them many times.
    vals = df.where(x.isNotNull() & present).select(
        x.alias("__x"), s["lo"].alias("__lo"), s["hi"].alias("__hi")
    )
    xv, lo, hi = F.col("__x"), F.col("__lo"), F.col("__hi")
    step = (hi - lo) / F.lit(bins)

    def edge(i):
        return F.when(i >= bins, hi).otherwise(i * step + lo)

    raw = F.floor((xv - lo) * (F.lit(bins) / (hi - lo))).cast("int")
    raw = F.when(raw >= bins, F.lit(bins - 1)).otherwise(raw)
    with_raw = vals.select("__x", "__lo", "__hi", raw.alias("__r"))
    r = F.col("__r")
    dec = with_raw.select("__x", "__lo", "__hi", F.when(xv < edge(r), r - 1).otherwise(r).alias("__r"))
    fixed = F.when((xv >= edge(r + 1)) & (r != bins - 1), r + 1).otherwise(r)
    counts = dec.groupBy(fixed.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = stats.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi", "n")
    out = all_bins.join(counts, "bin", "left")
    w = (F.col("hi") - F.col("lo")) / F.lit(bins)

    def col_edge(i):
        return F.when(i >= bins, F.col("hi")).otherwise(i * w + F.col("lo"))

    return out.select(
        "bin",
        col_edge(F.col("bin")).alias("bin_lo"),
        col_edge(F.col("bin") + 1).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
        (F.coalesce(F.col("count"), F.lit(0)) / (F.col("n") * (col_edge(F.col("bin") + 1) - col_edge(F.col("bin"))))).alias("density"),
    )


def _stats_values(one_row: DataFrame):
    """A one-row statistics frame as lazy scalar-subquery values (no extra job)."""
    return row_values(one_row, one_row.columns)


def group_quartiles(df: DataFrame, key: str, value: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Per group: n, min, q25, median, q75, max (violin-plot box); exact, bounded memory."""
    p = df.where(F.col(key).isNotNull())
    if keys is not None:
        p = p.where(F.col(key).isin(list(keys)))
    agg = p.groupBy(key).agg(
        F.count(F.col(value)).alias("n"), F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max"),
    )
    quart = quantile_rows(p.select(key, value), [key], value, [0.25, 0.5, 0.75]).select(key, "q")
    return agg.join(quart, [key], "left").select(
        key, "n", "min", *[F.get("q", F.lit(i)).alias(q) for i, q in enumerate(("q25", "q50", "q75"))], "max")


#: Groups with more distinct values than EXACT_VALUES (by estimate) are laid on NODES nodes before the kernel sum.
EXACT_VALUES, NODES = 4096, 16384
#: Kernel distances (in bandwidths) that count on nodes; beyond, the kernel is below 1e-17.
REACH = 9.0


def group_density(df: DataFrame, key: str, value: str, keys: Sequence[str] | None = None,
                  grid: int = 100, cut: float = 2.0, exact_values: int = EXACT_VALUES, nodes: int = NODES) -> DataFrame:
    """Gaussian kernel density per group on ``grid`` points (violin-plot curve).

    Bandwidth is Scott's rule, h = s * n^(-1/5); the grid spans
    [min - cut*h, max + cut*h]. A group with few distinct values is exact: its
    values are counted, and the kernel sum runs over the counts. In a group with
    more, each value is spread over its two neighbours among ``nodes`` evenly
    spaced nodes, by distance (linear binning), and the sum runs over the nodes
    within reach; with nodes s apart the density is off by at most
    0.05 (s / h)^2 / h, the error of a linear interpolation of the kernel. So a
    group costs grid x nodes at most, however many values it has, and values are
    combined per partition before the shuffle. A group of one value, or of equal
    ones, has no bandwidth: its points carry no density.
    """
    p = df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    if keys is not None:
        p = p.where(F.col(key).isin(list(keys)))
    p, own = p.select(F.col(key).alias("z_key"), F.col(value).cast("double").alias("v")), "z_key"
    v = F.col("v")
    stats = p.groupBy(own).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp(v).alias("s"), F.min(v).alias("lo"), F.max(v).alias("hi"),
    ).withColumn("h", F.coalesce(F.col("s"), F.lit(0.0)) * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    distinct = p.groupBy(own).agg(F.approx_count_distinct(v).alias("d"), F.min(v).alias("lo"), F.max(v).alias("hi"))
    many = distinct.where(F.col("d") > exact_values)
    if many.limit(1).count():   # one aggregate at call time; most tables have no such group
        counts = _node_weights(p, many, nodes)
    else:
        counts = p.groupBy(own, "v").agg(F.count(F.lit(1)).cast("double").alias("c"), F.lit(True).alias("exact"))
    step = F.when(F.lit(grid) > 1, (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / F.lit(grid - 1)).otherwise(F.lit(0.0))
    pts = stats.select(own, "n", "h", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("g"))
    pts = pts.select(own, "n", "h", "g", (F.col("lo") - cut * F.col("h") + F.col("g") * step).alias("x"))
    joined = pts.join(counts, own)
    h = F.nullif(F.col("h"), F.lit(0.0))
    z = (F.col("x") - F.col("v")) / h
    kern = F.when(F.col("exact") | (F.abs(z) <= REACH), F.col("c") * F.exp(-0.5 * z * z)).otherwise(0.0)
    out = joined.groupBy(own, "g", "x", "n", "h").agg(F.sum(kern).alias("k"))
    return out.select(
        F.col(own).alias(key), F.col("g").alias("grid_idx"), "x",
        (F.col("k") / (F.col("n") * h * F.lit(math.sqrt(2 * math.pi)))).alias("density"),
    )


def _node_weights(p: DataFrame, many: DataFrame, nodes: int) -> DataFrame:
    """(z_key, exact, v, c): values and their counts, or nodes and their weights for the groups of ``many``."""
    v = F.col("v")
    laid = p.join(many.select(F.col("z_key").alias("k_"), "lo", ((F.col("hi") - F.col("lo")) / F.lit(nodes - 1)).alias("step")), F.col("z_key") == F.col("k_"), "left")
    laid = laid.withColumn("i", F.when(F.col("step") > 0, F.least(F.floor((v - F.col("lo")) / F.col("step")), F.lit(nodes - 2))))
    at = lambda k: F.col("lo") + (F.col("i") + k) * F.col("step")
    node = lambda x, w: F.struct(x.alias("x"), w.alias("w"))
    share = (v - at(0)) / F.col("step")
    spread = F.when(F.col("i").isNull(), F.array(node(v, F.lit(1.0)))).otherwise(F.array(node(at(0), 1.0 - share), node(at(1), share)))
    return laid.select("z_key", F.col("i").isNull().alias("exact"), F.inline(spread)).groupBy("z_key", "exact", F.col("x").alias("v")).agg(F.sum("w").alias("c"))


def linear_fits(df: DataFrame, x: str, ys: Sequence[str]) -> DataFrame:
    """(feature, slope, intercept, r2, corr, n) of y ~ x for each y, one aggregate."""
    cols = []
    for i, y in enumerate(ys):
        cols += [
            F.regr_slope(F.col(y), F.col(x)).alias(f"s{i}"), F.regr_intercept(F.col(y), F.col(x)).alias(f"i{i}"),
            F.regr_r2(F.col(y), F.col(x)).alias(f"r{i}"), F.regr_count(F.col(y), F.col(x)).alias(f"n{i}"),
        ]
    agg = df.agg(*cols)
    entries = []
    for i, y in enumerate(ys):
        entries += [F.lit(y), F.col(f"s{i}"), F.col(f"i{i}"), F.col(f"r{i}"), F.col(f"n{i}")]
    return agg.select(F.stack(F.lit(len(ys)), *entries).alias("feature", "slope", "intercept", "r2", "n"))


def fd_bins(df: DataFrame, columns: Sequence[str], cap: int = 50) -> list[int]:
    """Freedman-Diaconis bin count per column, capped: ceil(range / (2 IQR n^(-1/3))),
    sqrt(n) when the IQR is 0, 1 below two values. One pass over all the columns
    (exact quartiles with bounded memory); one row per column reaches the driver."""
    cols = list(columns)
    probs = [0.25, 0.75]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(F.col(c)).alias(f"n{i}"), F.min(F.col(c).cast("double")).alias(f"l{i}"), F.max(F.col(c).cast("double")).alias(f"h{i}")]
    row = df.agg(*aggs).first()
    quart = column_quantiles(df, cols, probs)
    out = []
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        if n < 2:
            out.append(1)
            continue
        h = 2.0 * (quart[c][1] - quart[c][0]) / n ** (1.0 / 3.0)
        bins = int(math.sqrt(n)) if h == 0 else int(math.ceil((row[f"h{i}"] - row[f"l{i}"]) / h))
        out.append(min(bins, cap))
    return out


def hexbin_gridsize(df: DataFrame, x: str, y: str, bin_cap: int = 50) -> int:
    """Grid size of the usual joint hex plot: mean of the capped Freedman-Diaconis bin counts of x and y
    (over the rows that have both), 1 at least."""
    bx, by = fd_bins(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()), [x, y], bin_cap)
    return max(1, int((bx + by) / 2))


def hexbin_counts(df: DataFrame, x: str, y: str, gridsize: int | str = 30, bin_cap: int = 50) -> DataFrame:
    """Counts on a hexagonal grid: two offset rectangular lattices, each point
    going to the nearer centre (ties to the first lattice), as in the usual
    hexbin construction. (lattice, i, j, count). ``gridsize="auto"`` picks the
    grid like the joint hex plot (``hexbin_gridsize``, with at most ``bin_cap``
    bins an axis). Rows without both values take no part, neither in the grid's extent."""
    if gridsize == "auto":
        gridsize = hexbin_gridsize(df, x, y, bin_cap)
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    df = df.where(xd.isNotNull() & yd.isNotNull())
    stats = df.agg(F.min(xd).alias("xmin"), F.max(xd).alias("xmax"), F.min(yd).alias("ymin"), F.max(yd).alias("ymax"))
    s0, present = _stats_values(stats)
    nx = gridsize
    ny = max(1, int(gridsize / math.sqrt(3)))
    # A flat axis is widened by 0.1 on each side so the grid has a size; then
    # both ranges are padded by 1e-9 of their width, so the maximum stays
    # inside the last cell.
    bound = df.where(present).select(
        xd.alias("__x"), yd.alias("__y"), *[s0[c].alias(c) for c in ("xmin", "xmax", "ymin", "ymax")]
    )
    s = {c: F.col(c) for c in ("xmin", "xmax", "ymin", "ymax")}
    xd, yd = F.col("__x"), F.col("__y")
    xlo0 = F.when(s["xmax"] == s["xmin"], s["xmin"] - 0.1).otherwise(s["xmin"])
    xhi0 = F.when(s["xmax"] == s["xmin"], s["xmax"] + 0.1).otherwise(s["xmax"])
    ylo0 = F.when(s["ymax"] == s["ymin"], s["ymin"] - 0.1).otherwise(s["ymin"])
    yhi0 = F.when(s["ymax"] == s["ymin"], s["ymax"] + 0.1).otherwise(s["ymax"])
    xpad, ypad = F.lit(1e-9) * (xhi0 - xlo0), F.lit(1e-9) * (yhi0 - ylo0)
    xlo, xhi, ylo, yhi = xlo0 - xpad, xhi0 + xpad, ylo0 - ypad, yhi0 + ypad
    px = (xd - xlo) / ((xhi - xlo) / F.lit(nx))
    py = (yd - ylo) / ((yhi - ylo) / F.lit(ny))
    pts = bound.select(px.alias("px"), py.alias("py"))
    ix1, iy1 = F.bround("px", 0), F.bround("py", 0)
    ix2, iy2 = F.floor("px"), F.floor("py")
    d1 = (F.col("px") - ix1) ** 2 + 3.0 * (F.col("py") - iy1) ** 2
    d2 = (F.col("px") - ix2 - 0.5) ** 2 + 3.0 * (F.col("py") - iy2 - 0.5) ** 2
    first = d1 < d2
    cells = pts.select(
        F.when(first, F.lit(1)).otherwise(F.lit(2)).alias("lattice"),
        F.when(first, ix1).otherwise(ix2).cast("long").alias("i"),
        F.when(first, iy1).otherwise(iy2).cast("long").alias("j"),
    )
    return cells.groupBy("lattice", "i", "j").agg(F.count(F.lit(1)).alias("count"))


def scatter_grid(df: DataFrame, x: str, y: str, hue: str) -> DataFrame:
    """Scatter data reduced to distinct (x, y) points: count and mean hue per point."""
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(
        F.count(F.lit(1)).alias("count"), F.avg(hue).alias("hue_mean")
    )


def extreme_rows(df: DataFrame, by: str, n: int = 10, ascending: bool = False,
                 columns: Sequence[str] = ("ID", "Name", "Age", "Club", "Overall")) -> DataFrame:
    """The n rows with the largest (smallest) ``by``, ties by id."""
    return top_k(df.select(*columns), n, by, ascending=ascending, round_to=None)
