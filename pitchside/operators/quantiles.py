"""Exact quantiles (linear interpolation, as pandas) by radix selection, in built-in functions only.

Spark's exact ``percentile`` keeps a value -> count map per group in one task, so its
memory follows the number of distinct values. Here every double gets an integer key
of the same order (sign, exponent, mantissa, as its 64 bits). A scan counts, per group,
the values by the leading bits of their keys; the digit that holds each target rank is
kept, and the next scan counts only the values behind those leading bits, by the next
bits. After ``len(SHIFTS)`` scans at most the keys of the ranks are known.

Every step is an aggregate with partial sums of a bounded number of counters: at most
2 ** 20 a group in the first scan (256 an octave of the values), then 2 ** 22 for each
leading part that holds a target (at most two a quantile). So neither a hot group nor a column without equal
values grows a task, and the number of scans is fixed.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from .targets import spread_small

#: Bits below the leading part, scan by scan.
SHIFTS = (44, 22, 0)
#: Targets (two a quantile and group at most) that a scan hands to the driver.
DRIVER_ROWS = 20_000
_EXP, _ONE = 1022, 1 << 52
_INF = 2047 * _ONE


def _q(*names: str) -> list[str]:
    return [f"`{c}`" for c in names]


# The steps are SQL text: built from column functions, each part of an expression would be a call to the JVM.

def order_key(names: DataFrame, value: str) -> DataFrame:
    """``names`` with the long ``z_key``, ordered as the column as doubles: infinite values at the ends, NaN last, -0 as 0; NULL rows left out.

    The key is the double's bits: x = m * 2 ** e with e >= -1022 and m below 2, exactly,
    as powers of two only shift.
    """
    cols = _q(*names.columns)
    a = names.selectExpr(*cols, f"cast(`{value}` AS double) AS z_x").where("z_x IS NOT NULL")
    a = a.selectExpr(*cols, "z_x", "CASE WHEN abs(z_x) < double('Infinity') THEN abs(z_x) END AS z_a")
    a = a.selectExpr(*cols, "z_x", "z_a", f"greatest(coalesce(floor(log2(z_a)), -{_EXP}), -{_EXP}) AS z_e0")
    a = a.selectExpr(*cols, "z_x", "z_a", "z_e0", "z_a / power(2D, z_e0) AS z_m")   # the logarithm may be one off beside a power of two
    a = a.selectExpr(*cols, "z_x", "z_a", f"CASE WHEN z_m >= 2 THEN z_e0 + 1 WHEN z_m < 1 AND z_e0 > -{_EXP} THEN z_e0 - 1 ELSE z_e0 END AS z_e")
    bits = f"CASE WHEN isnan(z_x) THEN {_INF + 1}L WHEN z_a IS NULL THEN {_INF}L ELSE (z_e + {_EXP}) * {_ONE}L + cast(z_a / power(2D, z_e) * {_ONE}D AS bigint) END"
    # never NULL, and said so: else joins on the key's bits would add filters that compute it again
    return a.selectExpr(*cols, f"coalesce(CASE WHEN z_x < 0 THEN -({bits}) ELSE {bits} END, 0L) AS z_key")


def key_value(key: str) -> str:
    """SQL for the double of an order key."""
    a = f"abs({key})"
    frac = f"cast({a} & {_ONE - 1}L AS double)"
    finite = f"CASE WHEN {a} < {_ONE}L THEN {frac} * 4.9E-324D ELSE ({frac} + {_ONE}D) * power(2D, ({a} >> 52) - 1075) END"
    size = f"CASE WHEN {a} = {_INF}L THEN double('Infinity') WHEN {a} > {_INF}L THEN double('NaN') ELSE {finite} END"
    return f"CASE WHEN {key} < 0 THEN -({size}) ELSE {size} END"


def _counts() -> list:
    return [F.count(F.lit(1)).alias("z_n"), F.min("z_key").alias("z_lo"), F.max("z_key").alias("z_hi")]


def _targets(counted: DataFrame, keys: list[str], parent: list[str], ranks: list[str], total: str) -> DataFrame:
    """The leading parts that hold a target, with the targets' ranks inside them (NULL for the others) and their least and greatest key."""
    part = ", ".join([*_q(*keys), *parent])
    t = counted.selectExpr("*", f"sum(z_n) OVER (PARTITION BY {part} ORDER BY z_p ROWS UNBOUNDED PRECEDING) - z_n AS z_before",
                           f"{total.format(part=part)} AS z_all")
    inside = [f"CASE WHEN z_before <= {r} AND {r} < z_before + z_n THEN {r} - z_before END AS z_t{i}" for i, r in enumerate(ranks)]
    t = t.selectExpr(*_q(*keys), "z_p AS z_q", "z_all AS z_total", "z_lo", "z_hi", *inside)
    return t.where(f"coalesce({', '.join(f'z_t{i}' for i in range(len(ranks)))}) IS NOT NULL").withColumnsRenamed({f"z_t{i}": f"z_r{i}" for i in range(len(ranks))})


def _first(data: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    counted = data.groupBy(*keys, F.shiftright("z_key", SHIFTS[0]).alias("z_p")).agg(*_counts())
    total = "sum(z_n) OVER (PARTITION BY {part})"
    own = total.format(part=", ".join(_q(*keys)))
    return _targets(counted, keys, [], [f"{r}(({own} - 1) * {p!r}D)" for p in probs for r in ("floor", "ceil")], total)


def _next(data: DataFrame, keys: list[str], found: DataFrame, ranks: list[str], level: int) -> DataFrame:
    inside = data.selectExpr("*", f"z_key >> {SHIFTS[level - 1]} AS z_q").join(found, [*keys, "z_q"])
    counted = inside.groupBy(*keys, "z_q", "z_total", *ranks, F.shiftright("z_key", SHIFTS[level]).alias("z_p")).agg(*_counts())
    return _targets(counted, keys, ["z_q"], ranks, "any_value(z_total) OVER (PARTITION BY {part})")


def quantile_rows(long: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], limit: int = DRIVER_ROWS) -> DataFrame:
    """(keys..., n, q): one row a group, q the array of its quantiles in the order of ``probs``.

    Groups without a value have no row, nor have NULL keys. While the targets are at
    most ``limit`` rows, each scan is a job of its own: they reach the driver, go into
    the next scan as a small table, and no scan follows the one that leaves a single
    key for every target. Beyond that, one plan does all scans, and each scan's
    targets are joined by their measured size: broadcast if small, else by key.
    """
    keys, probs = list(keys), [float(p) for p in probs]
    data = order_key(long, value).selectExpr(*_q(*keys), "z_key")
    ranks = [f"z_r{i}" for i in range(2 * len(probs))]
    found = _first(data, keys, probs)
    rows = found.limit(limit + 1).collect() if limit else [None]
    if len(rows) > limit:
        return _lazy(data, keys, found, ranks, probs)
    kinds = T.StructType([long.schema[k] for k in keys])
    ends: dict[tuple, list] = {}
    for level in range(1, len(SHIFTS) + 1):
        left = []
        for r in rows:
            if r["z_lo"] == r["z_hi"]:
                own = ends.setdefault(tuple(r[k] for k in keys), [r["z_total"], *[None] * len(ranks)])
                for i, x in enumerate(ranks):
                    if r[x] is not None:
                        own[1 + i] = _value(r["z_lo"])
            else:
                left.append(tuple(r[c] for c in (*keys, "z_q", "z_total", *ranks)))
        if not left:
            break
        schema = T.StructType([*kinds, *(T.StructField(c, T.LongType()) for c in ("z_q", "z_total", *ranks))])
        rows = _next(data, keys, F.broadcast(data.sparkSession.createDataFrame(left, schema)), ranks, level).collect()
    out = []
    for key, (n, *v) in ends.items():
        q = []
        for k, p in enumerate(probs):
            h, a, b = (n - 1) * p, v[2 * k], v[2 * k + 1]
            q.append(a if a == b else a + (h - math.floor(h)) * (b - a))
        out.append((*key, n, q))
    return data.sparkSession.createDataFrame(out, T.StructType([*kinds, T.StructField("n", T.LongType()), T.StructField("q", T.ArrayType(T.DoubleType()))]))


def _value(key: int) -> float:
    x = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return -x if key < 0 else x


def _lazy(data: DataFrame, keys: list[str], found: DataFrame, ranks: list[str], probs: list[float]) -> DataFrame:
    ends = found.where("z_lo = z_hi")
    for level in range(1, len(SHIFTS)):   # a scan for which no target is left has an empty side, and doesn't run
        found = _next(data, keys, found.where("z_lo <> z_hi").drop("z_lo", "z_hi"), ranks, level)
        ends = ends.unionByName(found.where("z_lo = z_hi"))
    found = ends.selectExpr(*_q(*keys), "z_total", *ranks, f"{key_value('z_lo')} AS z_v")
    one = found.groupBy(*keys).agg(F.max("z_total").alias("z_total"), *[F.expr(f"max(CASE WHEN {r} IS NOT NULL THEN z_v END) AS v{i}") for i, r in enumerate(ranks)])
    h = [f"(z_total - 1) * {p!r}D" for p in probs]
    between = [f"CASE WHEN v{2 * i} = v{2 * i + 1} THEN v{2 * i} ELSE v{2 * i} + ({x} - floor({x})) * (v{2 * i + 1} - v{2 * i}) END" for i, x in enumerate(h)]
    return one.selectExpr(*_q(*keys), "z_total AS n", f"array({', '.join(between)}) AS q")


def unpivoted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(c, v): the values of the columns as doubles, c the column's place."""
    # one array of doubles: the code of an array of structs would be too long a method for the JVM's compiler
    values = spread_small(df.select(*[f"`{c}`" for c in columns])).select(F.expr("array(" + ", ".join(f"cast(`{c}` AS double)" for c in columns) + ")").alias("z_all"))
    return values.select(F.posexplode("z_all").alias("c", "v")).where(F.col("v").isNotNull())


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """column -> its quantiles, None for a column without values; a row a column reaches the driver."""
    columns = list(columns)
    got = {r["c"]: list(r["q"]) for r in quantile_rows(unpivoted(df, columns), ["c"], "v", probs).collect()}
    return {c: got.get(i, [None] * len(probs)) for i, c in enumerate(columns)}


def exact_quantiles(long: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], limit: int = DRIVER_ROWS) -> DataFrame:
    """(keys..., q, value) for every group and probability index q (0-based)."""
    rows = quantile_rows(long, keys, value, probs, limit)
    return rows.select(*keys, F.posexplode("q").alias("q", value))
