"""Mixing overlapping sources to target weights by min-cost flow.

Documents are summed by membership pattern (the set of sources that hold them).
The flow sends each pattern's token capacity to the sources' quotas; a pattern's
tokens cost nothing the first time, 1 the second, 2 the third, so repetition is
spread evenly and used last. Sources that overlap, directly or over others, are a
component with a flow of its own, solved in one task; a source that overlaps none
has one arc, the least of its quota and its capacity. Patterns, sources, quotas and
thresholds are tables, however many there are. Documents are selected by a seeded
order: whole copies for everyone, and one more copy for the documents that fit what
is left of the pattern's share, in that order, those larger than what is left skipped
(where the share is more than half, the documents without the further copy are
selected so).
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, fresh, map_lists, saved
from .components import component_roots

#: Copies of a document at most; copy k costs k - 1 a token.
MAX_COPIES = 3
_BITS, _DIGIT = 62, 10
_RANGES = "array<struct<first:long,end:long,most:long>>"


def min_cost_flow(capacity: list[int], members: list[list[int]], quota: list[int], copies: int = MAX_COPIES) -> list[dict[int, int]]:
    """Per pattern, tokens to each source: the most flow, at the least convex repetition cost.

    Successive shortest paths with potentials; pattern p may send at most
    ``copies * capacity[p]`` tokens, to the sources in ``members[p]`` only.
    """
    n_p, n_s = len(capacity), len(quota)
    source, sink, size = n_p + n_s, n_p + n_s + 1, n_p + n_s + 2
    graph: list[list[int]] = [[] for _ in range(size)]
    to, cap, cost = [], [], []

    def arc(a: int, b: int, c: int, w: int) -> int:
        for x, y, z, v in ((a, b, c, w), (b, a, 0, -w)):
            graph[x].append(len(to))
            to.append(y)
            cap.append(z)
            cost.append(v)
        return len(to) - 2

    sent: list[dict[int, int]] = []
    for p in range(n_p):
        for k in range(copies):
            arc(source, p, capacity[p], k)
        sent.append({s: arc(p, n_p + s, copies * capacity[p], 0) for s in members[p]})
    for s in range(n_s):
        arc(n_p + s, sink, quota[s], 0)
    height = [0] * size
    while True:
        dist: list[float] = [float("inf")] * size
        came = [-1] * size
        dist[source], heap = 0, [(0, source)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > dist[x]:
                continue
            for e in graph[x]:
                if cap[e] > 0 and (far := d + cost[e] + height[x] - height[to[e]]) < dist[to[e]]:
                    dist[to[e]], came[to[e]] = far, e
                    heapq.heappush(heap, (far, to[e]))
        if came[sink] < 0:
            break
        height = [h + (d if d < float("inf") else 0) for h, d in zip(height, dist)]
        path, x = [], sink
        while x != source:
            path.append(came[x])
            x = to[came[x] ^ 1]
        amount = min(cap[e] for e in path)
        for e in path:
            cap[e] -= amount
            cap[e ^ 1] += amount
    return [{s: cap[e ^ 1] for s, e in arcs.items() if cap[e ^ 1]} for arcs in sent]


def _order(seed: int, *content: Column) -> Column:
    """62 bits that order the rows: 40 of the content, then 22 that tell equal rows apart."""
    own = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *content), 24)
    tie = F.xxhash64(F.lit(seed), F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << 22) - 1))
    return F.shiftleft(own, 22).bitwiseOR(tie)


def _threshold(sized: DataFrame, need: DataFrame) -> DataFrame:
    """(members, limit, rest): the threshold of the order up to which documents hold at most ``left`` tokens; what then is left.

    ``need`` has (members, since, left). Only documents from the order ``since`` on
    count, and none larger than ``left``. Found digit by digit, for all patterns at
    once: each pass sums the rows whose order begins with the digits found, by the next
    digit (at most 1,024 sums a pattern, combined before the shuffle).
    """
    now = need.select("members", "since", F.col("left").alias("most"), F.col("left").alias("rest"), F.lit(0).cast("long").alias("prefix"), F.lit(None).cast("long").alias("limit"))
    for shift in range(_BITS - _DIGIT, -_DIGIT, -_DIGIT):
        at = max(shift, 0)
        rows = sized.select("members", "size", "b_order").join(now.filter("limit IS NULL"), "members").filter(
            (F.shiftright("b_order", shift + _DIGIT) == F.col("prefix")) & (F.col("b_order") >= F.col("since")) & F.col("size").between(1, F.col("most")))
        sums = rows.groupBy("members", "rest", F.shiftright("b_order", at).alias("digit")).agg(F.sum("size").alias("tokens"), F.count(F.lit(1)).alias("n"))
        # per pattern: the first bucket that no longer fits, and the tokens before it; at most 1,024 entries an array
        found = sums.groupBy("members", "rest").agg(F.array_sort(F.collect_list(F.struct("digit", "tokens", "n"))).alias("d"))
        walk = F.aggregate("d", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("digit"), F.lit(0).cast("long").alias("n")), lambda a, x: F.when(
            a["digit"].isNull() & (a["sum"] + x["tokens"] <= F.col("rest")), F.struct((a["sum"] + x["tokens"]).alias("sum"), a["digit"].alias("digit"), a["n"].alias("n"))).when(
            a["digit"].isNull(), F.struct(a["sum"].alias("sum"), x["digit"].alias("digit"), x["n"].alias("n"))).otherwise(a))
        step = now.join(found.select("members", walk.alias("w")), "members", "left")
        digit, seen = F.col("w.digit"), F.col("limit").isNull()
        limit = F.when(~seen, F.col("limit")).when(digit.isNull(), F.shiftleft(F.col("prefix") + 1, shift + _DIGIT))  # all rows with this prefix fit
        limit = limit.when((F.col("w.n") <= 1) | F.lit(at == 0), F.shiftleft(digit, at))
        now = saved(step.select("members", "since", "most", F.when(seen, F.col("rest") - F.coalesce("w.sum", F.lit(0))).otherwise(F.col("rest")).alias("rest"),
                                F.when(seen, F.coalesce(digit, F.col("prefix"))).otherwise(F.col("prefix")).alias("prefix"), limit.alias("limit")), "mix-digits")
        if now.filter("limit IS NULL").isEmpty():
            break
    return now.select("members", "limit", "rest")


def _selected(sized: DataFrame, need: DataFrame) -> DataFrame:
    """(members, ranges): ranges of the order (first, end, largest size) whose documents are taken, ``need`` tokens at most.

    A range ends at the first document that no longer fits; the next one goes on
    from there with the documents that still fit, until none does. What is left
    shrinks below that document's size each time, so in a random order the ranges
    are few: about the logarithm of the number of documents.
    """
    state = saved(need.select("members", F.lit(0).cast("long").alias("since"), F.col("need").alias("left"), F.array().cast(_RANGES).alias("ranges")), "mix-ranges")
    while not state.filter("left > 0").isEmpty():
        cut = state.join(_threshold(sized, state.filter("left > 0")), "members", "left")
        some = F.col("rest") < F.col("left")
        # nothing is taken only where rows of one order don't fit together: the next range begins behind them
        end = F.when(some, F.col("limit")).otherwise(F.col("limit") + 1)
        further = (F.col("rest") > 0) & (end < F.lit(1 << _BITS))
        new = F.array(F.struct(F.col("since").alias("first"), F.col("limit").alias("end"), F.col("left").alias("most")))
        state = saved(cut.select("members", F.when(further, end).otherwise(F.col("since")).alias("since"), F.when(further, F.col("rest")).otherwise(F.lit(0).cast("long")).alias("left"),
                                 F.when(some, F.concat("ranges", new)).otherwise(F.col("ranges")).alias("ranges")), "mix-ranges")
    return state.select("members", "ranges")


def sources_of(patterns: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """(source, size, weight, place) of each source in ``patterns`` (members, size); places in code point order, NULL last.

    The sort numbers the sources within its parts; the driver adds up the parts'
    counts, one a shuffle partition.
    """
    spark = patterns.sparkSession
    own = patterns.select(F.explode("members").alias("source"), "size").groupBy("source").agg(F.sum("size").alias("size"))
    own = saved(own.orderBy(F.col("source").isNull(), "source").withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    own = own.withColumn("part", F.shiftright("at", 33))
    firsts, total = [], 0
    for r in own.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        firsts.append((r["part"], total))
        total += r["n"]
    own = own.join(F.broadcast(spark.createDataFrame(firsts, "part long, first long")), "part")
    own = own.select("source", "size", (F.col("first") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("place"))
    if weights is None:
        return own.withColumn("weight", 1.0 + F.col("place") % 3)
    given = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], "name string, weight double")
    return own.join(given, F.col("source").eqNullSafe(F.col("name")), "left").select("source", "size", "place", F.coalesce("weight", F.lit(0.0)).alias("weight"))


def quotas(sources: DataFrame, most: int = MAX_COPIES) -> DataFrame:
    """``sources`` (size, weight, ...) with ``target``: shares of all sizes; none above ``most`` times its size, the excess reshared by weight.

    Every source gets its weight times one level, or its bound if that is less.
    The level rises from pass to pass, each one aggregate, until no further source
    reaches its bound.
    """
    level, bound, last = 0.0, most * F.col("size"), -1
    while True:
        over, real = F.lit(level) * F.col("weight") > bound, (F.col("weight") > 0) & (F.col("size") > 0)
        r = sources.agg(F.sum("size").alias("all"), F.count(F.when(real & over, 1)).alias("n"), F.sum(F.when(real & over, bound)).alias("bound"),
                        F.sum(F.when(real & ~over, F.col("weight"))).alias("weight")).first()
        if r["n"] == last:
            break
        if not r["weight"]:
            level = float("inf")
            break
        level, last = (r["all"] - (r["bound"] or 0)) / r["weight"], r["n"]
    return sources.withColumn("target", F.when(F.col("weight") > 0, F.least(F.lit(level) * F.col("weight"), bound.cast("double"))).otherwise(F.lit(0.0)))


def flows(patterns: DataFrame, sources: DataFrame, copies: int = MAX_COPIES) -> DataFrame:
    """(members, sent): the tokens that each pattern (members, size) sends to the sources (source, place, target) by the least-cost flow.

    A source that no other overlaps takes the least of its quota and its pattern's
    copies, in columns. Others are grouped by component; one task solves one component.
    """
    arcs = patterns.select("members", "size", F.explode("members").alias("name")).join(
        sources, F.col("name").eqNullSafe(F.col("source"))).select("members", patterns["size"], "place", F.rint("target").cast("long").alias("quota"))
    trivial = arcs.select("members", F.least("quota", copies * F.col("size")).alias("sent"))
    if patterns.filter(F.size("members") > 1).isEmpty():
        return trivial
    arcs = saved(arcs, "mix-arcs")
    wide = arcs.groupBy("members").agg(F.min("place").alias("u"), F.collect_list("place").alias("v")).filter(F.size("v") > 1)
    roots = component_roots(wide.select("u", F.explode("v").alias("v")))
    arcs = arcs.join(roots, arcs["place"] == roots["v"], "left").withColumn("root", F.coalesce("root", "place"))
    linked = roots.select("root").distinct()
    alone = arcs.join(linked, "root", "left_anti").select("members", F.least("quota", copies * F.col("size")).alias("sent"))
    parts = arcs.join(linked, "root").groupBy("root", "members", "size").agg(F.sort_array(F.collect_list(F.struct("place", "quota"))).alias("to"))
    parts = parts.groupBy("root").agg(F.sort_array(F.collect_list(F.struct("to", "size", "members"))).alias("patterns"))

    def start():
        def one(ps):
            quota = dict(sorted({t["place"]: t["quota"] for p in ps for t in p["to"]}.items()))
            at = {s: i for i, s in enumerate(quota)}
            return min_cost_flow([p["size"] for p in ps], [[at[t["place"]] for t in p["to"]] for p in ps], list(quota.values()), copies)

        def step(groups):
            return ([p["members"] for ps in groups for p in ps], [sum(f.values()) for ps in groups for f in one(ps)])

        return step

    return alone.unionByName(map_lists(parts.select("patterns"), start, "members array<string>, sent long"))


def mix(docs: DataFrame, members: Column, weights: dict[str | None, float] | None = None, seed: int = 7, carry: list[str] = ()) -> DataFrame:
    """doc_id, members, size, copies, taken and ``carry`` for each row of ``docs``; ``sources`` gives the quotas.

    ``members``: array of the sources that hold the row (NULL is a source of its
    own). ``weights``: source -> weight; by default 1, 2, 3, repeating, in code
    point order, NULL last. A row's size is its number of words; NULL and empty
    texts have size 0 and are never taken. Equal rows are separate documents. An
    empty table gives an empty table; other columns are ignored. The texts are read
    once for their sizes and never shuffled; sums are combined before shuffling.
    """
    sized, plan, _ = _plan(docs, members, weights, seed, carry)
    return _take(sized, plan)


def _plan(docs, members, weights, seed, carry):
    text = F.xxhash64(F.col("text"))
    held = F.coalesce(F.array_sort(F.array_distinct(members)), F.array().cast("array<string>"))
    sized = saved(docs.select(
        "doc_id", *carry, held.alias("members"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _order(seed, F.col("doc_id").cast("string"), text).alias("b_order")), "mix-sizes")
    patterns = saved(sized.groupBy("members").agg(F.sum("size").alias("size")), "mix-patterns")
    sources = saved(quotas(sources_of(patterns, weights)), "mix-targets")
    sent, n = F.coalesce("sent", F.lit(0)), F.col("size")
    plan = patterns.join(flows(patterns, sources), "members", "left").select(
        "members", "size", F.when(n > 0, F.expr("coalesce(sent, 0) div size")).otherwise(F.lit(0)).cast("long").alias("b_whole"), F.when(n > 0, sent % n).otherwise(F.lit(0)).alias("more"))
    out = 2 * F.col("more") > n  # rather the documents that get no further copy are selected
    plan = saved(plan.select("members", "b_whole", out.alias("b_out"), F.when(out, n - F.col("more")).otherwise(F.col("more")).alias("need")), "mix-plan")
    ranges = _selected(sized, plan.select("members", "need"))
    return sized, plan.join(ranges, "members").select("members", "b_whole", "b_out", F.col("ranges").alias("b_ranges")), sources


def _take(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row with its copies. Spark broadcasts the plan, a row a pattern, where its size allows, and else splits a hot pattern's rows."""
    more = F.exists("b_ranges", lambda r: (F.col("b_order") >= r["first"]) & (F.col("b_order") < r["end"]) & (F.col("size") <= r["most"])) != F.col("b_out")
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("b_whole") + more.cast("long")).cast("long")
    return sized.join(saved(plan, "mix-taken"), "members").withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).drop(
        "b_order", "b_whole", "b_ranges", "b_out")


def mix_report(docs: DataFrame, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, where each document's one source is its column ``source``."""
    sized, plan, sources = _plan(docs, F.array("source"), None, seed, [])
    small = plan.join(sources.select(F.array("source").alias("members"), F.col("size").alias("source_size"), "target"), "members")
    return _take(sized, small).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The columns of ``docs``, a row for each copy that the mix takes; rows without a word are not taken."""
    extra, = fresh(docs.columns, "row")
    keyed = docs.withColumn(extra, F.struct(*docs.columns))
    taken = mix(keyed, F.array("source"), None, seed, [extra])
    copies = taken.filter("copies > 0").select(extra, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return copies.select(f"{extra}.*")
