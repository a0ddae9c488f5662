"""Near-duplicates by SetSketch registers.

A document's set of word shingles becomes 128 registers: minima of exponential
hashes, truncated to powers of a base near 1. Registers merge by taking maxima
and are equal with a probability that grows with the Jaccard similarity, so bands
of four registers give candidates. A joint likelihood over two documents' registers
estimates their similarity, and what passes is verified on the full sets.

Equal sets are one class from the start. Buckets of a band are linked in rounds:
each round compares members only with a pivot of another component, so a group of
near copies costs its size, not its square. Documents of buckets that still hold
several components are then compared exactly: pairs of different components that
share one of their rarest shingles (two sets can only be similar enough if they
share one among the first n - least * n + 1 by a common order) and whose sizes and
places in that order allow the similarity.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import fresh, lower_words, map_lists, saved_few
from .components import component_roots
from .vocab import Cache

REGISTERS, ROWS = 128, 4
BASE, SCALE, TOP = 1.001, 20.0, 65534
#: Words of each of the two generations whose hashes a task keeps; hashing a word again is cheap.
CACHE_WORDS = 100_000
#: Rounds with one pivot a bucket, before what is still apart is compared pair by pair.
PIVOT_ROUNDS = 2
#: A pair whose estimate is lower than the threshold by this (over 6 standard errors) is not verified.
MARGIN = 0.2
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_words(cache: Cache, text: str | None) -> np.ndarray:
    w = lower_words(text)
    return np.fromiter(map(cache.__getitem__, w), np.uint64, len(w))


def word_cache() -> Cache:
    return Cache(lambda w: xxhash.xxh3_64_intdigest(w), CACHE_WORDS)


def shingle_set(h: np.ndarray, k: int = 3) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; of the whole sequence if it has fewer words."""
    n = len(h)
    if n == 0:
        return h
    width = min(n, k)
    s = np.full(n - width + 1, width, np.uint64) * _M[3]
    for i in range(width):
        s = _mixed(s * _M[1] + h[i : n - width + 1 + i] * _M[i % 3] + np.uint64(i))
    return np.unique(s)


_A = _mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64) * _M[0])
_ODD, _ADD = (_A >> np.uint64(32)).astype(np.uint32) | np.uint32(1), _A.astype(np.uint32) | np.uint32(1)


def registers(s: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of hashes; those of a union are the maxima of the parts' registers."""
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(s), 2048):
        part = s[i : i + 2048]
        x = part.astype(np.uint32)[None] * _ODD[:, None]
        x += (part >> np.uint64(32)).astype(np.uint32)[None] * _ADD[:, None]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(low, x.min(axis=1), out=low)
    least = -np.log1p(-(low + 0.5) / 2.0 ** 32)  # the least of the set's exponential hashes
    return np.clip(np.floor(1 - np.log(least / SCALE) / np.log(BASE)), 0, TOP).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key a band, for registers of shape (documents, REGISTERS)."""
    r = regs.reshape(len(regs), REGISTERS // ROWS, ROWS).astype(np.uint64)
    key = np.arange(REGISTERS // ROWS, dtype=np.uint64)[None] * _M[3]
    for i in range(ROWS):
        key = _mixed(key * _M[1] + r[:, :, i] + np.uint64(i + 1))
    return key.astype(np.int64)


def joint_estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, steps: int = 64) -> np.ndarray:
    """Maximum-likelihood Jaccard similarities of pairs, from how many registers are greater, less and equal."""
    up, down = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    j = most * (np.arange(steps + 1)[None] / steps)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    more, less = p(u - v * j), p(v - u * j)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    like = up * log(more) + down * log(less) + (a.shape[1] - up - down) * log(1 - more - less)
    return np.take_along_axis(j, like.argmax(1)[:, None], 1)[:, 0]


def sketches(docs: DataFrame, k: int = 3) -> DataFrame:
    """doc_id, r1, r2 (keys of the row), set_hash, n_shingles, regs: one scan, no shuffle."""
    text = F.coalesce("text", F.lit(""))
    t = docs.select("doc_id", F.xxhash64("doc_id", F.lit(1), "text").alias("r1"), F.xxhash64("text", F.lit(2), "doc_id").alias("r2"), text.alias("text"))

    def start():
        cache = word_cache()

        def step(ids, r1, r2, texts):
            sets = [shingle_set(hashed_words(cache, x), k) for x in texts]
            return (ids, r1, r2, [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], [len(s) for s in sets],
                    [registers(s).tobytes() if len(s) else None for s in sets])

        return step

    return map_lists(t, start, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, r1 long, r2 long, set_hash binary, n_shingles long, regs binary")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(u, v) of the pairs (a, b) whose sizes and joint estimate allow it and whose full sets have a similarity of ``least`` or more."""
    side = lambda c: sets.select(F.col("cid").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("n", "regs", "items")])
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(F.least("n_a", "n_b") >= F.lit(least) * F.greatest("n_a", "n_b"))
    cent = round(100 * least)

    def start():
        def same(x, y):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            n = len(np.intersect1d(x, y, assume_unique=True))
            return 100 * n >= cent * (len(x) + len(y) - n)

        def step(a, b, na, ra, sa, nb, rb, sb):
            if not a:
                return [], []
            view = lambda r: np.frombuffer(b"".join(r), np.uint16).reshape(-1, REGISTERS)
            likely = joint_estimate(view(ra), view(rb), np.array(na, float), np.array(nb, float)) >= least - MARGIN
            ok = [bool(k) and same(x, y) for k, x, y in zip(likely, sa, sb)]
            return [x for x, y in zip(a, ok) if y], [x for x, y in zip(b, ok) if y]

        return step

    return map_lists(both.select("a", "b", "n_a", "regs_a", "items_a", "n_b", "regs_b", "items_b"), start, "u long, v long")


def _candidate_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """cid, n, regs, items (the sorted shingle hashes) of one document of each wanted class (cid, r1, r2, n, regs)."""
    t = docs.select(F.xxhash64("doc_id", F.lit(1), "text").alias("r1"), F.xxhash64("text", F.lit(2), "doc_id").alias("r2"), "text")
    t = t.join(wanted, ["r1", "r2"]).dropDuplicates(["r1", "r2"]).select("cid", "n", "regs", "text")

    def start():
        cache = word_cache()
        return lambda cid, n, regs, texts: (cid, n, regs, [shingle_set(hashed_words(cache, x), k).tobytes() for x in texts])

    return map_lists(t, start, "cid long, n long, regs binary, items binary")


def _labelled(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``members`` with comp, the root of the component so far."""
    if roots is None:
        return members.withColumn("comp", F.col("cid"))
    return members.join(roots.select(F.col("v").alias("cid"), "root"), "cid", "left").withColumn("comp", F.coalesce("root", "cid")).drop("root")


def _pivot_pairs(members: DataFrame, roots: DataFrame | None, rnd: int) -> DataFrame:
    """(a, b): each member of a bucket (column band) with the bucket's pivot, where their components differ.

    The first pivot is the member that shares most buckets, later ones are drawn by a hash.
    """
    m = _labelled(members, roots)
    order = F.struct("deg", "cid", "comp") if rnd == 0 else F.struct(F.xxhash64("cid", F.lit(rnd)).alias("deg"), "cid", "comp")
    apart = m.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(order).alias("p")).filter("lo < hi")
    pairs = m.join(apart.select("band", F.col("p.cid").alias("o_cid"), F.col("p.comp").alias("o_comp")), "band").filter("comp != o_comp")
    return pairs.select(F.least("cid", "o_cid").alias("a"), F.greatest("cid", "o_cid").alias("b")).distinct()


def _rare_shingles(sets: DataFrame, least: float) -> DataFrame:
    """band (a shingle), cid, n, place: the first n - least * n + 1 shingles of each set, rarest first.

    Shingles of one set only count in the order but are left out: no pair shares them.
    """
    def start():
        return lambda cid, items: (cid, [np.frombuffer(x, np.int64) for x in items])

    each = map_lists(sets.select("cid", "items"), start, "cid long, items array<long>").select("cid", F.size("items").alias("n"), F.explode("items").alias("band"))
    often = each.groupBy("band").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    order = each.join(often, "band").groupBy("cid", "n").agg(F.sort_array(F.collect_list(F.struct("often", "band"))).alias("s"))
    own = F.col("n") - F.size("s")
    first = F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9) + 1
    keep = F.greatest(first - own, F.lit(0)).cast("int")
    return order.select("cid", "n", own.alias("own"), F.posexplode(F.slice("s", F.lit(1), keep)).alias("i", "x")).select(
        F.col("x.band").alias("band"), "cid", "n", (F.col("own") + F.col("i")).alias("place"))


def _apart_pairs(rare: DataFrame, roots: DataFrame | None, least: float) -> DataFrame:
    """(a, b): all pairs of different components that share a rare shingle and may be similar enough."""
    m = saved_few(_labelled(rare, roots), "apart")
    o = m.select("band", *[F.col(c).alias(f"o_{c}") for c in ("cid", "comp", "n", "place")])
    common = F.lit(1) + F.least(F.col("n") - F.col("place"), F.col("o_n") - F.col("o_place")) - 1  # at most, if this is the first that they share
    enough = F.lit(least / (1 + least)) * (F.col("n") + F.col("o_n")) - 1e-6
    pairs = m.join(o, (m["band"] == o["band"]) & (F.col("cid") < F.col("o_cid")) & (F.col("comp") != F.col("o_comp")) & (common >= enough))
    return pairs.select(F.col("cid").alias("a"), F.col("o_cid").alias("b")).distinct()


def _classes(docs: DataFrame, k: int, least: float) -> tuple[DataFrame, DataFrame]:
    """The sketch table, and (set_hash, comp): the component of each class of equal sets that has a word."""
    sk = saved_few(sketches(docs, k), "sketches")
    by_set = sk.filter("n_shingles > 0").groupBy("set_hash").agg(F.min(F.struct("r1", "r2")).alias("r"), F.min("n_shingles").alias("n"), F.min("regs").alias("regs"))
    classes = saved_few(by_set.select(F.monotonically_increasing_id().alias("cid"), "set_hash", F.col("r.r1").alias("r1"), F.col("r.r2").alias("r2"), "n", "regs"), "classes")

    def start():
        return lambda cid, regs: (cid, list(band_keys(np.frombuffer(b"".join(regs), np.uint16).reshape(-1, REGISTERS))) if cid else [])

    bands = map_lists(classes.select("cid", "regs"), start, "cid long, keys array<long>").select("cid", F.explode("keys").alias("band"))
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = saved_few(bands.join(shared, "band"), "members")
    wanted = members.groupBy("cid").agg(F.sum("size").alias("deg"))
    wanted = saved_few(classes.join(wanted, "cid").select("cid", "r1", "r2", "n", "regs", "deg"), "wanted")
    sets = saved_few(_candidate_sets(docs, wanted.drop("deg"), k), "sets")
    members = saved_few(members.join(wanted.select("cid", "deg"), "cid").select("band", "cid", "deg"), "members")
    roots, tested = None, None

    def joined(pairs):
        """Verifies the pairs not tested yet and joins the components of those that are linked."""
        nonlocal roots, tested
        pairs = saved_few(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        links = _verified(pairs, sets, least)
        before = roots.select(F.col("v").alias("u"), F.col("root").alias("v")) if roots is not None else None
        roots = component_roots(links if before is None else links.union(before))

    for rnd in range(PIVOT_ROUNDS):
        joined(_pivot_pairs(members, roots, rnd))
    m = _labelled(members, roots)
    apart = m.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("band")
    rare = _rare_shingles(sets.join(m.join(apart, "band").select("cid").distinct(), "cid"), least)
    joined(_apart_pairs(rare, roots, least))
    comps = classes.select("set_hash", "cid").join(roots.select(F.col("v").alias("cid"), "root"), "cid", "left").select("set_hash", F.coalesce("root", "cid").alias("comp"))
    return sk, comps


def near_duplicates(docs: DataFrame, k: int = 5, least: float = 0.8) -> DataFrame:
    """doc_id, r1, r2 (keys of the row), n_shingles, component_id, kept, first for each row of ``docs``.

    Rows are linked where the Jaccard similarity of their distinct k-word shingles
    (A-Z lower-cased; the whole sequence with fewer words) is ``least`` or more.
    component_id is the smallest doc_id that links reach. Texts that are NULL or
    have no word have an empty set, link with nothing and are their own component.
    Rows of equal sets are linked, whatever their ids; kept tells the component's
    smallest id, and first one single row key of it. NULL ids sort last. Other columns are
    ignored; an empty table gives an empty table.
    """
    sk, comps = _classes(docs, k, least)
    rows = saved_few(sk.select("doc_id", "r1", "r2", "n_shingles", "set_hash").join(comps, "set_hash", "left").drop("set_hash"), "rows")
    lead = rows.filter(F.col("comp").isNotNull()).groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "r1", "r2")).alias("l"))
    t = rows.join(lead, "comp", "left")
    alone = F.col("comp").isNull()
    comp_id = F.when(alone, F.col("doc_id")).otherwise(F.col("l.doc_id"))
    return t.select("doc_id", "r1", "r2", "n_shingles", comp_id.alias("component_id"), F.col("doc_id").eqNullSafe(comp_id).alias("kept"),
                    (alone | ((F.col("r1") == F.col("l.r1")) & (F.col("r2") == F.col("l.r2")))).alias("first"))


def deduplicated(docs: DataFrame, k: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, and every row without a word (once if rows are equal)."""
    a, b, row = fresh(docs.columns, "r1", "r2", "row")
    found = saved_few(near_duplicates(docs, k, least).filter("first").select("r1", "r2"), "stay").distinct()
    keyed = docs.select(F.xxhash64("doc_id", F.lit(1), "text").alias(a), F.xxhash64("text", F.lit(2), "doc_id").alias(b), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    stay = keyed.join(found.select(F.col("r1").alias(a), F.col("r2").alias(b)), [a, b])
    return stay.dropDuplicates([a, b]).select(*[F.col(f"{row}.`{c}`").alias(c) for c in docs.columns])
