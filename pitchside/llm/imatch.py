"""I-Match fingerprints with randomised lexicon subsets.

The lexicon holds the terms whose share of documents lies in a band. A text's
distinct lexicon terms are sorted, and each of many random subsets of the lexicon
gives one hash of the terms it keeps. Subsets come in levels (level l keeps a
term with probability 2 ** -l); a fingerprint has the three levels from the
number of its terms on, so short and long texts, and texts that share a part only,
can be compared: the likeness is the share of equal hashes among subsets that
keep a term of either text.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import lower_words, map_lists, map_tail
from .vocab import kept

#: Share of documents that hold a lexicon term. LEAST bounds the lexicon: at most
#: (distinct words of a mean document) / LEAST terms, however many documents there are.
LEAST, MOST = 0.005, 0.2
SUBSETS, LEVELS = 48, 3
#: Documents whose terms a task counts before it hands on the frequent ones.
CHUNK = 4096
#: Ranges of ids at most.
RANGES = 10_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def lexicon(docs: DataFrame, least: float = LEAST, most: float = MOST) -> list[bytes]:
    """Terms whose document frequency lies in [least, most] of all documents, sorted.

    First pass: each chunk of documents hands on the terms that at least
    least / 2 of its documents hold; a term of the band loses less than half its
    count by that, so the candidates are those with at least half the count: a
    number bounded by mean distinct words / (least / 2). Second pass: their exact
    counts.
    """
    text = docs.select("text")
    total = text.count()

    def gather():
        seen, held = Counter(), 0

        def flush():
            nonlocal held
            out = [(k, n) for k, n in seen.items() if n >= least / 2 * held]
            seen.clear()
            held = 0
            return [k for k, _ in out], [n for _, n in out]

        def step(texts):
            nonlocal held
            for t in texts:
                seen.update(set(lower_words(t)))
            held += len(texts)
            return flush() if held >= CHUNK else None

        return step, lambda: flush() if held else None

    some = map_tail(text, gather, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least / 2 * total)
    sent = docs.sparkSession.sparkContext.broadcast({"terms": [bytes(r["term"]) for r in some.select("term").collect()]})

    def count():
        own = frozenset(sent.value["terms"])
        seen = Counter()

        def step(texts):
            for t in texts:
                seen.update(own.intersection(lower_words(t)))

        return step, lambda: (list(seen), list(seen.values()))

    exact = map_tail(text, count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return sorted(bytes(r["term"]) for r in exact.filter((F.col("n") >= least * total) & (F.col("n") <= most * total)).select("term").collect())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prepare(terms: list[bytes], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term, and the highest level at which each subset keeps it."""
    h = np.array([int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little") for t in terms], np.uint64)
    k = _mixed(np.arange(1, SUBSETS + 1, dtype=np.uint64) * _MIX + np.uint64(seed))
    u = (_mixed(h[:, None] ^ k[None]) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return h, np.minimum(-np.log2(np.maximum(u, 1e-19)), 60).astype(np.uint8)


class Marker:
    """Fingerprints of texts for one lexicon."""

    def __init__(self, value: dict):
        self.seed = value["seed"]
        terms = value["terms"]
        self.place = dict(zip(terms, range(len(terms))))
        self.hash, self.levels = _prepare(terms, self.seed)
        with np.errstate(over="ignore"):
            self.odd = _mixed(np.arange(1, 1 << 16, dtype=np.uint64)) | np.uint64(1)

    def mark(self, text: str | None) -> str:
        """``<level>:<hex>``; ``*`` before it where no word is in the lexicon and all words count; empty without a word."""
        words = set(lower_words(text))
        if not words:
            return ""
        own = sorted(i for i in map(self.place.get, words) if i is not None)
        if own:
            h, levels = self.hash.take(own), self.levels.take(own, axis=0)
        else:
            h, levels = _prepare(sorted(words), self.seed)
        low = round(np.log2(len(h)))
        out = np.zeros((LEVELS, SUBSETS), ">u2")
        in_low = levels.T >= low
        k, t = np.nonzero(in_low)  # by subset, then in the terms' order
        lev, h = levels[t, k], h[t]
        for j in range(LEVELS):
            if j:
                keep = lev >= low + j
                k, h, lev = k[keep], h[keep], lev[keep]
            if not len(k):
                break
            start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            rank = np.arange(len(k)) - np.repeat(start, np.diff(np.r_[start, len(k)]))
            sums = _mixed(np.add.reduceat(h * self.odd[rank % len(self.odd)], start))
            out[j, k[start]] = sums % np.uint64(65535) + np.uint64(1)
        return ("" if own else "*") + f"{low}:" + out.tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among subsets that keep a term of either text, over the levels that both have."""
    if a == b:
        return 1.0
    if not a or not b or (a[0] == "*") != (b[0] == "*"):
        return 0.0
    (la, ha), (lb, hb) = a.lstrip("*").split(":"), b.lstrip("*").split(":")
    la, lb = int(la), int(lb)
    lo, n = max(la, lb), LEVELS - abs(la - lb)
    if n <= 0:
        return 0.0
    x = np.frombuffer(bytes.fromhex(ha), ">u2").reshape(LEVELS, SUBSETS)[lo - la : lo - la + n]
    y = np.frombuffer(bytes.fromhex(hb), ">u2").reshape(LEVELS, SUBSETS)[lo - lb : lo - lb + n]
    either = np.count_nonzero(x | y)
    return float(np.count_nonzero((x == y) & (x > 0)) / either) if either else 0.0


def fingerprints(docs: DataFrame, least: float = LEAST, most: float = MOST, seed: int = 7) -> DataFrame:
    """doc_id and fingerprint of each row: the general operator, one more scan after the lexicon's two, no shuffle of texts.

    NULL and empty texts have the empty fingerprint; equal texts have equal ones.
    """
    sent = docs.sparkSession.sparkContext.broadcast({"terms": lexicon(docs, least, most), "seed": seed})

    def start():
        m = kept(sent, "marker", Marker)
        return lambda ids, texts: (ids, list(map(m.mark, texts)))

    return map_lists(docs.select("doc_id", "text"), start, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def _place(key: Column, cuts: list[int], low: int, high: int, sub: int) -> Column:
    """Range of an id, ascending: quantile cuts first, then equal widths between two cuts."""
    edges = [low, *cuts, high]
    i = F.size(F.filter(F.lit(cuts), lambda c: c < key)) if cuts else F.lit(0)
    edge = lambda k: F.get(F.lit(edges), k).cast("double")
    within = (key.cast("double") - edge(i)) / (edge(i + 1) - edge(i) + 1)
    return i * sub + F.greatest(F.lit(0), F.least(F.lit(sub - 1), F.floor(within * sub).cast("int")))


def _with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, b_key, b_dest, b_guest): ranges of ids, each with a copy of the row that follows its last.

    The ranges come from a narrow pass over the ids; the first row of each range
    goes to the range before it too, and the very first to the last range. At most
    RANGES rows reach the driver.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    t = docs.select("doc_id", "text", key.alias("b_key"))
    n, low, high = t.agg(F.count(F.lit(1)), F.min("b_key"), F.max("b_key")).first()
    ranges = min(RANGES, max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), n // 8192))
    first = min(ranges, 100)
    cuts = t.agg(F.percentile_approx("b_key", [i / first for i in range(1, first)] or [0.5], 10_000).alias("c")).first()["c"]
    cuts = sorted(set(cuts or [])) if first > 1 else []
    place = _place(F.col("b_key"), cuts, low or 0, high or 0, -(-ranges // first))
    t = t.withColumn("b_own", place)
    ends = sorted((r["b_own"], r["k"]) for r in t.groupBy("b_own").agg(F.max("b_key").alias("k")).collect())
    # descending ids: after the last row of a range comes the greatest of the range below, after the lowest the greatest of all
    goes = [(k, ends[(i + 1) % len(ends)][0]) for i, (_, k) in enumerate(ends)]
    t = t.join(F.broadcast(spark.createDataFrame(goes, "b_key long, b_to int")), "b_key", "left")  # a row a range
    own = F.array(F.struct(F.col("b_own").alias("d"), F.lit(0).alias("g")))
    dest = F.when(F.col("b_to").isNull(), own).otherwise(F.concat(own, F.array(F.struct(F.col("b_to").alias("d"), F.lit(1).alias("g")))))
    return t.select("doc_id", "text", "b_key", F.inline(dest).alias("b_dest", "b_guest")).repartition(ranges, "b_dest").sortWithinPartitions(
        "b_dest", "b_guest", F.desc("b_key"), F.xxhash64("text"))


def edit(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprint_edits(docs: DataFrame, least: float = LEAST, most: float = MOST, seed: int = 7) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row.

    The next document is that of the next lower id (NULL lowest, equal ids by a
    hash of the text), after the last the first. NULL texts count as empty; an
    empty table gives an empty table; other columns are ignored. The texts are
    shuffled once, by ranges of ids; a task holds two rows at a time.
    """
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    sent = docs.sparkSession.sparkContext.broadcast({"terms": lexicon(docs, least, most), "seed": seed})

    def start():
        m = kept(sent, "marker", Marker)
        held = None  # (range, id, text, fingerprint) of the row before

        def step(ids, texts, dests, guests):
            nonlocal held
            out = []
            for i, t, d, g in zip(ids, texts, dests, guests):
                t = t or ""
                if held is None and g:
                    continue  # a further guest of equal id
                fp = m.mark(t)
                if held is not None and held[0] == d:
                    _, hi, ht, hf = held
                    new = edit(ht, t)
                    ef = hf if new == ht else m.mark(new)
                    out.append((hi, len(ht), hashlib.sha256(new.encode()).hexdigest(), hf, ef, likeness(hf, ef), likeness(hf, fp)))
                held = None if g else (d, i, t, fp)
            return tuple(map(list, zip(*out))) if out else tuple([] for _ in range(7))

        return step

    return map_lists(_with_next(docs).select("doc_id", "text", "b_dest", "b_guest"), start, schema)
