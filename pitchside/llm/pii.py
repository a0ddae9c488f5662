"""Personal data by bootstrapped contextual extraction.

Four patterns find seed entities in every text. The word before an entity is its
lexical pattern; key-like words that no seed covers are further instances. Spark
scores the graph of patterns and instances in rounds: a pattern is as good as the share of
its instances that are believed times the share of the word's uses (in texts with
instances) that introduce one, an instance as good as its patterns together. What good patterns introduce and no seed covers is reported as kind
``context``.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, map_lists, saved_few

KINDS = ["email", "ip", "card", "phone", "context"]
#: Rounds of scoring; distinct seeds that a pattern needs; what pattern and instance must reach to be reported.
ROUNDS, SUPPORT, PATTERN, INSTANCE = 3, 5, 0.6, 0.6

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_EDGE = ".,;\"'()"
_SPAN = "struct<rank:int,start:int,end:int>"


class Patterns:
    """The compiled patterns (made in the task)."""

    def __init__(self):
        self.domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
        self.ip = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
        self.card = re.compile(r"[0-9](?:[ -]?[0-9])+")
        self.phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
        self.word = re.compile(r"[^ \t-\r]+")
        self.key = re.compile(r"[0-9@]")

    def emails(self, text: str):
        """Leftmost matches, in linear time: the local part is what stands before each @."""
        end, at = 0, text.find("@")
        while at >= 0:
            before = text[end:at]
            n = len(before) - len(before.rstrip(_LOCAL))
            m = self.domain.match(text, at) if n else None
            if m:
                yield at - n, m.end()
            last = at
            end = m.end() if m else end
            at = text.find("@", max(last + 1, end))
            end = max(end, last + 1) if not m else end

    def seeds(self, text: str) -> list[tuple[int, int, int]]:
        """(rank of the kind, start, end) by kind, then start."""
        out = [(0, a, b) for a, b in self.emails(text)] if "@" in text else []
        for m in self.ip.finditer(text) if "." in text else ():
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                out.append((1, *m.span()))
        for m in self.card.finditer(text):
            if m.end() - m.start() >= 16 and luhn([int(c) for c in m.group() if c not in " -"]):
                out.append((2, *m.span()))
        for m in self.phone.finditer(text) if "+" in text else ():
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append((3, *m.span()))
        return out

    def before(self, text: str, start: int) -> str | None:
        """The word before a position, lower-cased, at most 40 characters of it; None at a text's start."""
        k = start
        while k > 0 and text[k - 1] in " \t\n\v\f\r":
            k -= 1
        w = re.split(r"[ \t-\r]", text[max(0, k - 40) : k])[-1].strip(_EDGE).lower()
        return w or None

    def instances(self, text: str, seeds: list[tuple[int, int, int]]):
        """(pattern, instance, start, end, is seed) of seeds and of uncovered words with five digits or an @ in them."""
        for _, a, b in seeds:
            if w := self.before(text, a):
                yield w, xxhash.xxh3_64_intdigest(text[a:b]) >> 1, a, b, True
        if not self.key.search(text):
            return
        cover = sorted((a, b) for _, a, b in seeds)
        k = 0
        for m in self.word.finditer(text):
            s = m.group()
            if not self.key.search(s):
                continue
            a = m.start() + len(s) - len(s.lstrip(".,;:\"'()"))
            b = m.start() + len(s.rstrip(".,;:\"'()"))
            if b <= a or (sum("0" <= c <= "9" for c in s) < 5 and "@" not in text[a + 1 : b - 1]):
                continue
            while k < len(cover) and cover[k][1] <= a:
                k += 1
            if k < len(cover) and cover[k][0] < b:
                continue
            if w := self.before(text, m.start()):
                yield w, xxhash.xxh3_64_intdigest(text[a:b]) >> 1, a, b, False


def with_uses(text: str, near: list[tuple]) -> list[dict]:
    """The instances as structs; uses: how often the pattern's word stands in the text, divided among its instances."""
    if not near:
        return []
    own = Counter(x[0] for x in near)
    uses = Counter(w for w in (w.strip(_EDGE) for w in text.lower().split()) if w in own)
    return [dict(zip(("pattern", "instance", "start", "end", "seed"), x)) | {"uses": max(1.0, uses[x[0]] / own[x[0]])} for x in near]


def luhn(digits: list[int]) -> bool:
    if not 16 <= len(digits) <= 19:
        return False
    back = digits[::-1]
    return (sum(back[::2]) + sum(sum(divmod(2 * d, 10)) for d in back[1::2])) % 10 == 0


def _row_keys() -> list[Column]:
    return [F.xxhash64("doc_id", F.lit(1), "text").alias("r1"), F.xxhash64("text", F.lit(2), "doc_id").alias("r2")]


def extracted(docs: DataFrame) -> DataFrame:
    """doc_id, row keys, seeds, their digest, and near: (pattern, instance, start, end, seed, uses) structs. One scan."""
    t = docs.select("doc_id", *_row_keys(), F.coalesce("text", F.lit("")).alias("text"))

    def start():
        p = Patterns()

        def step(ids, r1, r2, texts):
            seeds = [p.seeds(x) for x in texts]
            near = [with_uses(t, list(p.instances(t, s))) for t, s in zip(texts, seeds)]
            sha = [hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in s).encode()).hexdigest() for s in seeds]
            return ids, r1, r2, [[dict(zip(("rank", "start", "end"), x)) for x in s] for s in seeds], sha, near

        return step

    return map_lists(t, start, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, r1 long, r2 long, seeds array<{_SPAN}>, base_sha256 string, "
                               "near array<struct<pattern:string,instance:long,start:int,end:int,seed:boolean,uses:double>>")


def scored(near: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, pattern: float = PATTERN) -> DataFrame:
    """(pattern, instance, p_score, i_score, seed) for each edge of the graph of ``near`` (pattern, instance, seed, uses).

    Edges are distinct; a pattern's or an instance's score is a sum combined before
    the shuffle, and a hot pattern's edges are joined to one row of scores.
    """
    edges = saved_few(near.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("times"), F.sum("uses").alias("uses")), "edges")
    known = edges.groupBy("instance").agg(F.max("seed").alias("known"))
    state = saved_few(edges.join(known, "instance").withColumn("i_score", F.col("known").cast("double")), "scores")
    for _ in range(rounds):
        by_pattern = state.groupBy("pattern").agg((F.sum("i_score") / (F.count(F.lit(1)) + 1) * F.sum("times") / F.sum("uses")).alias("p_score"), F.sum(F.col("known").cast("int")).alias("n"))
        by_pattern = by_pattern.withColumn("p_score", F.when(F.col("n") >= support, F.col("p_score")).otherwise(0.0)).drop("n")
        edge = state.drop("i_score", "p_score").join(by_pattern, "pattern")
        by_instance = edge.groupBy("instance").agg((1 - F.exp(F.sum(F.when(F.col("p_score") >= pattern, F.log(1 - F.col("p_score"))).otherwise(0.0)))).alias("t_score"))
        state = saved_few(edge.join(by_instance, "instance").withColumn("i_score", F.when(F.col("known"), 1.0).otherwise(F.col("t_score"))).drop("t_score"), "scores")
    return state


def discovered(found: DataFrame, pattern: float = PATTERN, instance: float = INSTANCE) -> DataFrame:
    """r1, r2, added: spans that no seed covers, after a good pattern, of a believed instance."""
    near = found.filter(F.size("near") > 0).select("r1", "r2", F.explode("near").alias("x")).select("r1", "r2", "x.*")
    state = scored(near.select("pattern", "instance", "seed", "uses"))
    good = state.filter(~F.col("seed") & (F.col("p_score") >= pattern) & (F.col("i_score") >= instance)).select("pattern", "instance")
    hits = near.filter(~F.col("seed")).join(good, ["pattern", "instance"])
    return hits.groupBy("r1", "r2").agg(F.sort_array(F.collect_set(F.struct(F.lit(len(KINDS) - 1).alias("rank"), "start", "end"))).alias("added"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), s["rank"]), s["start"], s["end"])), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context for each row.

    ``spans`` has kind:start:end of the seeds and of what contexts add, by kind,
    then start. NULL and empty texts have none. Equal rows give equal rows; rows
    that share an id only are told apart by their text; other columns are ignored;
    an empty table gives an empty table. Texts are read once and never shuffled.
    """
    found = saved_few(extracted(docs), "pii")
    t = found.drop("near").join(discovered(found), ["r1", "r2"], "left")
    count = lambda k: F.size(F.filter("seeds", lambda s: s["rank"] == KINDS.index(k))).cast("long")
    added = F.coalesce("added", F.array().cast(f"array<{_SPAN}>"))
    return t.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:4]], "base_sha256", _joined(F.concat("seeds", added)).alias("spans"),
                    F.size(added).cast("long").alias("n_context"))


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in brackets; n_chars, if there, is that of the new text.

    NULL texts stay NULL. Where spans overlap, the first by start is replaced as a
    whole with what overlaps it. The texts meet the few spans that contexts add by
    one shuffle.
    """
    found = saved_few(extracted(docs).select("r1", "r2", "near"), "pii")
    added = discovered(found)
    names = [c for c in docs.columns if c != "text"]
    r1, r2, more = fresh(docs.columns, "r1", "r2", "added")
    keyed = docs.select("text", *names, F.xxhash64("doc_id", F.lit(1), "text").alias(r1), F.xxhash64("text", F.lit(2), "doc_id").alias(r2))
    t = keyed.join(added.select(F.col("r1").alias(r1), F.col("r2").alias(r2), F.col("added").alias(more)), [r1, r2], "left")

    def start():
        p = Patterns()

        def one(text, added):
            if text is None:
                return None
            out, at, label, end = [], 0, None, -1
            spans = sorted((a, b, k) for k, a, b in [*p.seeds(text), *((x["rank"], x["start"], x["end"]) for x in added or ())])
            for a, b, k in spans:
                if a < end:
                    end = max(end, b)
                    continue
                if label is not None:
                    out += [f"[{KINDS[label].upper()}]"]
                    at = end
                out.append(text[at:a])
                label, end = k, b
            if label is not None:
                out += [f"[{KINDS[label].upper()}]"]
                at = end
            return "".join(out) + text[at:]

        def step(added, texts, *rest):
            return [one(x, s) for x, s in zip(texts, added)], *rest

        return step

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ["text", *names])
    new = map_lists(t.select(more, "text", *names), start, schema)
    if "n_chars" in names:
        new = new.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return new.select(*docs.columns)
