"""Repair of conversations by a grammar-compressed dynamic program.

Every conversation becomes a string of symbols, one a row: the role's initial and the
row's first fault. Re-Pair rules, learned from the pair counts of all strings, shorten
them. A symbol stands for a 4 x 4 transfer matrix over what the repaired sequence ends
with (nothing, s, u, a): the least cost of the edits of its rows, and the least audit
string among those of that cost. A rule's matrix is the min-plus product of its two
symbols' matrices, made once, bottom-up, and shared by all conversations.

Audit strings are ropes: a product keeps two references, and compares by ranks. An
edit's insertions stand before its row, so all audits of the same rows end with a
row's letter and hold as many of those; none is a proper prefix of another. So
concatenation keeps their order, and the rank of (left, right) is that of the pair of
ranks. Strings are spelt out only along the one path that is chosen.

Products are associative, so a conversation of any length is cut into segments, which
are sorted, scored and spelt out in parallel. Only its segments' matrices meet in one
place, and its audit, which the result holds as one string. The digest of a repaired
conversation streams its rows once, in constant memory.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, map_tail, saved
from .vocab import kept

#: Initials by class (o: any other); faults by number. A symbol is chr(BASE + 4 * fault + class).
CLASSES, FAULTS = "suao", ("", "blank", "duplicate", "truncated")
BASE = 0x30
#: Symbols of a segment; rounds of the grammar and pairs taken a round at most.
SEGMENT, ROUNDS, PAIRS = 4096, 8, 16
#: Strings whose results a worker keeps.
CACHE = 50_000
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5
NONE = 1 << 60
_START, _S, _U, _A = range(4)
#: What a user or assistant row, kept or made, leads to; rows of other roles can't stay as they are.
_AFTER = {"s": {_START: _S}, "u": {_START: _U, _S: _U, _A: _U}, "a": {_U: _A}}
_INSERTED = {(_START, _U): 1, (_START, _A): 2, (_S, _U): 1, (_S, _A): 2, (_U, _A): 1, (_A, _U): 1}
_END = {_START: 0, _S: 2, _U: 1, _A: 0}


class Transfer:
    """Costs, ranks and ropes of the 16 entries (in-state * 4 + out-state), and counts that add up along a string."""

    __slots__ = ("cost", "rank", "rope", "first", "last", "illegal", "faults")

    def __init__(self, cost, rank, rope, first, last, illegal, faults):
        self.cost, self.rank, self.rope, self.first, self.last, self.illegal, self.faults = cost, rank, rope, first, last, illegal, faults


def _ranked(keys: list) -> list[int]:
    order = {k: i for i, k in enumerate(sorted({k for k in keys if k is not None}))}
    return [NONE if k is None else order[k] for k in keys]


def leaf(symbol: str) -> Transfer:
    """The edits of one row, with what is inserted before it."""
    fault, cls = divmod(ord(symbol) - BASE, 4)
    steps = [(q, q, DELETE, "D") for q in range(4)]
    if FAULTS[fault] not in ("blank", "duplicate"):
        more = UNFINISHED if FAULTS[fault] == "truncated" else 0
        steps += [(a, b, KEEP + more, "K") for a, b in _AFTER.get(CLASSES[cls], {}).items()]
        steps += [(a, b, REROLE + more, "R") for c in "ua" for a, b in _AFTER[c].items()]
    best: list = [None] * 16
    for i in range(4):
        for a, b, cost, letter in steps:
            n = 0 if i == a else _INSERTED.get((i, a))
            if n is not None:
                x = (cost + INSERT * n, "I" * n + letter)
                if best[4 * i + b] is None or x < best[4 * i + b]:
                    best[4 * i + b] = x
    faults = [0, 0, 0, 0]
    faults[fault] = 1
    return Transfer([NONE if x is None else x[0] for x in best], _ranked([None if x is None else x[1] for x in best]), [None if x is None else x[1] for x in best], cls, cls, 0, faults)


def product(a: Transfer, b: Transfer) -> Transfer:
    cost, keys, rope = [NONE] * 16, [None] * 16, [None] * 16
    for i in range(0, 16, 4):
        for j in range(4):
            best = None
            for k in range(4):
                c = a.cost[i + k] + b.cost[4 * k + j]
                if c < NONE and (best is None or (c, a.rank[i + k], b.rank[4 * k + j]) < best[:3]):
                    best = (c, a.rank[i + k], b.rank[4 * k + j], k)
            if best is not None:
                cost[i + j], keys[i + j], rope[i + j] = best[0], best[1:3], (a.rope[i + best[3]], b.rope[4 * best[3] + j])
    legal = CLASSES[a.last] + CLASSES[b.first] in ("su", "ua", "au")
    return Transfer(cost, _ranked(keys), rope, a.first, b.last, a.illegal + b.illegal + (not legal), [x + y for x, y in zip(a.faults, b.faults)])


def spelt(rope) -> str:
    out, stack = [], [rope]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            stack += (x[1], x[0])
    return "".join(out)


class Grammar:
    """Rules in order (pair of symbols -> new symbol) with their transfers, and those of whole strings."""

    def __init__(self, rules: list[str]):
        self.rules = [(pair, new_symbol(i)) for i, pair in enumerate(rules)]
        self.transfer = {chr(BASE + i): leaf(chr(BASE + i)) for i in range(16)}
        for pair, symbol in self.rules:
            self.transfer[symbol] = product(self.transfer[pair[0]], self.transfer[pair[1]])
        self.cache: dict[str, Transfer] = {}

    def compressed(self, text: str) -> str:
        for pair, symbol in self.rules:
            text = text.replace(pair, symbol)
        return text

    def whole(self, text: str) -> Transfer:
        out = self.cache.get(text)
        if out is None:
            level = [self.transfer[c] for c in self.compressed(text)]
            while len(level) > 1:  # what no rule covers, in pairs
                level = [product(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
            out = level[0]
            if len(text) <= 64:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[text] = out
        return out


def new_symbol(i: int) -> str:
    return chr(0x100 + i)


def chosen(segments: list[tuple[list[int], list[int]]]) -> tuple[int, list[tuple[int, int]], int]:
    """Least cost of a conversation from its segments' (cost, rank) matrices, each segment's in- and out-state, the insertions at its end."""
    cost, rank, back = [0, NONE, NONE, NONE], [0, NONE, NONE, NONE], []
    for c, r in segments:
        best: list = [None] * 4
        for j in range(4):
            for k in range(4):
                x = cost[k] + c[4 * k + j]
                if x < NONE and (best[j] is None or (x, rank[k], r[4 * k + j]) < best[j][:3]):
                    best[j] = (x, rank[k], r[4 * k + j], k)
        cost, rank = [NONE if x is None else x[0] for x in best], _ranked([None if x is None else x[1:3] for x in best])
        back.append([None if x is None else x[3] for x in best])
    total, _, state = min((cost[q] + INSERT * _END[q], rank[q], q) for q in range(4) if cost[q] < NONE)
    path, at = [], state
    for b in reversed(back):
        path.append((b[at], at))
        at = b[at]
    return total, path[::-1], _END[state]


def learn(strings: DataFrame, rounds: int = ROUNDS, pairs: int = PAIRS) -> list[str]:
    """Re-Pair rules from all strings (syms, n): a round counts every pair of neighbours and takes the most frequent ones.

    Pairs of one round share no symbol, so their order doesn't matter. At most rounds
    * pairs rules; what they don't cover is multiplied as it stands.
    """
    rules: list[str] = []
    for _ in range(rounds):
        def count(batches, rules=tuple(rules)):
            g, c = [(p, new_symbol(i)) for i, p in enumerate(rules)], Counter()
            for b in batches:
                for text, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for p, symbol in g:
                        text = text.replace(p, symbol)
                    for p in set(map("".join, zip(text, text[1:]))):
                        c[p] += n * text.count(p)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["pair", "n"])

        top = strings.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "pair").limit(4 * pairs).collect()
        used: set[str] = set()
        new = []
        for r in top:
            if len(new) < pairs and not used & set(r["pair"]):
                new.append(r["pair"])
                used |= set(r["pair"])
        if not new:
            break
        rules += new
    return rules


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: the rows, damaged by crc32 of ``conv_id:turn`` mod 20; NULLs are one space there, in roles and in texts."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")), F.lit(20))
    t = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    new = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.sequence(F.lit(1), F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)))
    return t.select("conv_id", "turn", role.alias("role"), new.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _plain(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, sha (of the text): NULL roles and texts are one space."""
    text = lambda c: F.coalesce(F.col(c), F.lit(" "))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text")).withColumn("sha", F.unhex(F.sha2("text", 256)))


def _symbol(fault: Column, cls: Column) -> Column:
    return F.char(F.lit(BASE) + 4 * fault + cls)


def _turns(plain: DataFrame) -> DataFrame:
    """(conv_id, turn, role, sha, syms): one row for all equal rows, with a symbol each; the texts stay behind."""
    first = F.substring("role", 1, 1)
    cls = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    end = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    fault = F.when(~F.col("text").rlike(WORD), 1).when(~end.isin(".", "!", "?"), 3).otherwise(0)
    rows = plain.select("conv_id", "turn", "role", "sha", cls.alias("cls"), fault.alias("fault"))
    rows = saved(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), "turns")
    order = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    firsts = rows.groupBy(F.col("conv_id").alias("f_id"), F.col("role").alias("f_role"), F.col("sha").alias("f_sha")).agg(F.min(order).alias("f"))
    own = rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("f_id")) & (F.col("role") == F.col("f_role")) & (F.col("sha") == F.col("f_sha")))
    blank = F.col("fault") == 1
    one = F.when(blank, 1).when(order.eqNullSafe(F.col("f")), F.col("fault")).otherwise(2)
    more = F.when(blank, 1).otherwise(2)
    return own.select("conv_id", "turn", "role", "sha", F.concat(_symbol(one, F.col("cls")), F.repeat(_symbol(more, F.col("cls")), (F.col("n") - 1).cast("int"))).alias("syms"))


def _segments(turns: DataFrame, segment: int) -> DataFrame:
    """(conv_id, part, k, syms): the symbols in order, in pieces by range partition and number."""
    order = ["conv_id", "turn", "role", "sha"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "syms")

    def cut(batches):
        part, k, at, held, size = TaskContext.get().partitionId(), 0, None, [], 0
        names, kinds = ["conv_id", "part", "k", "syms"], [pa.int64(), pa.int32(), pa.int32(), pa.string()]

        def pieces(out):
            nonlocal k, held, size
            text = "".join(held)
            for i in range(0, len(text), segment):
                out.append((at, part, k, text[i : i + segment]))
                k += 1
            held, size = [], 0

        for b in batches:
            out: list[tuple] = []
            for c, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if held and (c != at or size >= segment):
                    pieces(out)
                at = c
                held.append(s)
                size += len(s)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names)
        out = []
        if held:
            pieces(out)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names)

    return saved(dealt.mapInArrow(cut, "conv_id long, part int, k int, syms string"), "segments")


def _audits(plain: DataFrame, segment: int) -> DataFrame:
    """conv_id, blank, duplicate, truncated, illegal, cost, audit of every conversation with a row."""
    segments = _segments(_turns(plain), segment)
    strings = saved(segments.groupBy("syms").agg(F.count(F.lit(1)).alias("n")), "strings")
    sent = plain.sparkSession.sparkContext.broadcast({"rules": learn(strings)})  # at most ROUNDS * PAIRS pairs

    def score():
        g = kept(sent, "grammar", lambda v: Grammar(v["rules"]))

        def step(conv, part, k, syms):
            t = [g.whole(s) for s in syms]
            return conv, part, k, [x.cost for x in t], [x.rank for x in t], [x.first for x in t], [x.last for x in t], [x.illegal for x in t], [x.faults for x in t]

        return step, lambda: None

    scored = map_tail(segments, score, "conv_id long, part int, k int, cost array<long>, rank array<long>, first int, last int, illegal long, faults array<long>")
    each = F.struct("part", "k", "cost", "rank", "first", "last", "illegal", "faults")
    together = scored.groupBy("conv_id").agg(F.array_sort(F.collect_list(each)).alias("own"))  # a matrix for each SEGMENT rows

    def combine():
        def step(conv, own):
            out: list[list] = [[] for _ in range(7)]
            for segs in own:
                total, path, end = chosen([(s["cost"], s["rank"]) for s in segs])
                faults = [sum(x) for x in zip(*(s["faults"] for s in segs))]
                joints = sum(CLASSES[a["last"]] + CLASSES[b["first"]] not in ("su", "ua", "au") for a, b in zip(segs, segs[1:]))
                for o, x in zip(out, (*faults[1:], sum(s["illegal"] for s in segs) + joints, total, [(s["part"], s["k"], i, j) for s, (i, j) in zip(segs, path)], "I" * end)):
                    o.append(x)
            return conv, *out

        return step, lambda: None

    facts = saved(map_tail(together, combine, "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, path array<struct<part:int,k:int,i:int,j:int>>, tail string"), "conversation-costs")
    path = facts.select(F.explode("path").alias("p")).select("p.*")

    def spell():
        g = kept(sent, "grammar", lambda v: Grammar(v["rules"]))

        def step(conv, part, k, syms, i, j):
            return conv, part, k, [spelt(g.whole(s).rope[4 * x + y]) for s, x, y in zip(syms, i, j)]

        return step, lambda: None

    # part and k are the segment's key: a number of its partition and of its place there
    slices = map_tail(segments.join(path, ["part", "k"]).select("conv_id", "part", "k", "syms", "i", "j"), spell, "conv_id long, part int, k int, slice string")
    words = slices.groupBy(F.col("conv_id").alias("w_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "k", "slice"))), lambda x: x["slice"]), "").alias("audit"))
    return facts.join(words, F.col("conv_id").eqNullSafe(F.col("w_id"))).select(
        "conv_id", "blank", "duplicate", "truncated", "illegal", "cost", F.concat("audit", "tail").alias("audit"))


def repaired(row: str, text: str, letter: str, state: int) -> tuple[tuple[str, str] | None, int]:
    """The (role, text) that an edit leaves, or None, and the state after it."""
    if letter == "D":
        return None, state
    if letter == "K":
        return (row, text), _AFTER[row[:1]][state]
    c = "a" if state == _U else "u"
    return ("assistant" if c == "a" else "user", "" if letter == "I" else text), _AFTER[c][state]


class Editor:
    """Applies an audit to a conversation's rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, _START

    def _step(self, role: str = "", text: str = ""):
        out, self.state = repaired(role, text, self.audit[self.at], self.state)
        self.at += 1
        return out

    def row(self, role: str, text: str) -> list[tuple[str, str]]:
        out = self.rest(True)
        x = self._step(role, text)
        return out if x is None else [*out, x]

    def rest(self, before: bool = False) -> list[tuple[str, str]]:
        out = []
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            out.append(self._step())
        return out


def _streamed(plain: DataFrame, facts: DataFrame) -> DataFrame:
    """Every conversation's facts, then its rows in order; a partition holds whole conversations."""
    own = [c for c in facts.columns if c != "conv_id"]
    head = facts.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("sha"), *own)
    rows = plain.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "sha", *[F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in own])
    return head.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "sha").select("conv_id", "kind", "role", "text", *own)


def repair_report(rows: DataFrame, conversations: DataFrame | None = None, segment: int = SEGMENT) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation.

    ``rows``: conv_id, turn, role, text. Conversations are the ids of ``conversations``
    (default: of ``rows``), NULL being one of them; without rows they give zeros, an
    empty audit and the hash of the empty text. Rows go by turn, NULL first; ties by
    role, then by the text's SHA-256, so equal rows are neighbours. NULL roles and
    texts are one space (an empty text is blank, an empty role is none of s, u, a).
    Repeated rows are duplicates. Other columns are ignored; an empty table gives an
    empty table. The digest of one conversation reads its rows in order in one task,
    row by row; everything else splits long conversations.
    """
    plain = _plain(rows)
    ids = (rows if conversations is None else conversations).select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    turns = plain.select(F.col("conv_id").alias("t_id"), "turn").distinct().groupBy("t_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    audits = _audits(plain, segment).withColumnRenamed("conv_id", "a_id")
    facts = ids.join(turns, F.col("conv_id").eqNullSafe(F.col("t_id")), "left").join(audits, F.col("conv_id").eqNullSafe(F.col("a_id")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    facts = facts.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"))

    def start():
        now: list = [None, None, None, True]  # facts, editor, hash, whether nothing has been written

        def write(lines):
            for role, text in lines:
                now[2].update((("" if now[3] else "\n") + role + ":" + text).encode())
                now[3] = False

        def close():
            write(now[1].rest())
            return *now[0], now[2].hexdigest()

        def step(conv, kind, role, text, *own):
            out = []
            for i, k in enumerate(kind):
                if k == 0:
                    if now[0] is not None:
                        out.append(close())
                    now[:] = [(conv[i], *(c[i] for c in own)), Editor(own[-1][i]), hashlib.sha256(), True]
                else:
                    write(now[1].row(role[i], text[i]))
            return list(map(list, zip(*out))) if out else None

        return step, lambda: None if now[0] is None else [[x] for x in close()]

    return map_tail(_streamed(plain, facts), start, "conv_id long, " + ", ".join(f"{c} long" for c in numbers) + ", audit string, repaired_sha256 string")


def repaired_rows(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, place, role, text: the repaired conversations, row by row; odd rows as for ``repair_report``."""
    plain = _plain(rows)

    def start():
        now: list = [None, None, 0]

        def step(conv, kind, role, text, audit):
            out = []

            def write(lines):
                for r, t in lines:
                    out.append((now[0], now[2], r, t))
                    now[2] += 1

            for i, k in enumerate(kind):
                if k == 0:
                    if now[1] is not None:
                        write(now[1].rest())
                    now[:] = [conv[i], Editor(audit[i]), 0]
                else:
                    write(now[1].row(role[i], text[i]))
            return list(map(list, zip(*out))) if out else None

        def end():
            out = [] if now[1] is None else [(now[0], now[2] + i, r, t) for i, (r, t) in enumerate(now[1].rest())]
            return list(map(list, zip(*out))) if out else None

        return step, end

    return map_tail(_streamed(plain, _audits(plain, segment).select("conv_id", "audit")), start, "conv_id long, place long, role string, text string")
