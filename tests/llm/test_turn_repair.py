"""Conversation repair against a suffix program over whole audit strings, and against all edits of short ones."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from pitchside.llm import turn_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
SHAPE = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    """Of a conversation's ordered (role, text): the first fault of each."""
    seen, out = set(), []
    for role, text in rows:
        t = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not t.strip(" \t\n\x0b\x0c\r") else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best_edits(rows, kinds):
    """(cost, audit, repaired): from the last row to the first, whole strings compared."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "", []), "a": (0, "", []), "s": None, "u": None}

    def inserted(best):
        for _ in range(2):
            new = dict(best)
            for (q, c), p in after.items():
                if c != "s" and best[p] is not None:
                    x = (best[p][0] + 5, "I" + best[p][1], [("user" if c == "u" else "assistant", ""), *best[p][2]])
                    if new[q] is None or x[:2] < new[q][:2]:
                        new[q] = x
            best = new
        return best

    best = inserted(best)
    for (role, text), kind in zip(reversed(rows), reversed(kinds)):
        new = {q: None if x is None else (x[0] + 2, "D" + x[1], x[2]) for q, x in best.items()}
        if kind not in ("blank", "duplicate"):
            for (q, c), p in after.items():
                for letter, cost, name in (("K", 0, role), ("R", 1, "user" if c == "u" else "assistant")):
                    if (letter == "K" and role[:1] == c or letter == "R" and c != "s") and best[p] is not None:
                        x = (best[p][0] + cost + (5 if kind == "truncated" else 0), letter + best[p][1], [(name, text), *best[p][2]])
                        if new[q] is None or x[:2] < new[q][:2]:
                            new[q] = x
        best = inserted(new)
    return best[""]


def brute(rows, ids=None):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = Counter()
    for conv in set(by) if ids is None else set(ids):
        own = sorted(by.get(conv, []), key=lambda r: (*r[:3], hashlib.sha256(r[3].encode()).digest()))
        turns = [r[1] for r in own if r[0]]
        told = [r[2:] for r in own]
        kinds = faults(told)
        cost, audit, fixed = best_edits(told, kinds)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:]))
        out[conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(f"{a}:{b}" for a, b in fixed).encode()).hexdigest()] += 1
    return out


def odd_rows(seed=2):
    r = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "User", None, "agent"]
    texts = ["Yes.", "No!", "and then", "  ", "", None, "Why?\n", "a.b", "x \x85", "same. ", "\t.\r\n"]
    out = [(i, r.choice([None, *range(9)]) if r.random() < 0.3 else j, r.choice(roles), r.choice([*texts, *(f"line {n}." for n in range(9))]))
           for i in range(150) for j in range(r.randint(1, 9))]
    out += [(900, j, ["user", "assistant"][j % 2] if r.random() < 0.9 else "system", f"turn {j}" + r.choice([".", ".", ".", ""])) for j in range(900)]
    out += [(901, j % 50, "user", "again and again.") for j in range(400)] + [(902, None, "user", "x."), (902, None, "assistant", "y."), (None, 3, "user", "q."), (None, 9, "assistant", "r.")]
    return out


def run(spark, rows, **k):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "conv_id AS kind", "conv_id AS audit", "conv_id AS part", "conv_id AS cost", "text AS sha", "turn AS n")
    return R.repair_report(df.repartition(6), **k)


@pytest.mark.parametrize("segment", [R.SEGMENT, 7])
def test_against_brute_force(spark, segment):
    rows = odd_rows()
    got = run(spark, rows, segment=segment)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_query_against_brute_force(spark):
    from pitchside.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = Counter(tuple(r) for r in QUERIES["op12_turn_repair"](spark, "/root/testdata/sf0.01").collect())
    assert got == brute(damage(rows), {r[0] for r in rows})


def test_damage(spark):
    rows = odd_rows(8)
    assert Counter(map(tuple, R.damaged(spark.createDataFrame(rows, SCHEMA)).collect())) == Counter(damage(rows))
    # conversations that the damage removes stay in the report
    gone = [(i, 0, "user", "a.") for i in range(200) if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    df = spark.createDataFrame(gone, SCHEMA)
    got = R.repair_report(R.damaged(df), df).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert gone and {tuple(r) for r in got} == {(r[0], 0, 0, 0, 0, 0, 0, "", empty) for r in gone}


def test_rows(spark):
    rows = odd_rows(4)
    got = R.repaired_rows(spark.createDataFrame(rows, SCHEMA).repartition(3), segment=50).orderBy("conv_id", "place").collect()
    by = {}
    for r in got:
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    want = {x[0]: x[8] for x in brute(rows)}
    for conv, sha in want.items():
        own = by.get(conv, [])
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in own).encode()).hexdigest() == sha
        assert SHAPE.fullmatch("".join(a[:1] for a, _ in own))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert R.repair_report(df).count() == 0 and R.repair_report(R.damaged(df), df).count() == 0 and R.repaired_rows(df).count() == 0


def every_edit(symbols):
    """Least (cost, audit) among all edits of a string of symbols, with up to two insertions at each place."""
    def options(s):
        fault, cls = divmod(ord(s) - R.BASE, 4)
        yield "D", 2, ""
        if fault not in (1, 2):
            more = 5 if fault == 3 else 0
            yield "K", more, R.CLASSES[cls]
            yield "R", 1 + more, "u"
            yield "R", 1 + more, "a"

    gaps = ["", "u", "a", "uu", "ua", "au", "aa"]
    best = None
    for edit in itertools.product(*(list(options(s)) for s in symbols)):
        for ins in itertools.product(gaps, repeat=len(symbols) + 1):
            roles = ins[0] + "".join(e[2] + g for e, g in zip(edit, ins[1:]))
            if SHAPE.fullmatch(roles):
                x = (sum(e[1] for e in edit) + 5 * sum(map(len, ins)), "I" * len(ins[0]) + "".join(e[0] + "I" * len(g) for e, g in zip(edit, ins[1:])))
                best = x if best is None else min(best, x)
    return best


def test_all_edits_of_short_conversations():
    alphabet = [chr(R.BASE + i) for i in range(16) if i // 4 != 2]  # a duplicate is edited as a blank row
    g = R.Grammar([])
    for s in [*alphabet, *map("".join, itertools.product(alphabet, repeat=2)), *random.Random(1).sample(list(map("".join, itertools.product(alphabet, repeat=3))), 12)]:
        t = g.whole(s)
        cost, [(i, j)], end = R.chosen([(t.cost, t.rank)])
        assert (cost, R.spelt(t.rope[4 * i + j]) + "I" * end) == every_edit(s)


def test_grammar_changes_nothing_but_the_length(spark):
    r = random.Random(6)
    texts = ["".join(chr(R.BASE + r.choice([0, 1, 1, 1, 2, 2, 2, 3, 5, 9, 13, 14])) for _ in range(r.randint(1, 200))) for _ in range(60)] + [(chr(R.BASE + 1) + chr(R.BASE + 2)) * 300]
    rules = R.learn(spark.createDataFrame([(t, 1 + i % 3) for i, t in enumerate(texts)], "syms string, n long"))
    plain, short = R.Grammar([]), R.Grammar(rules)
    assert len(rules) > 20 and sum(map(len, map(short.compressed, texts))) < 0.6 * sum(map(len, texts))
    for t in texts:
        a, b = plain.whole(t), short.whole(t)
        assert (a.cost, a.rank, a.first, a.last, a.illegal, a.faults) == (b.cost, b.rank, b.first, b.last, b.illegal, b.faults)
        assert [x is None or R.spelt(x) == R.spelt(y) for x, y in zip(a.rope, b.rope)] == [True] * 16


def test_ranks_are_the_order_of_the_strings():
    r = random.Random(9)
    g = R.Grammar([])
    for _ in range(200):
        t = g.whole("".join(chr(R.BASE + r.randrange(16)) for _ in range(r.randint(1, 12))))
        strings = [None if x is None else R.spelt(x) for x in t.rope]
        order = sorted({x for x in strings if x is not None})
        assert t.rank == [R.NONE if x is None else order.index(x) for x in strings]
