"""Line deduplication against brute force, with keys on both paths (streamed ranges, frequent keys)."""

import hashlib
import os
import random
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import data  # noqa: E402
from pitchside.llm import line_dedup as L  # noqa: E402

LOWER = str.maketrans(L.UPPER, L.LOWER)


def kept_lines(rows, chars=40, docs=5):
    """For each row: all lines, and those that stay."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    where = {}
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            where.setdefault(key(x), set()).add(-1 if i is None else i)
    gone = {k: max(v) for k, v in where.items() if len(k) >= chars and len(v) >= docs}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        out.append((lines, [x for x in lines if key(x) not in gone or gone[key(x)] == (-1 if i is None else i)]))
    return out


def brute(rows, **k):
    return Counter((r[0], len(a), len(a) - len(b), hashlib.sha256("\n".join(b).encode()).hexdigest()) for r, (a, b) in zip(rows, kept_lines(rows, **k)))


def line_rows(seed=5):
    r = random.Random(seed)
    common = [f"Line {i} that is long enough to count, Ünïcode ÄB and all, number {i * 7919}" for i in range(12)]
    ends = ["", " ", "\t ", "\r", "  \x0b\x0c", " ", " \x85"]
    out = []
    for i in range(120):
        lines = [f"own {i} {j} " + "x" * r.randint(0, 60) for j in range(r.randint(0, 6))]
        lines += [r.choice(["", " "]) + (c.upper() if r.random() < 0.1 else c) + r.choice(ends) for c in common[: r.randint(0, 12)] for _ in range(r.randint(1, 2))]
        if r.random() < 0.8:
            lines.append("the one hot line that stands nearly everywhere in here")
        r.shuffle(lines)
        out.append((i, "\n".join(lines), "en", "a", 0))
    long = [common[0] if j % 3 else f"line {j} of the very long document, which goes on" for j in range(700)]
    out += [(500, "\n".join(long), "en", "a", 0), (501, "\n".join(["z" * 5000] * 3), "en", "a", 0), (502, "\n\n\n", "en", "a", 0), (503, "\n".join(common), "de", "b", 0),
            (503, "\n".join(common), "de", "b", 0), (503, "\n".join(common[::-1]) + "\n", "de", "b", 0), (None, common[2] + "\n" + common[3], None, None, None),
            (None, common[2], None, None, None), (7, common[1], "en", "a", 0)]
    return out + data.rows()


@pytest.mark.parametrize("share,least", [(L.SHARE, L.HOT_LEAST), (20, 10), (10 ** 9, 0)])
def test_against_brute_force(spark, share, least):
    rows = line_rows()
    got = L.line_report(data.clashing(spark, rows).repartition(5), share=share, hot_least=least)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_few_documents_and_short_lines_stay(spark):
    long = "a line of just forty code points, äöüß!!"
    assert len(long) == 40
    rows = [(i, f"{long}\n{long[:-1]}\nrest {i}", None, None, 0) for i in range(4)]
    assert all(r.n_dropped == 0 for r in L.line_report(data.table(spark, rows)).collect())
    rows.append((4, long, None, None, 0))
    got = {r.doc_id: r.n_dropped for r in L.line_report(data.table(spark, rows)).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 1, 4: 0}
    rows[4] = (3, long, None, None, 0)  # a second row of the document 3
    assert all(r.n_dropped == 0 for r in L.line_report(data.table(spark, rows)).collect())


def test_texts(spark):
    rows = line_rows()
    df = data.table(spark, rows)
    got = L.deduplicated(df, share=30, hot_least=20)
    assert got.columns == df.columns and got.dtypes == df.dtypes
    want = Counter((r[0], None if r[1] is None else "\n".join(b), r[2], r[3], None if r[1] is None else len("\n".join(b))) for r, (_, b) in zip(rows, kept_lines(rows)))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_bitmaps_are_compressed(spark):
    rows = line_rows()
    maps = {(r.doc_id, r.n_dropped): r for r in L.keep_bitmaps(data.table(spark, rows)).collect()}
    r = maps[500, 466]
    assert [w.word for w in r.words] == sorted({j // 64 for j in range(700) if j % 3})
    assert sum(64 - bin(w.bits & (2 ** 64 - 1)).count("1") for w in r.words) == 466
    alone = data.table(spark, [(i, "first\n" * 6400 + "the only line of this text which others have", None, None, 0) for i in range(6)])
    assert all([w.word for w in r.words] == [100] for r in L.keep_bitmaps(alone).collect())


def test_sketch_is_bounded_and_finds_the_hot_line(spark):
    lines = L.line_table(data.table(spark, line_rows()), 40)
    hot = [r.h1 for r in L.hot_hashes(lines, share=20, least=10).collect()]
    counts = Counter(r.h1 for r in lines.collect())
    assert set(hot) == {h for h, n in counts.items() if n * 20 > sum(counts.values()) and n > 10} and hot


def test_native_plan(spark):
    plan = L.line_report(data.table(spark))._jdf.queryExecution().toString()
    for word in ("Python", "MapInArrow", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_empty(spark):
    empty = data.table(spark, [])
    assert L.line_report(empty).count() == 0 and L.deduplicated(empty).count() == 0 and L.keep_bitmaps(empty).count() == 0
