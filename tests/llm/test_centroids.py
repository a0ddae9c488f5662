"""Centroid clustering against brute force in Python integers."""

import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from pitchside.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, dims, k, rounds, prefix="2:"):
    own = []
    for i, v, *_ in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            own.append((i, [max(-C.LIMIT, min(C.LIMIT, math.floor(256 * x))) for x in v]))
    first = sorted((hashlib.sha256(f"{prefix}{'' if i is None else i}".encode()).hexdigest(), v) for i, v in own)[:k]
    cents = [v for _, v in first]

    def assign():
        out = []
        for _, v in own:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        a = assign()
        for c in range(len(cents)):
            mine = [v for (_, v), (x, _) in zip(own, a) if x == c]
            if mine:
                cents[c] = [sum(col) // len(mine) for col in zip(*mine)]
    a = assign()
    inertia = Counter()
    for c, d in a:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return Counter((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for (i, _), (c, d) in zip(own, a))


def odd_rows(dims, n=700, seed=3):
    r = random.Random(seed)
    middles = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(7)]
    out = [(i, [m + r.gauss(0, 0.2) for m in r.choice(middles)], 0) for i in range(n)]
    out += [(5000 + i, list(out[3][1]), 0) for i in range(300)]                       # copies
    out += [(7, list(out[7][1]), 0), (7, list(out[7][1]), 0), (None, list(out[9][1]), 0), (None, [0.0] * dims, 0)]
    out += [(8000, None, 0), (8001, [], 0), (8002, [0.1] * (dims - 1), 0), (8003, [0.1] * (dims + 1), 0), (8004, [math.nan] + [0.0] * (dims - 1), 0),
            (8005, [math.inf] + [0.0] * (dims - 1), 0), (8006, [None] + [0.0] * (dims - 1), 0), (8007, [1e30] + [-1e300] * (dims - 1), 0), (8008, [200.0] * dims, 0)]
    return out


@pytest.mark.parametrize("dims,k", [(64, 40), (3, 5)])
def test_against_brute_force(spark, dims, k):
    rows = odd_rows(dims)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "vec_id AS id", "vec_id AS key", "vec_id AS cluster", "label AS n", "label AS v")
    got = Counter(tuple(r) for r in C.cluster(df.repartition(5), dims, k).collect())
    assert got == brute(rows, dims, k, 5)


def test_few_and_none(spark):
    empty = C.cluster(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[:3] == ["vec_id", "cluster", "distance"]
    rows = [(1, [0.5, -0.5], 0), (2, [0.5, -0.5], 0), (3, None, 0)]
    assert Counter(tuple(r) for r in C.cluster(spark.createDataFrame(rows, SCHEMA), 2, 40).collect()) == brute(rows, 2, 40, 5)


def test_query_against_brute_force(spark):
    from pitchside.llm.queries import QUERIES

    rows = [(r.vec_id, list(r.embedding), 0) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op13_centroids"](spark, "/root/testdata/sf0.01").collect())
    assert got == brute(rows, 64, 40, 5)


@pytest.mark.parametrize("dims,bits", [(2, 1), (2, 2), (3, 2), (2, 4), (4, 2)])
def test_hilbert_neighbours(dims, bits):
    """The curve visits every cell once, and each step moves one component by one."""
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)), np.uint32)
    keys = [int.from_bytes(k.tobytes(), "big") for k in C.hilbert_keys(cells, bits)]
    order = cells[np.argsort(keys)].astype(int)
    assert len(set(keys)) == len(cells)
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_boxes_never_lose_the_nearest_and_spare_work(spark):
    r = np.random.default_rng(5)
    middles = r.normal(0, 300, (20, 8))
    m = np.floor(middles[r.integers(0, 20, 4000)] + r.normal(0, 8, (4000, 8)))
    cents = np.floor(middles + r.normal(0, 10, (20, 8)))
    lo, hi = m[:256].min(0), m[:256].max(0)
    near, far = C.box_bounds(lo[None], hi[None], cents)
    d = ((m[:256, None] - cents[None]) ** 2).sum(2)
    assert (near[0] <= d.min(0)).all() and (far[0] >= d.max(0)).all()
    boxes = np.sort(r.normal(0, 200, (30, 2, 8)), axis=1)
    allowed = C.box_candidates(boxes[:, 0], boxes[:, 1], cents)
    for b, a in zip(boxes, allowed):
        inside = b[0] + r.random((500, 8)) * (b[1] - b[0])
        assert a[((inside[:, None] - cents[None]) ** 2).sum(2).argmin(1)].all()
    df = spark.createDataFrame([(i, (v / 256).tolist(), 0) for i, v in enumerate(m)], SCHEMA)
    got = C.totals(C.curve_blocks(df, 8), 8, cents)
    assert sum(x[0] for x in got.values()) == 4000
    tried, blocks = sum(x[3] for x in got.values()), sum(x[4] for x in got.values())
    assert tried < 0.4 * 20 * blocks   # the boxes leave fewer centroids than all


def test_equal_rows_and_order_do_not_matter(spark):
    rows = odd_rows(6, 400, 11)
    a = C.cluster(spark.createDataFrame(rows, SCHEMA), 6, 9)
    b = C.cluster(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7), 6, 9)
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))
