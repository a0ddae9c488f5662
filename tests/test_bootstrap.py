"""Bootstraps against the same weights drawn in plain Python; partitions and reruns change nothing."""

import hashlib
import math
import random

import numpy as np
import pytest

from pitchside.operators import bootstrap as BS

N = 40


def draw_weight(key, replicate, seed=7):
    h = hashlib.md5(f"{seed}:{'' if key is None else key}:{replicate // 8}".encode()).hexdigest()
    u, below, w = int(h[4 * (replicate % 8) : 4 * (replicate % 8) + 4], 16), 0.0, 0
    for j in range(16):   # the inverse of the Poisson(1) distribution
        below += math.exp(-1) / math.factorial(j)
        w += u >= round(65536 * below)
    return w


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    out = [(i, r.choice(["A", "A", "A", "B", None]), r.choice([None, 60, 70, 75]), float(r.randint(0, 30)) + 1e6, r.choice([None, 1.0, 5.0, 2.5])) for i in range(60)]
    return out + [(100, "One", 50, 1e6, 1.0), (101, "None", None, None, 1.0), (None, "B", 80, 1e6 + 2, 3.0), (7, "B", 80, 1e6 + 3, 4.0)]   # one player, no value, no id, a repeated id


def table(spark, rows):
    return spark.createDataFrame(rows, "ID long, Club string, Overall int, x double, y double")


def test_weights_are_poisson():
    w = np.array([draw_weight(i, b) for i in range(500) for b in range(N)])
    assert abs(w.mean() - 1) < 0.03 and abs(w.var() - 1) < 0.05


def test_club_interval(spark, rows):
    got = {r.Club: r for r in BS.club_bootstrap_ci(table(spark, rows), replicates=N).collect()}
    again = {r.Club: r for r in BS.club_bootstrap_ci(table(spark, rows[::-1]).repartition(5), replicates=N).collect()}
    assert got == again and set(got) == {"A", "B", "One", "None"}
    for club, r in got.items():
        own = [(i, v) for i, c, v, _, _ in rows if c == club and v is not None]
        means = []
        for b in range(N):
            w = [draw_weight(i, b) for i, _ in own]
            if sum(w):
                means.append(sum(a * v for a, (_, v) in zip(w, own)) / sum(w))
        assert r.n == len(own)
        if not own:
            assert r.boot_low is None and r.boot_high is None
            continue
        assert abs(r.boot_low - np.percentile(means, 2.5)) < 1e-9 and abs(r.boot_high - np.percentile(means, 97.5)) < 1e-9
        assert r.boot_low <= r.mean <= r.boot_high


def test_fit_band(spark, rows):
    got = {(r.feature, r.point): r for r in BS.fit_bands(table(spark, rows), "x", ["y", "Overall"], points=5, replicates=N).collect()}
    assert len(got) == 10
    for name, at in (("y", 4), ("Overall", 2)):
        both = [(r[0], r[3] - 1e6, r[at]) for r in rows if r[3] is not None and r[at] is not None]
        x, y = np.array([b[1] for b in both]), np.array([b[2] for b in both], dtype=float)
        slope, intercept = np.polyfit(x, y, 1)
        places = np.linspace(x.min(), x.max(), 5)
        lines = []
        for b in range(N):
            w = np.array([draw_weight(i, b) for i, _, _ in both], dtype=float)
            lines.append(np.polyval(np.polyfit(x, y, 1, w=np.sqrt(w)), places))
        for p in range(5):
            r = got[name, p]
            assert abs(r.x - 1e6 - places[p]) < 1e-6 and abs(r.fit - (slope * places[p] + intercept)) < 1e-4
            assert abs(r.low - np.percentile([q[p] for q in lines], 2.5)) < 1e-6
            assert abs(r.high - np.percentile([q[p] for q in lines], 97.5)) < 1e-6


def test_no_line_and_no_rows(spark, rows):
    flat = spark.createDataFrame([(i, "A", 5, 3.0, float(i)) for i in range(9)], "ID long, Club string, Overall int, x double, y double")
    for r in BS.fit_bands(flat, "x", ["y"], points=3, replicates=N).collect():
        assert r.fit is None and r.low is None and r.high is None
    assert BS.club_bootstrap_ci(table(spark, rows).limit(0), replicates=N).count() == 0
    assert BS.fit_bands(table(spark, rows).limit(0), "x", ["y"], points=3, replicates=N).count() == 0


def test_shuffle_follows_groups_not_rows(spark, rows):
    p = BS.club_bootstrap_ci(table(spark, rows), replicates=N)._jdf.queryExecution().executedPlan().toString()
    first = p[p.index("partial_sum"):]
    assert "hashpartitioning(Club" not in first.split("Generate")[0] and "Python" not in p
