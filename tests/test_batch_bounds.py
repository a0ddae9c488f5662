"""Batch top-K with bounds: equal to a full ranking under ties and NULLs, and most cells aren't scored on skewed data."""

import numpy as np
import pandas as pd
import pytest

from pitchside.operators import batch as B


def frame(x):
    return pd.DataFrame({"ID": np.arange(len(x)), "Name": "n", "Club": "c", **{f"f{i}": x[:, i] for i in range(x.shape[1])}})


def full(x, w, k, reverse, per_player):
    """(line, rank by score then id): the exact top k of every line, NULLs last."""
    s = x[:, 0:1] * w[0:1]
    for i in range(1, x.shape[1]):
        s = s + x[:, i : i + 1] * w[i : i + 1]
    s = s if per_player else s.T
    key = np.where(np.isnan(s), np.inf, np.round(s if reverse else -s, 6))
    return [set(np.lexsort((np.arange(s.shape[1]), line))[:k].tolist()) for line in key]


def run(x, w, k, reverse, per_player, sizes=(5000,)):
    stats, fl = {}, [f"f{i}" for i in range(x.shape[1])]
    fn = B._batch_fn([f"t{j:04d}" for j in range(w.shape[1])], {"G": w}, {"G": fl}, k, reverse, per_player, stats=stats)
    df = frame(x)
    step = sizes[0]
    out = list(fn([df.iloc[i : i + step] for i in range(0, len(df), step)]))
    lines: dict[int, set] = {}
    for pdf in out:
        for r in pdf.itertuples():
            if per_player:
                lines.setdefault(r.ID, set()).update(int(t[1:]) for t in r.teams)
            else:
                lines.setdefault(int(r.team[1:]), set()).add(r.ID)
    return lines, stats["cells"]


@pytest.mark.parametrize("per_player", [False, True])
@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("seed", range(6))
def test_candidates_hold_the_top_k(monkeypatch, seed, reverse, per_player):
    monkeypatch.setattr(B, "BLOCK_ROWS", 4)
    monkeypatch.setattr(B, "BLOCK_CLUBS", 3)
    r = np.random.default_rng(seed)
    x = r.integers(-3, 6, (60, 3)).astype(float) if seed % 2 else r.normal(0, 5, (60, 3))   # many ties, or none
    w = r.integers(-2, 4, (3, 17)).astype(float) if seed % 2 else r.normal(0, 1, (3, 17))
    if seed > 1:
        x[r.random(x.shape) < 0.1] = np.nan
        w[r.random(w.shape) < 0.05] = np.nan
    if seed == 5:
        x[:, 1] = np.nan
    for k in (1, 4, 30):
        got, _ = run(x, w, k, reverse, per_player, sizes=(23,))
        for line, want in enumerate(full(x, w, k, reverse, per_player)):
            assert want <= got.get(line, set()), (k, line)


@pytest.mark.parametrize("per_player", [False, True])
def test_most_cells_are_skipped_on_skewed_data(per_player):
    r = np.random.default_rng(1)
    x = r.pareto(1.5, (20_000, 1)) * r.uniform(0.9, 1.1, (20_000, 8))
    w = r.pareto(1.5, (1, 400)) * r.uniform(0.9, 1.1, (8, 400))
    got, cells = run(x, w, 10, False, per_player)
    assert cells < 0.25 * len(x) * w.shape[1]
    for line, want in enumerate(full(x[:500] if per_player else x, w, 10, False, per_player)):
        assert want <= got[line]
