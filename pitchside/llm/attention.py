"""A causal self-attention model over subword symbols, in numpy.

One head: a symbol's query, key and value are rows of tables; a query attends to
the symbols before it in its window, with a learned weight for each distance. The
next symbol is predicted in two steps, its class and its member of the class.
"""

from __future__ import annotations

import numpy as np

#: Width of the tables, window, and how many of its last places a window scores.
WIDTH, WINDOW, STRIDE = 16, 16, 8
#: Symbols: classes times members. The first three are the end of a text, padding, and all rare subwords.
CLASSES, MEMBERS = 32, 32
SYMBOLS = CLASSES * MEMBERS
END, PAD, RARE = 0, 1, 2


def start_parameters(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    f = lambda *s, scale=0.3: (r.standard_normal(s) * scale).astype(np.float32)
    return {
        "Q": f(SYMBOLS, WIDTH), "K": f(SYMBOLS, WIDTH), "V": f(SYMBOLS, WIDTH), "X": f(SYMBOLS, WIDTH),
        "r": np.zeros(WINDOW, np.float32),
        "C": f(WIDTH, CLASSES), "c": np.zeros(CLASSES, np.float32),
        "M": f(CLASSES, WIDTH, MEMBERS), "m": np.zeros((CLASSES, MEMBERS), np.float32),
    }


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over texts (arrays of symbols, without the end).

    Inputs (windows, WINDOW), targets (windows, STRIDE; PAD where there is none)
    and the text of each window. A text is read from an END and ends with one; each
    of its symbols is the target of exactly one place.
    """
    lead = WINDOW - STRIDE
    counts = np.array([-(-(len(t) + 1) // STRIDE) for t in texts], int)
    size = counts * STRIDE + lead
    at = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(texts) else np.zeros(0, int)
    flat = np.full(int(size.sum()) + 1, PAD, np.int16)
    for t, a in zip(texts, at):
        flat[a + lead] = END
        flat[a + lead + 1 : a + lead + 1 + len(t)] = t
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.repeat(at, counts) + (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
    x = flat[first[:, None] + np.arange(WINDOW)]
    # a place's target is the next input; after a text's last symbol it is END
    last = np.repeat(at + lead + np.array([len(t) for t in texts], int), counts) if len(texts) else at
    place = first[:, None] + lead + np.arange(STRIDE)
    y = flat[np.minimum(place + 1, len(flat) - 1)]
    y = np.where(place == last[:, None], END, np.where(place > last[:, None], PAD, y)).astype(np.int16)
    return x, y, owner


def _masks() -> tuple[np.ndarray, np.ndarray]:
    """Distance of each key from each query, and a mask of the keys that come later."""
    q = np.arange(WINDOW - STRIDE, WINDOW)[:, None]
    k = np.arange(WINDOW)[None]
    return np.maximum(q - k, 0), np.where(k > q, np.float32(-1e9), np.float32(0)).astype(np.float32)


_FAR, _LATER = _masks()


def _attend(p: dict, x: np.ndarray):
    """Queries, keys, values and weights of all places, and their states before the last step."""
    lead, own = WINDOW - STRIDE, x[:, WINDOW - STRIDE :].reshape(-1)
    qx = np.concatenate((p["Q"], p["X"]), 1).take(own, axis=0)
    kv = np.concatenate((p["K"], p["V"]), 1).take(x.reshape(-1), axis=0).reshape(*x.shape, 2 * WIDTH)
    q, k, v = qx[:, :WIDTH].reshape(len(x), WINDOW - lead, WIDTH), kv[:, :, :WIDTH], kv[:, :, WIDTH:]
    s = q @ k.transpose(0, 2, 1)
    s *= np.float32(WIDTH ** -0.5)
    np.clip(s, -20, 20, out=s)
    s += p["r"][_FAR] + _LATER
    np.exp(s, out=s)
    pad = np.flatnonzero((x == PAD).any(1))
    s[pad] *= (x[pad] != PAD)[:, None]
    s /= _row_sums(s) + np.float32(1e-30)  # a place with no key at all is padding
    o = s @ v
    o += qx[:, WIDTH:].reshape(o.shape)
    return q, k, v, s, o.reshape(-1, WIDTH)


class Scorer:
    """Log-probabilities with fixed parameters: queries times keys are one table of symbol pairs."""

    def __init__(self, p: dict):
        self.p = p
        self.table = np.clip(p["Q"] @ p["K"].T * np.float32(WIDTH ** -0.5), -20, 20).astype(np.float32)
        self.table[:, PAD] = -1e9
        self.table = self.table.reshape(-1)
        self.bias = (p["r"][_FAR] + _LATER).astype(np.float32)

    def _states(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.int32)
        q = x[:, WINDOW - STRIDE :]
        s = self.table.take((q * SYMBOLS)[:, :, None] + x[:, None, :])
        s += self.bias
        np.exp(s, out=s)
        o = s @ self.p["V"].take(x, axis=0)
        o /= s.sum(2, keepdims=True) + np.float32(1e-30)
        o += self.p["X"].take(q, axis=0)
        return np.tanh(o, out=o).reshape(-1, WIDTH)

    def log_probs(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural-log probability of each target (windows, STRIDE); 0 where the target is padding."""
        p = self.p
        h = np.concatenate([self._states(x[i : i + 512]) for i in range(0, len(x), 512)])
        y = y.reshape(-1).astype(np.int32)
        cls = y // MEMBERS
        at = np.arange(len(y))
        z = h @ p["C"]
        z += p["c"]
        out = z[at, cls]
        np.exp(z, out=z)
        out -= np.log(z @ np.ones(CLASSES, np.float32))
        order = np.argsort(cls.astype(np.uint8), kind="stable")
        ends = np.cumsum(np.bincount(cls, minlength=CLASSES))
        h = h.take(order, axis=0)
        z = np.empty((len(y), MEMBERS), np.float32)
        for c in range(CLASSES):
            a, b = ends[c - 1] if c else 0, ends[c]
            if a < b:
                np.matmul(h[a:b], p["M"][c], out=z[a:b])
                z[a:b] += p["m"][c]
        got = z[at, (y % MEMBERS).take(order)]
        np.exp(z, out=z)
        got -= np.log(z @ np.ones(MEMBERS, np.float32))
        out[order] += got
        out[y == PAD] = 0
        return out.reshape(len(x), STRIDE)


def _row_sums(d: np.ndarray) -> np.ndarray:
    """Sums along the last axis, kept; along rows this short, a product is faster than numpy's sum."""
    return (d.reshape(-1, d.shape[-1]) @ np.ones(d.shape[-1], d.dtype)).reshape(*d.shape[:-1], 1)


def _runs(d: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that begin at ``first``; two columns at a time, as one complex number."""
    return np.add.reduceat(d.view(np.result_type(d, np.complex64)), first, axis=0).view(d.dtype)


def _sums(size: int, rows: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Sums of d by its row in a table of ``size`` rows."""
    order = np.argsort(rows, kind="stable")
    rows = rows.take(order)
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    out = np.zeros((size, d.shape[1]), d.dtype)
    out[rows[first]] = _runs(d.take(order, axis=0), first)
    return out


def _softmax_loss(z: np.ndarray, at: np.ndarray, own: np.ndarray) -> float:
    """Loss of logits ``z`` with the right column of each row, summed; z becomes the gradient of the mean."""
    if max(z.max(), -z.min()) > 80:  # else no exponential leaves the range
        z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    total = _row_sums(z)
    loss = -np.log(z[at, own] / total[:, 0]).sum()
    share = z.dtype.type(1 / len(z))
    z *= share / total
    z[at, own] -= share
    return loss


def gradients(p: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over the targets and its gradients."""
    rows, kind = x.astype(np.intp), p["Q"].dtype
    q, k, v, s, o = _attend(p, rows)
    # targets by class, without padding: a product for each class, all else over all targets at once
    y = y.reshape(-1).astype(np.intp)
    key = np.where(y == PAD, CLASSES, y // MEMBERS).astype(np.uint8)
    ends = np.cumsum(np.bincount(key, minlength=CLASSES + 1))[:CLASSES].tolist()
    order = np.argsort(key, kind="stable")[: ends[-1]]
    g = {k: np.zeros_like(p[k]) for k in "CcMm"}
    da, loss = np.zeros_like(o), 0.0
    if len(order):
        cls, mem = np.divmod(y.take(order), MEMBERS)
        at = np.arange(len(order))
        parts = [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]
        h = np.tanh(o.take(order, axis=0))
        z = h @ p["C"]
        z += p["c"]
        loss += _softmax_loss(z, at, cls)
        g["C"], g["c"] = (z.T @ h).T, z.sum(0)
        dh = z @ p["C"].T
        back = np.empty_like(h)
        for c, a, b in parts:
            np.dot(h[a:b], p["M"][c], z[a:b])
        z += p["m"].take(cls, axis=0)
        loss += _softmax_loss(z, at, mem)
        for c, a, b in parts:
            np.dot(h[a:b].T, z[a:b], g["M"][c])
            np.dot(z[a:b], p["M"][c].T, back[a:b])
        g["m"][[c for c, _, _ in parts]] = _runs(z, np.array([a for _, a, _ in parts]))
        dh += back
        h *= h
        np.subtract(1, h, out=h)
        dh *= h
        da[order] = dh
    da3 = da.reshape(len(x), STRIDE, WIDTH)
    ds = da3 @ v.transpose(0, 2, 1)
    ds *= s
    ds -= s * _row_sums(ds)
    g["r"] = np.bincount(_FAR.reshape(-1), weights=ds.sum(0).reshape(-1), minlength=WINDOW).astype(kind)
    ds *= kind.type(WIDTH ** -0.5)
    dq, dkv = np.empty((len(da), 2 * WIDTH), kind), np.empty((*x.shape, 2 * WIDTH), kind)
    np.matmul(ds, k, out=dq.reshape(len(x), STRIDE, 2 * WIDTH)[:, :, :WIDTH])
    dq[:, WIDTH:] = da
    np.matmul(ds.transpose(0, 2, 1), q, out=dkv[:, :, :WIDTH])
    np.matmul(s.transpose(0, 2, 1), da3, out=dkv[:, :, WIDTH:])
    for (one, two), at, d in (("QX", x[:, WINDOW - STRIDE :], dq), ("KV", x, dkv)):
        both = _sums(len(p[one]), at.reshape(-1), d.reshape(-1, 2 * WIDTH))
        g[one], g[two] = both[:, :WIDTH].copy(), both[:, WIDTH:].copy()
    return float(loss / max(1, len(order))), g


class Adam:
    def __init__(self, p: dict, rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.a, self.b, self.room = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(3))

    def step(self, g: dict) -> None:
        self.t += 1
        rate = np.float32(self.rate * np.sqrt(1 - 0.99 ** self.t) / (1 - 0.9 ** self.t))
        for k, v in g.items():
            a, b, d = self.a[k], self.b[k], self.room[k]
            np.subtract(v, a, out=d)
            d *= np.float32(0.1)
            a += d
            np.multiply(v, v, out=d)
            d -= b
            d *= np.float32(0.01)
            b += d
            np.sqrt(b, out=d)
            d += np.float32(1e-8)
            np.divide(a, d, out=d)
            d *= rate
            self.p[k] -= d


def learn(p: dict, x: np.ndarray, y: np.ndarray, rate: float, batch: int = 256) -> dict:
    """One pass of Adam over the windows, in the order given."""
    p = {k: v.copy() for k, v in p.items()}
    opt = Adam(p, rate)
    for i in range(0, len(x), batch):
        opt.step(gradients(p, x[i : i + batch], y[i : i + batch])[1])
    return p
