"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word (with a boundary byte on either side) in
both directions and labels every position; a document's probabilities pool the
labels of all its positions. It is trained in numpy by backpropagation through
time on a bounded sample of labelled rows. As a word's labels depend on the word
alone, each distinct word of a batch is read once.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, crc_of_id, fresh, lower_words, map_lists
from .vocab import kept

#: Bounds of the training sample: labelled documents a language, words a document.
TRAIN_DOCS, TRAIN_WORDS = 250, 50
HIDDEN, EPOCHS, BATCH, RATE = 16, 3, 256, 0.01
#: Bytes of a training segment. A prediction reads words whole, in batches of POSITIONS at most (one word at least).
SEGMENT, POSITIONS = 24, 1024 * 26
#: Distinct words whose labels a worker keeps.
CACHE_WORDS = 250_000
NONE = "und"


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


class ByteGRU:
    """Parameters in float32: per direction W (256, 3H) by byte, U (H, 3H), b (3H); output O (2H, K), c (K)."""

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 7):
        r = np.random.default_rng(seed)
        self.h = hidden
        f = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p[f"W{d}"] = f(256, 3 * hidden, scale=0.3)
            self.p[f"U{d}"] = f(hidden, 3 * hidden, scale=hidden ** -0.5)
            self.p[f"b{d}"] = np.zeros(3 * hidden, np.float32)
        self.p["O"] = f(2 * hidden, classes, scale=(2 * hidden) ** -0.5)
        self.p["c"] = np.zeros(classes, np.float32)

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """States after each position; x, mask: (positions, batch)."""
        H, W, U, b = self.h, self.p[f"W{d}"], self.p[f"U{d}"], self.p[f"b{d}"]
        h = np.zeros((x.shape[1], H), np.float32)
        out, memo = [None] * len(x), [None] * len(x)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            a, u = W[x[t]] + b, h @ U
            zr = _sigmoid(a[:, : 2 * H] + u[:, : 2 * H])
            z, r = zr[:, :H], zr[:, H:]
            n = np.tanh(a[:, 2 * H :] + r * u[:, 2 * H :])
            m = mask[t][:, None]
            if keep:
                memo[t] = (h, z, r, n, u[:, 2 * H :], m)
            h = h + m * (1 - z) * (n - h)
            out[t] = h
        return np.stack(out), memo

    def log_probs(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """(positions, batch, classes) log-probabilities of every position's label."""
        return _log_softmax(np.concatenate([self._read(d, x, mask) for d in "fb"], axis=2) @ self.p["O"] + self.p["c"])

    def _read(self, d: str, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """What ``_run`` gives, with nothing kept for learning."""
        H, U = self.h, self.p[f"U{d}"]
        W = self.p[f"W{d}"] + self.p[f"b{d}"]
        W[:, : 2 * H] *= 0.5  # a sigmoid is half a tanh of half its input
        U = np.concatenate([U[:, : 2 * H] * 0.5, U[:, 2 * H :]], axis=1)
        out = np.empty((*x.shape, H), np.float32)
        whole = mask.all(1)
        h = np.zeros((x.shape[1], H), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            a, u = W.take(x[t], axis=0), h @ U
            g = a[:, : 2 * H]
            g += u[:, : 2 * H]
            np.tanh(g, out=g)
            g += 1
            g *= 0.5
            n = u[:, 2 * H :]
            n *= g[:, H:]
            n += a[:, 2 * H :]
            np.tanh(n, out=n)
            # h + (1 - z) * (n - h), nothing at padded positions
            z = 1 - g[:, :H]
            if not whole[t]:
                z *= mask[t][:, None]
            h = np.add(h, z * (n - h), out=out[t])
        return out

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over positions, and its gradients by backpropagation through time."""
        H, p = self.h, self.p
        (sf, mf), (sb, mb) = self._run("f", x, mask, True), self._run("b", x, mask, True)
        s = np.concatenate([sf, sb], axis=2)
        lp = _log_softmax(s @ p["O"] + p["c"])
        total = mask.sum()
        loss = -(lp[:, np.arange(len(y)), y] * mask).sum() / total
        d = np.exp(lp)
        d[:, np.arange(len(y)), y] -= 1
        d *= mask[:, :, None] / total
        g = {"O": np.einsum("tbh,tbk->hk", s, d), "c": d.sum((0, 1))}
        ds = d @ p["O"].T
        for k, (dirn, memo) in enumerate((("f", mf), ("b", mb))):
            W, U = np.zeros_like(p[f"W{dirn}"]), np.zeros_like(p[f"U{dirn}"])
            b, dh = np.zeros_like(p[f"b{dirn}"]), np.zeros_like(sf[0])
            for t in range(len(x) - 1, -1, -1) if dirn == "f" else range(len(x)):
                h, z, r, n, un, m = memo[t]
                dh = dh + ds[t][:, k * H : (k + 1) * H]
                dn = dh * m * (1 - z) * (1 - n * n)
                dz = dh * m * (h - n) * z * (1 - z)
                dr = dn * un * r * (1 - r)
                da = np.concatenate([dz, dr, dn], axis=1)
                du = np.concatenate([dz, dr, dn * r], axis=1)
                np.add.at(W, x[t], da)
                U += h.T @ du
                b += da.sum(0)
                dh = dh * (1 - m * (1 - z)) + du @ p[f"U{dirn}"].T
            g |= {f"W{dirn}": W, f"U{dirn}": U, f"b{dirn}": b}
        return float(loss), g


def _log_softmax(x):
    x = x - x.max(-1, keepdims=True)
    return x - np.log(np.exp(x).sum(-1, keepdims=True))


def padded(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and mask, (positions, batch), with a space on either side of each segment."""
    n = max(map(len, segments)) + 2
    x = np.frombuffer(b"".join((b" " + s + b" ").ljust(n) for s in segments), np.uint8).reshape(-1, n).T
    return x, (np.arange(n)[:, None] < np.array([len(s) + 2 for s in segments])[None]).astype(np.float32)


def segments(word: bytes, size: int = SEGMENT) -> list[bytes]:
    """The word in pieces of at most ``size`` bytes (and a character at least), cut between characters."""
    out, at = [], 0
    while len(word) - at > size:
        end = at + size
        while end > at and word[end] & 0xC0 == 0x80:  # inside a character
            end -= 1
        out.append(word[at : end if end > at else at + size])
        at += len(out[-1])
    return [*out, word[at:]]


def train(samples: list[tuple[bytes, int]], classes: int, seed: int = 7) -> ByteGRU:
    """Adam over shuffled batches of (word, class); a long word trains in all its segments."""
    net, r = ByteGRU(classes, seed=seed), np.random.default_rng(seed)
    pieces = [(s, c) for w, c in samples for s in segments(w)]
    words = [s for s, _ in pieces]
    y = np.array([c for _, c in pieces])
    m1, m2, step = {k: 0.0 for k in net.p}, {k: 0.0 for k in net.p}, 0
    for epoch in range(EPOCHS):
        order = r.permutation(len(words))
        for i in range(0, len(order), BATCH):
            own = order[i : i + BATCH]
            _, g = net.gradients(*padded([words[j] for j in own]), y[own])
            step += 1
            rate = RATE * 0.5 ** epoch * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for k, v in g.items():
                m1[k] = 0.9 * m1[k] + 0.1 * v
                m2[k] = 0.999 * m2[k] + 0.001 * v * v
                net.p[k] -= (rate * m1[k] / (np.sqrt(m2[k]) + 1e-8)).astype(np.float32)
    return net


class Reader:
    """Pools position labels of whole texts, keeping the sums of the words it has read."""

    def __init__(self, value: dict):
        self.langs = value["langs"]
        if self.langs:
            self.net = ByteGRU(len(self.langs))
            self.net.p = value["params"]
        self.place: dict[bytes, int] = {}
        k = len(self.langs)
        self.sums = np.zeros((1024, 2 * k + 1), np.float32)  # log-probabilities, probabilities, positions

    def _learn(self, new: list[bytes]) -> None:
        need = len(self.place) + len(new)
        if need > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros((max(need, 2 * len(self.sums)) - len(self.sums), self.sums.shape[1]), np.float32)])
        new.sort(key=len)
        at = len(self.place)
        self.place.update(zip(new, range(at, need)))
        self.sums[at:need] = 0
        i = 0
        while i < len(new):
            n = 1
            while i + n < len(new) and n < 1024 and (n + 1) * (len(new[i + n]) + 2) <= POSITIONS:
                n += 1
            x, mask = padded(new[i : i + n])
            lp = self.net.log_probs(x, mask) * mask[:, :, None]
            pr = np.exp(lp) * mask[:, :, None]
            self.sums[at + i : at + i + n] = np.concatenate([lp.sum(0), pr.sum(0), mask.sum(0)[:, None]], axis=1)
            i += n

    def classify(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        k = len(self.langs)
        langs, scores = [], []
        for lo in range(0, len(texts), 64):  # few texts at a time, for the cache's bound
            part = [lower_words(t) if k and t and any(map(str.isalpha, t)) else None for t in texts[lo : lo + 64]]
            every = set().union(*(p for p in part if p))
            if len(self.place) + len(every) > CACHE_WORDS and len(self.place) + len(every - self.place.keys()) > CACHE_WORDS:
                self.place.clear()
            if new := list(every - self.place.keys()):
                self._learn(new)
            for p in part:
                if p is None:
                    langs.append(NONE)
                    scores.append(0.0)
                    continue
                s = self.sums.take(np.fromiter(map(self.place.__getitem__, p), np.int64, len(p)), axis=0).sum(0, dtype=np.float64)
                best = int(np.argmax(s[:k]))
                langs.append(self.langs[best])
                scores.append(float(min(1.0, s[k + best] / s[-1])))
        return langs, scores


def labels(net: ByteGRU, word: bytes) -> np.ndarray:
    """The most probable class of every byte of one word, its boundaries included."""
    return net.log_probs(*padded([word]))[:, 0].argmax(1)


def fit(docs: DataFrame, train_on: Column, seed: int = 7) -> dict:
    """Trains on about TRAIN_DOCS labelled rows a language, TRAIN_WORDS words each: {"params", "langs"}.

    Rows without a word or a language are no training rows. Without any, no
    language is learned. Languages are the distinct values of ``lang``; the sample
    follows a hash of id and text, so it does not depend on the partitions.
    """
    rows = docs.filter(train_on & F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(WORD), F.lit(False)))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return {"params": None, "langs": []}
    share = F.element_at(F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(TRAIN_DOCS / counts[k]))]), F.col("lang"))
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11) / float(1 << 53)
    found = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    some = rows.filter(drawn < share).select("lang", found.alias("w")).select("lang", F.filter("w", lambda w, i: F.pmod(F.xxhash64(w, i), F.size("w")) < TRAIN_WORDS).alias("w"))
    place = {k: i for i, k in enumerate(langs)}
    samples = sorted((w, place[r["lang"]]) for r in some.collect() for t in r["w"] for w in lower_words(t))
    return {"params": train(samples, len(langs), seed).p, "langs": langs} if samples else {"params": None, "langs": []}


def predict(docs: DataFrame, model: dict, carry: list[str] = ("doc_id",)) -> DataFrame:
    """``carry``, lang_pred and score for each row.

    ``und`` with score 0 where the text is NULL or has no letter, or where no
    language was learned. Only the text is read. The whole text counts, however
    long. Equal texts give equal results; other columns are ignored; an empty
    table gives an empty table. One scan, no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(dict(model))  # about 60 kB

    def start():
        reader = kept(sent, "reader", Reader)
        return lambda texts, *rest: (*rest, *reader.classify(texts))

    t = docs.select("text", *carry)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return map_lists(t, start, f"{schema}, lang_pred string, score double")


def _said(docs: DataFrame, model: dict, names: list[str]) -> DataFrame:
    """All columns of ``docs``, then the prediction and its score under ``names``; the text goes to Python once."""
    sent = docs.sparkSession.sparkContext.broadcast(dict(model))

    def start():
        reader = kept(sent, "reader", Reader)
        return lambda texts, *rest: (texts, *rest, *reader.classify(texts))

    others = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ["text", *others])
    return map_lists(docs.select("text", *[F.col(f"`{c}`") for c in others]), start, f"{schema}, {names[0]} string, {names[1]} double")


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from rows whose crc32(doc_id) mod ``folds`` is not 0, applied to all."""
    held = F.pmod(crc_of_id(), F.lit(folds)) == 0
    model = fit(docs, ~held)
    return predict(docs.withColumn("held_out", held), model, ["doc_id", "held_out"])


def with_language(docs: DataFrame, folds: int = 5, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that a language is found for: not ``und``, score of ``least`` or more; lang and other columns stay.

    NULL texts, texts without a letter and all rows of a table from which no language
    can be learned go. Repeated rows stay or go together, other columns may have any
    name, an empty table gives an empty table.
    """
    held = F.pmod(crc_of_id(), F.lit(folds)) == 0
    lang, score = fresh(docs.columns, "lang", "score")
    said = _said(docs, fit(docs, ~held), [lang, score])
    return said.filter((F.col(lang) != NONE) & (F.col(score) >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
