"""Language-model scores of whole texts: causal self-attention over subword symbols.

Texts are words and one end. Word counts of all training documents give the base
model. Subwords of a public vocabulary become symbols (all but the most frequent
share one), and a causal self-attention model is trained in numpy: it starts from a
few documents on the driver, then in each round every task trains on all windows of
all its training documents, and Spark averages the parameters. Texts are read once
into a table of symbols, from which all rounds and the scoring take overlapping
windows; each symbol is the target of one place. The score is
the probability of the text under the attention model alone; that under an equal
mixture of the two models over the whole text is a column of its own.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import attention as A
from .common import crc_of_id, lower_words, map_lists, map_tail, saved
from .vocab import kept

#: Words whose counts every task has at hand; the counts of all others are joined.
HOT_WORDS = 100_000
#: The driver's training, from which the tasks start: about so many documents, none of more code points, so many windows a pass.
FIRST_DOCS, FIRST_CHARS, FIRST_WINDOWS = 300, 20_000, 30_000
#: Rates of the passes over all windows of all training documents; Spark averages the parameters after each.
RATES = (0.01, 0.004)
#: Windows that a task gathers and shuffles before it trains on them.
HELD_WINDOWS = 8192
#: Distinct words that a task counts, or whose symbols a worker keeps, at a time.
HELD_WORDS = 500_000
#: Blocks of parameters that are averaged side by side.
BLOCKS = 64
#: Longer words are cut before subword encoding.
CUT = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def subword_encoder(ranks: dict[bytes, int], pattern: str):
    """words (bytes) -> their subword ids in a row, and how many each word has; each word is read as after a space."""
    import tiktoken

    encode = tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    begins = np.zeros(max(ranks.values()) + 1, bool)
    begins[[i for t, i in ranks.items() if t[:1] == b" "]] = True

    def one(w: str) -> list[int]:
        w = " " + w
        return encode(w) if len(w) <= CUT else [i for k in range(0, len(w), CUT) for i in encode(w[k : k + CUT])]

    def ids(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = b"\n".join(words).decode().split("\n") if words else []
        out, sizes = [], []
        for lo in range(0, len(texts), 512):
            part = texts[lo : lo + 512]
            if max(map(len, part)) < CUT:
                got = np.array(encode(" " + " ".join(part)), np.int64)
                at = np.flatnonzero(begins[got])
                if len(at) == len(part) and at[0] == 0:  # each space of the joined text begins a subword
                    out.append(got)
                    sizes.append(np.diff(np.r_[at, len(got)]))
                    continue
            each = [one(w) for w in part]
            out.append(np.array([i for w in each for i in w], np.int64))
            sizes.append(np.array([len(w) for w in each]))
        return (np.concatenate(out), np.concatenate(sizes)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    return ids


def word_counts(texts: DataFrame) -> DataFrame:
    """word, c over all ``texts`` (column text); the empty word stands for the ends. Counted in the tasks first."""
    def gather():
        seen = Counter()

        def flush():
            out = list(seen), list(seen.values())
            seen.clear()
            return out

        def step(batch):
            for lo in range(0, len(batch), 64):  # a small counter first: it stays in the processor's caches
                for w, k in Counter(chain.from_iterable(map(lower_words, batch[lo : lo + 64]))).items():
                    seen[w] += k
            seen[b""] += len(batch)
            return flush() if len(seen) > HELD_WORDS else None

        return step, lambda: flush() if seen else None

    return map_tail(texts.select("text"), gather, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _symbols(counts: DataFrame, sent) -> tuple[dict[int, int], float, dict[int, int]]:
    """Symbol of each frequent subword, the rare ones' total count, and all subwords' counts (a bounded vocabulary)."""
    def gather():
        enc = kept(sent, "encoder", lambda v: subword_encoder(v["ranks"], v["pattern"]))
        seen = np.zeros(max(sent.value["ranks"].values()) + 1, np.int64)

        def step(words, n):
            own = [(w, k) for w, k in zip(words, n) if w]
            if own:
                ids, size = enc([w for w, _ in own])
                np.add.at(seen, ids, np.repeat(np.array([k for _, k in own], np.int64), size))

        return step, lambda: (np.flatnonzero(seen).tolist(), seen[seen > 0].tolist())

    use = {r["id"]: r["n"] for r in map_tail(counts.select("word", "c"), gather, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}
    order = sorted(use, key=lambda i: (-use[i], i))
    symbol = {k: i + 3 for i, k in enumerate(order[: A.SYMBOLS - 3])}
    return symbol, float(sum(use[k] for k in order[A.SYMBOLS - 3 :])), use


class Places(dict):
    """word -> its place in ``names``; a new word gets the next one."""

    def __init__(self):
        self.names: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        return n


class Words:
    """What a worker keeps of words: their symbols, the base model's log10 where known, rare subwords' log10."""

    def __init__(self, value: dict):
        self.encode = subword_encoder(value["ranks"], value["pattern"])
        n = max(value["ranks"].values()) + 1
        self.symbol, self.rare = np.full(n, A.RARE, np.int16), np.full(n, -math.log10(value["rare"] + len(value["ranks"])))
        for i, c in value["use"].items():
            self.rare[i] += math.log10(c + 1)
        for i, x in value["symbol"].items():
            self.symbol[i], self.rare[i] = x, 0.0
        self.hot = value.get("hot", {})
        self.clear()

    def clear(self):
        self.place = Places()
        self.names = self.place.names
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.base, self.extra = np.zeros(1024), np.zeros(1024)
        self.flat = np.zeros(4096, np.int16)
        self.known = self.used = 0

    def _grown(self, name: str, n: int) -> np.ndarray:
        old = getattr(self, name)
        if n > len(old):
            new = np.zeros(max(n, 2 * len(old)), old.dtype)
            new[: len(old)] = old
            setattr(self, name, new)
        return getattr(self, name)

    def _learn(self) -> None:
        """Symbols and logarithms of the words that got a place since the last time."""
        at, n = self.known, len(self.names)
        if at == n:
            return
        new = self.names[at:]
        start, size, base, extra = (self._grown(k, n) for k in ("start", "size", "base", "extra"))
        ids, sizes = self.encode(new)
        end = np.cumsum(sizes)
        start[at:n], size[at:n] = end - sizes + self.used, sizes
        base[at:n] = [self.hot.get(w, math.nan) for w in new]
        extra[at:n] = np.add.reduceat(self.rare.take(ids), end - sizes)  # a word has one subword at least
        self._grown("flat", self.used + len(ids))[self.used : self.used + len(ids)] = self.symbol.take(ids)
        self.known, self.used = n, self.used + len(ids)

    def read(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Places of the words of all texts, the text of each, and each text's symbols in a row."""
        if len(self.names) > HELD_WORDS:
            self.clear()
        lens = np.array(list(map(len, texts)), np.int64)
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(texts)), np.int64, int(lens.sum()))
        self._learn()
        size = self.size.take(at)
        end = np.cumsum(size)
        row = self.flat.take(np.repeat(self.start.take(at) - end + size, size) + np.arange(end[-1] if len(end) else 0))
        return at, np.repeat(np.arange(len(texts)), lens), np.split(row, np.r_[0, end][np.cumsum(lens)][:-1])


def _few(chars: list[int]) -> int:
    """How many texts of so many code points to take at a time, for memory."""
    return max(1, min(64, int(2_000_000 // max(1, max(chars, default=1)))))


def _pack(p: dict) -> np.ndarray:
    return np.concatenate([p[k].reshape(-1) for k in sorted(p)])


def _unpack(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = np.asarray(flat[at : at + like[k].size], np.float32).reshape(like[k].shape)
        at += like[k].size
    return out


def _windows(rows: list[bytes]):
    return A.windows([np.frombuffer(r, np.int16) for r in rows])


def _train_everywhere(table: DataFrame, p: dict, rate: float) -> dict:
    """One pass of local training in every task over all windows of its rows (columns symbols, chars); the weighted mean of the results."""
    spark = table.sparkSession
    sent = spark.sparkContext.broadcast({"params": p})

    def gather():
        from pyspark import TaskContext

        own = {k: v.copy() for k, v in sent.value["params"].items()}
        opt, held, seen, r = A.Adam(own, rate), [], 0, np.random.default_rng(7)

        def train():
            nonlocal seen
            x, y = (np.concatenate(v) for v in zip(*held))
            held.clear()
            order = r.permutation(len(x))
            for i in range(0, len(x), 256):
                opt.rate = rate / math.sqrt(1 + opt.t / 100)
                opt.step(A.gradients(own, x[order[i : i + 256]], y[order[i : i + 256]])[1])
            seen += len(x)

        def step(batch, chars):
            for lo in range(0, len(batch), few := _few(chars)):
                held.append(_windows(batch[lo : lo + few])[:2])
                if sum(len(v[0]) for v in held) >= HELD_WINDOWS:
                    train()

        def end():
            if held:
                train()
            if not seen:
                return None
            parts = np.array_split(_pack(own) * np.float32(seen), BLOCKS)
            return list(range(BLOCKS)), [TaskContext.get().partitionId() % 32] * BLOCKS, [float(seen)] * BLOCKS, parts

        return step, end

    rows = map_tail(table.select("symbols", "chars"), gather, "block int, salt int, weight double, sums array<float>")

    def added(t: pa.Table) -> pa.Table:
        total = np.zeros(len(t.column("sums")[0].values))
        for v in t.column("sums"):
            total += v.values.to_numpy(zero_copy_only=False)
        return pa.table({"block": t.column("block")[:1], "salt": t.column("salt")[:1], "weight": [sum(t.column("weight").to_pylist())], "sums": [total.astype(np.float32)]}, schema=t.schema)

    for keys in (["block", "salt"], ["block"]):  # few rows of one task each, then few sums
        rows = rows.groupBy(*keys).applyInArrow(added, "block int, salt int, weight double, sums array<float>")
    got = sorted(rows.collect(), key=lambda r: r["block"])  # as many numbers as the model has
    return _unpack(np.concatenate([np.array(r["sums"]) / r["weight"] for r in got]), p) if got else p


def _first_training(texts: DataFrame, value: dict, total: int, seed: int) -> dict:
    p = A.start_parameters(seed)
    share = min(1.0, FIRST_DOCS / max(1, total))
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "text"), 11) / float(1 << 53) < share
    some = sorted(r["text"] for r in texts.filter(drawn & (F.length("text") <= FIRST_CHARS)).collect())
    words = Words(value)
    each = [lower_words(t) for t in some]
    if not each:
        return p
    x, y, _ = A.windows(words.read(each)[2])
    r = np.random.default_rng(seed)
    for rate in (0.02, 0.015, 0.01, 0.005):
        own = r.permutation(len(x))[:FIRST_WINDOWS]
        p = A.learn(p, x[own], y[own], rate)
    return p


def _read_once(docs: DataFrame, value: dict) -> DataFrame:
    """doc_id and b_train of each row with its symbols and what the base model needs of its words, as a table."""
    sent = docs.sparkSession.sparkContext.broadcast(value)

    def start():
        from pyspark import TaskContext

        words = kept(sent, "words", Words)
        end, end_known = sent.value["end"]
        row = TaskContext.get().partitionId() << 33

        def step(texts, *rest):
            nonlocal row
            out, chars = [], [len(t or "") for t in texts]
            for lo in range(0, len(texts), few := _few(chars)):
                each = list(map(lower_words, texts[lo : lo + few]))
                at, who, symbols = words.read(each)
                total = lambda v, w: np.bincount(w, weights=v, minlength=len(each))
                b = words.base.take(at)
                known = ~np.isnan(b)
                # the words without a count at hand, once a text
                span = len(words.names) + 1
                other, times = np.unique(who[~known] * span + at[~known], return_counts=True)
                cut = np.searchsorted(other // span, np.arange(len(each) + 1))
                names = list(map(words.names.__getitem__, (other % span).tolist()))
                times = times.tolist()
                out += zip(range(row, row + len(each)), [len(w) + 1 for w in each], (total(known, who).astype(int) + end_known).tolist(), (total(np.where(known, b, 0), who) + end).tolist(),
                           total(words.extra.take(at), who).tolist(), [s.tobytes() for s in symbols], [names[i:j] for i, j in zip(cut, cut[1:])], [times[i:j] for i, j in zip(cut, cut[1:])])
                row += len(each)
            cols = list(map(list, zip(*out))) if out else [[] for _ in range(8)]
            return *rest, chars, *cols

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return saved(map_lists(docs.select("text", "doc_id", "b_train"), start, f"doc_id {kind}, b_train boolean, chars int, row long, n_tokens long, known long, part double, rare double, symbols binary, others array<binary>, times array<int>"), "lm-symbols")


def _attention_scores(table: DataFrame, p: dict) -> DataFrame:
    """The rows of ``_read_once`` with the log10 probability of each under the model, as a table."""
    sent = table.sparkSession.sparkContext.broadcast({"params": p})

    def start():
        model = kept(sent, "scorer", lambda v: A.Scorer(v["params"]))

        def step(symbols, chars, rare, *rest):
            score = []
            for lo in range(0, len(symbols), few := _few(chars)):
                x, y, owner = _windows(symbols[lo : lo + few])
                lp = np.concatenate([model.log_probs(x[i : i + 2048], y[i : i + 2048]).sum(1, dtype=np.float64) for i in range(0, len(x), 2048)])
                score += (np.bincount(owner, weights=lp) / math.log(10)).tolist()
            return *rest, [a + b for a, b in zip(score, rare)]

        return step

    kind = table.schema["doc_id"].dataType.simpleString()
    return saved(map_lists(table.select("symbols", "chars", "rare", "row", "doc_id", "n_tokens", "known", "part"), start, f"row long, doc_id {kind}, n_tokens long, known long, part double, attention_score double"), "lm-first")


def score_texts(docs: DataFrame, train_on: Column, ranks_path: str, pattern: str, seed: int = 7) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, attention_score, mixture_score for each row of ``docs``.

    Tokens are the words with A-Z lower-cased, then one end. base_score is the sum
    of log10((c + 1) / (N + V + 1)); score, and attention_score, the attention model's
    log10 probability; mixture_score that of the equal mixture of both. NULL and empty texts are one end. Equal
    texts give equal rows; other columns are ignored; an empty table gives an empty
    table. Word counts and training cover all training rows. A task has the counts of
    HOT_WORDS words at hand; other words of a text are joined to the table of counts.
    """
    spark = docs.sparkSession
    base = docs.select("doc_id", "text", F.coalesce(train_on, F.lit(False)).alias("b_train"))
    training = base.filter("b_train").select("text")
    counts = saved(word_counts(training), "word-counts")
    total, kinds, ends = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max(F.when(F.length("word") == 0, F.col("c"))), F.lit(0))).first()
    below = math.log10(total + kinds + 1)
    value = {"ranks": read_ranks(ranks_path), "pattern": pattern}
    symbol, rare, use = _symbols(counts, spark.sparkContext.broadcast(dict(value)))
    value |= {"symbol": symbol, "rare": rare, "use": {k: n for k, n in use.items() if k not in symbol}}
    hot = {bytes(r["word"]): math.log10(r["c"] + 1) - below for r in counts.filter(F.length("word") > 0).orderBy(F.desc("c"), "word").limit(HOT_WORDS).collect()}
    table = _read_once(base, value | {"hot": hot, "end": (math.log10(ends + 1) - below, int(ends > 0))})
    p = _first_training(training, value, ends, seed)
    for rate in RATES:
        p = _train_everywhere(table.filter("b_train"), p, rate)
    first = _attention_scores(table, p)
    other = table.filter(F.size("others") > 0).select("row", F.inline(F.arrays_zip("others", "times"))).withColumnRenamed("others", "word")
    found = other.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * (F.log10(F.coalesce("c", F.lit(0)) + 1) - below)).alias("more"), F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"))
    t = first.join(found, "row", "left")
    base_score = F.col("part") + F.coalesce("more", F.lit(0.0))
    apart = F.abs(F.col("base_score") - F.col("attention_score"))
    return t.select("doc_id", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                    base_score.alias("base_score"), F.col("attention_score").alias("score"), "attention_score").withColumn(
        "mixture_score", F.greatest("base_score", "attention_score") + F.log10(1 + F.pow(F.lit(10.0), -apart)) - math.log10(2))


def score_documents(docs: DataFrame, ranks_path: str, pattern: str, folds: int = 7, held_fold: int = 2) -> DataFrame:
    """``score_texts`` learning from rows whose crc32(doc_id) mod ``folds`` is not ``held_fold``, with held_out."""
    held = F.pmod(crc_of_id(), F.lit(folds)) == held_fold
    t = score_texts(docs, ~held, ranks_path, pattern)
    return t.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "attention_score", "mixture_score")
