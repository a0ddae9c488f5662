"""BPE encoding and decoding with a byte-level vocabulary.

Encoding: a priority queue of merge ranks over a doubly linked list of symbols;
entries whose symbols have merged since are skipped. Decoding: the vocabulary
strings of the ids are concatenated and their bytes read as UTF-8.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_lists
from .vocab import BYTE_SPLIT, WS, ByteCache, byte_symbols, kept, load, special_pattern


def merge_ids(ids: list[int], rank: list[dict[int, int]], made: list[int]) -> list[int]:
    """``rank``: by left id, right id -> rank; ``made``: id of the merged symbol by rank.

    Queue entries are rank * length + place, so equal ranks go from the left.
    """
    n = len(ids)
    if n < 2:
        return ids
    push, pop = heapq.heappush, heapq.heappop
    sym, prev, nxt = list(ids), list(range(-1, n - 1)), list(range(1, n + 1))
    queue = [x * n + i for i, (a, b) in enumerate(zip(ids, ids[1:])) if (x := rank[a].get(b)) is not None]
    heapq.heapify(queue)
    while queue:
        x, i = divmod(pop(queue), n)
        s, j = sym[i], nxt[i]
        if s < 0 or j >= n or rank[s].get(sym[j]) != x:
            continue  # one of the two has merged since
        s = sym[i] = made[x]
        sym[j] = -1
        nxt[i] = k = nxt[j]
        if k < n:
            prev[k] = i
            if (x := rank[s].get(sym[k])) is not None:
                push(queue, x * n + i)
        h = prev[i]
        if h >= 0 and (x := rank[sym[h]].get(s)) is not None:
            push(queue, x * n + h)
    return [s for s in sym if s >= 0]


_NOTHING = hashlib.sha256(b"").hexdigest()

#: Bytes of a worker's cache of encoded units: where only digests are made, and where the ids of a batch are held beside it.
DIGEST_BYTES, IDS_BYTES = 256 << 20, 32 << 20


class Codec:
    """Encodes and decodes whole texts.

    Units of a text (a word with the space before it) are cached, and of each only
    its ids as 32-bit integers: one small object beside the word. Decimals and
    vocabulary strings of all ids of a text come from tables.
    """

    most = DIGEST_BYTES

    def __init__(self, voc: dict):
        vocab, byte = voc["vocab"], byte_symbols()
        nothing: dict[int, int] = {}
        self.rank = [nothing] * (max(vocab.values()) + 1)
        for i, (a, b) in enumerate(voc["merges"]):
            if self.rank[vocab[a]] is nothing:
                self.rank[vocab[a]] = {}
            self.rank[vocab[a]][vocab[b]] = i
        self.made = [vocab[a + b] for a, b in voc["merges"]]
        self.first = [vocab[c] for c in byte]
        self.special = voc["special"]
        self.find_special = special_pattern(self.special)
        back = {c: b for b, c in enumerate(byte)}
        string = {i: bytes(back[c] for c in s) for s, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        own = [string.get(i, b"") for i in range(max(string) + 1)]
        self.size = np.array(list(map(len, own)), np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.strings = np.frombuffer(b"".join(own), np.uint8)
        self.decimals = np.array([b"%d," % i for i in range(len(own))], "S8").view(np.int64)  # padded with zero bytes
        self.split = regex.compile(BYTE_SPLIT)
        self.units = re.compile(f" ?[^{WS}]+|[{WS}]+(?![^{WS}])|[{WS}]+")
        self.packed = ByteCache(self._packed, self.most)

    def _packed(self, unit: str) -> bytes:
        pieces = self.split.findall(unit)
        if len(pieces) > 1:
            return b"".join(map(self.packed.__getitem__, pieces))
        return array("i", merge_ids(list(map(self.first.__getitem__, unit.encode())), self.rank, self.made)).tobytes()

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if self.find_special is None or not self.find_special.search(text):
            return np.frombuffer(b"".join(map(self.packed.__getitem__, self.units.findall(text))), np.int32)
        out = []
        for k, part in enumerate(self.find_special.split(text)):
            out += [np.int32(self.special[part]).tobytes()] if k % 2 else map(self.packed.__getitem__, self.units.findall(part))
        return np.frombuffer(b"".join(out), np.int32)

    def encode(self, text: str | None) -> list[int]:
        return self.ids(text).tolist()

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The vocabulary strings of the ids in a row, read as UTF-8."""
        ids = np.asarray(ids, np.int32)
        size = self.size.take(ids)
        end = np.cumsum(size)
        at = np.repeat(self.start.take(ids) - end + size, size)
        at += np.arange(len(at))
        return self.strings.take(at).tobytes().decode("utf-8", "replace")

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the comma-joined ids, SHA-256 of the decoded text."""
        ids = self.ids(text)
        if not len(ids):
            return 0, _NOTHING, _NOTHING
        decimals = self.decimals.take(ids).tobytes().translate(None, b"\0")[:-1]
        return len(ids), hashlib.sha256(decimals).hexdigest(), hashlib.sha256(self.decode(ids).encode()).hexdigest()


class Encoder(Codec):
    """With the smaller cache."""

    most = IDS_BYTES


def _apply(docs: DataFrame, path: str, kind: type[Codec], make: Callable[[Codec], Callable], columns: str, carry: list[str]) -> DataFrame:
    voc = docs.sparkSession.sparkContext.broadcast(load(path))  # a fixed file of about 2 MB

    def start():
        one = make(kept(voc, kind.__name__, kind))
        for k in ("vocab", "merges"):  # the codec has its own tables
            voc.value.pop(k, None)
        return lambda texts, *rest: (*rest, *(map(list, zip(*map(one, texts))) if texts else [[] for _ in columns.split(",")]))

    own = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return map_lists(docs.select("text", *carry), start, f"{own}, {columns}")


def encode(docs: DataFrame, path: str, carry: list[str] = ("doc_id",)) -> DataFrame:
    """``carry``, ids (array of int), n_tokens and round_trip (the ids decode to the text) for each row.

    NULL and empty texts have no ids and decode to the empty text. Equal rows give
    equal rows, other columns are ignored, an empty table gives an empty table.
    One scan, no shuffle.
    """
    def make(codec):
        def one(text):
            ids = codec.ids(text)
            return ids, len(ids), codec.decode(ids) == (text or "")
        return one

    return _apply(docs, path, Encoder, make, "ids array<int>, n_tokens long, round_trip boolean", list(carry))


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of what ``encode`` gives, made in the same pass."""
    return _apply(docs, path, Codec, lambda codec: codec.digests, "n_tokens long, ids_sha256 string, decoded_sha256 string", ["doc_id"])
