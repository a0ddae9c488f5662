"""Token counts by heap-and-linked-list byte-pair merging; no identifiers are made.

Each pre-token starts as one symbol per byte. A heap holds the ranks of adjacent
pairs, a linked list holds the symbols; the lowest rank is popped until no pair
of the list can merge. The count is the number of first symbols minus merges.
"""

from __future__ import annotations

import heapq
import re

import regex
from pyspark.sql import DataFrame, functions as F

from .common import map_lists
from .vocab import WORD_SPLIT, WS, Cache, byte_symbols, kept, load, lowered, special_pattern


def merged_count(symbols: list[str], rank: dict[tuple[str, str], int]) -> int:
    """Symbols left after all merges, lowest rank first, leftmost first among equals."""
    n = len(symbols)
    if n < 2:
        return n
    sym, left, right = list(symbols), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i) for i in range(n - 1) if (r := rank.get((sym[i], sym[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        r, i = heapq.heappop(heap)
        j = right[i]
        if sym[i] is None or j >= n or rank.get((sym[i], sym[j])) != r:
            continue  # one of the two has merged since
        sym[i] += sym[j]
        sym[j] = None
        merges += 1
        k = right[i] = right[j]
        if k < n:
            left[k] = i
            if (r := rank.get((sym[i], sym[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := left[i]) >= 0 and (r := rank.get((sym[h], sym[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return n - merges


def counter(voc: dict):
    """text -> number of tokens, for a vocabulary with word ends (lower case, white space dropped)."""
    rank = {m: i for i, m in enumerate(voc["merges"])}
    byte, end, special = byte_symbols(), voc["suffix"], special_pattern(voc["special"])
    split = regex.compile(WORD_SPLIT)
    odd = re.compile("[\x1c-\x1f]")  # str.split() takes these for white space, the tokenizer doesn't
    space = re.compile(f"[{WS}]+")

    def pre_token(p: str) -> int:
        s = [byte[b] for b in p.encode()]
        s[-1] += end
        return merged_count(s, rank)

    pre = Cache(pre_token)
    word = Cache(lambda w: sum(pre[p] for p in split.findall(w)))

    def count(text: str | None) -> int:
        if not text:
            return 0
        n = 0
        parts = special.split(text) if special and "<" in text else [text]
        n += len(parts) // 2
        for part in parts[::2]:
            part = lowered(part)
            n += sum(map(word.__getitem__, space.split(part) if odd.search(part) else part.split()))
        return n

    return count


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``.

    ``path``: a byte-level BPE file with word ends. NULL and empty texts have 0
    tokens. Equal rows give equal rows; other columns are ignored; an empty table
    gives an empty table. One scan, no shuffle; a worker keeps a bounded cache.
    """
    voc = docs.sparkSession.sparkContext.broadcast(load(path))  # a fixed file of about 2 MB

    def start():
        count = kept(voc, "counter", counter)
        return lambda ids, sizes, texts: (ids, sizes, list(map(count, texts)))

    t = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    out = map_lists(t, start, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
