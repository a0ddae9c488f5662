"""Reads a byte-pair vocabulary file and prepares texts as its tokenizer does."""

from __future__ import annotations

import gc
import json
import re
import unicodedata

#: Fixed values of the tokenizers: Unicode white space, and the patterns that split a text before merging.
WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + WS + r"\p{L}\p{N}]+"
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WS + r"\p{L}\p{N}]+|[" + WS + "]+(?![^" + WS + "])|[" + WS + "]+"

#: Entries of each of a cache's two generations, so a worker's memory is bounded.
CACHE = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else 256 and up in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return [other.get(b, chr(b)) for b in range(256)]


def load(path: str) -> dict:
    """What the operators need of a tokenizer file: vocabulary, merges in order, special tokens."""
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    return {
        "vocab": j["model"]["vocab"],
        "merges": [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in j["model"]["merges"]],
        "special": {t["content"]: t["id"] for t in j["added_tokens"]},
        "suffix": j["model"].get("end_of_word_suffix") or "",
    }


def special_pattern(special: dict[str, int]) -> re.Pattern | None:
    return re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None


def lowered(text: str) -> str:
    """NFC, then lower case letter by letter (no rule for a final sigma)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


class Cache(dict):
    """word -> result, computed on first use.

    A full generation becomes the old one, from which what is still used is taken
    back; long words aren't kept.
    """

    def __init__(self, make, most: int = CACHE):
        super().__init__()
        self.make, self.old, self.most = make, {}, most

    def __missing__(self, word):
        out = self.old.get(word)
        if out is None:
            out = self.make(word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[word] = out
        return out


class ByteCache(dict):
    """word -> bytes, computed on first use; as ``Cache``, with a bound on the bytes of both generations together."""

    #: What an entry takes beside the word and its bytes: two object heads, a dictionary slot.
    ENTRY = 200

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.old, self.most, self.size = make, {}, most // 2, 0

    def __missing__(self, word):
        out = self.old.get(word)
        if out is None:
            out = self.make(word)
        if len(word) <= 64:
            size = self.ENTRY + 4 * len(word) + len(out)
            if self.size + size > self.most:
                self.old, self.size = dict(self), 0
                self.clear()
            self.size += size
            self[word] = out
        return out


def kept(broadcast, name: str, make):
    """``make(value)``, kept beside the broadcast value: a reused worker goes on with its cache.

    Spark has taken the values that this task doesn't use from the worker by then;
    what they held (models and caches refer to themselves) is collected first.
    """
    value = broadcast.value
    if name not in value:
        gc.collect()
        value[name] = make(value)
    return value[name]
