"""Rule bitmask ledger: every rule is evaluated once, policies are bit masks over the failures.

``ledger`` measures each text and stores one bit per failed rule. ``verdicts``
applies a version of the policy to the stored bits, and ``ablation`` counts, by
bitwise aggregation over the ledger alone, what each rule decides in a policy.
Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE, WORD

#: name, condition that fails it (over the measurements). A rule's bit is its place here: append only.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "n_symbols > n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("no_letters", "2 * n_alpha_words < n_words"),
]

BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: version -> the rules that reject a document. "base" is the contract's.
POLICIES: dict[str, list[str]] = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "symbols", "repeated_lines"],
    "v2": [name for name, _ in RULES],
}

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_alpha_words"]


def policy_mask(version: str) -> int:
    return sum(BIT[name] for name in POLICIES[version])


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows (hashes, in order) that stand twice or more in the array."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda s, a, b: F.get(s, a)["h"] == F.get(s, b)["h"]
    found = F.transform(F.array(placed), lambda s: F.sort_array(F.transform(
        F.filter(s, lambda x, i: F.coalesce((F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), (F.get(s, i - 1)["h"] == x["h"]), (F.get(s, i + 1)["h"] == x["h"]), F.lit(False))),
        lambda x: x["i"])))
    covered = F.transform(found, lambda p: F.aggregate(
        F.transform(p, lambda at, i: F.coalesce(F.least(F.get(p, i + 1) - at, F.lit(3)), F.lit(3))), F.lit(0), lambda a, b: a + b))
    return F.get(covered, F.lit(0))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and failed (long): bit i is set if rule i fails.

    One projection over the scan, no shuffle. NULL and empty texts have no words:
    every measurement is 0. Equal rows give equal rows; other columns are ignored.
    """
    t = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("b_text"))
    t = t.select("doc_id", "b_text", F.regexp_extract_all("b_text", F.lit(WORD), F.lit(0)).alias("b_words"))
    hashes = F.transform("b_words", lambda w: F.xxhash64(w))
    t = t.withColumn("b_hash", hashes)
    n = F.size("b_words")
    t = t.withColumn("b_windows", F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("b_hash", i), F.get("b_hash", i + 1), F.get("b_hash", i + 2))))
        .otherwise(F.array().cast("array<bigint>")))
    lines = F.filter(F.split("b_text", "\n"), lambda x: x.rlike(WORD))
    t = t.withColumn("b_lines", lines)
    repeats = F.when(F.size(F.array_distinct("b_windows")) == F.size("b_windows"), F.lit(0)).otherwise(_repeat_words(F.col("b_windows")))
    t = t.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        (F.length("b_text") - F.regexp_count("b_text", F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("b_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("b_lines") - F.size(F.array_distinct("b_lines"))).cast("long").alias("n_dup_lines"),
        repeats.cast("long").alias("n_repeat_words"),
        F.size("b_lines").cast("long").alias("n_lines"),
        F.regexp_count("b_text", F.lit("[^\\x20\\x09-\\x0D\\p{L}]*+\\p{L}[^\\x20\\x09-\\x0D]*+")).cast("long").alias("n_alpha_words"),
    )
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return t.withColumn("failed", bits)


def verdicts(led: DataFrame, version: str = "v2") -> DataFrame:
    """Adds base_failed and kept (false if a rule of the base or of the version fails)."""
    hit = lambda v: F.col("failed").bitwiseAND(F.lit(policy_mask(v))) != 0
    return led.withColumn("base_failed", hit("base")).withColumn("kept", ~(hit("base") | hit(version)))


def ablation(led: DataFrame) -> DataFrame:
    """version, rule, failed, rejected, alone: per policy and rule, documents that fail the rule, those that the
    policy rejects, and those that it would keep without the rule.

    The ledger is first counted by failure mask (at most 2 ** rules rows, combined before the shuffle).
    """
    masks = led.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    plans = F.array(*[F.struct(F.lit(v).alias("version"), F.lit(policy_mask(v)).cast("long").alias("mask"), F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                      for v, rules in POLICIES.items() for r in rules])
    m = masks.select("failed", "n", F.inline(plans))
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    both = F.col("failed").bitwiseAND(F.col("mask"))
    return m.groupBy("version", "rule").agg(
        count(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        count(both != 0).alias("rejected"),
        count(both == F.col("bit")).alias("alone"))


#: The same rows in DuckDB.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS win
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, win) AS c FROM g) WHERE c >= 2),
n AS (SELECT doc_id, count(*) AS n_repeat_words FROM (SELECT DISTINCT doc_id, unnest([p, p + 1, p + 2]) AS q FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT s) AS n_dup_lines
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS s FROM d) WHERE regexp_matches(s, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
             len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) AS n_alpha_words
      FROM d LEFT JOIN n USING (doc_id) LEFT JOIN l USING (doc_id)),
f AS (SELECT *, {" + ".join(f"CASE WHEN {c} THEN {1 << i} ELSE 0 END" for i, (_, c) in enumerate(RULES))} AS bits FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (bits & {policy_mask("base")}) <> 0 AS base_failed, (bits & {policy_mask("v2")}) = 0 AS kept, CAST(bits AS BIGINT) AS failed
FROM f
"""
