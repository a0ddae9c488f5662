"""Multipart credential linking over built-in expressions.

One scan finds the strong secrets (three patterns) and the parts of credentials
that mean little alone: account names, unlabelled key-like strings, short labelled
values and endpoints. An interval join within scopes of SCOPE code points then
reports a weak part only where a complementary part stands near.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import row_key, saved

#: Code points between two parts at most.
SCOPE = 200

#: kind -> (pattern, group whose length counts, least length). Strong kinds in the order of ties.
STRONG: dict[str, tuple[str, int, int]] = {
    "assign": ("(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 8),
    "access": ("AKIA[A-Z0-9]+", 0, 16),
    "hex": ("[0-9a-f]{32,}", 0, 32),
}

_KEYLIKE = "A-Za-z0-9+/_="

#: kind -> (pattern, role). Ids and secrets complement each other, endpoints complement secrets.
WEAK: dict[str, tuple[str, str]] = {
    "account": ("(?<![A-Za-z0-9_])(?i:user(?:name|_id)?|login|client_?id|account|key_?id)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9@._-]{3,}", "id"),
    "keylike": (f"(?<![{_KEYLIKE}])(?=[A-Za-z+/_=]*+[0-9])(?=[0-9+/_=]*+[A-Za-z])[{_KEYLIKE}]{{20,}}", "secret"),
    "short": ("(?<![A-Za-z0-9_])(?i:password|passwd|pwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]{4,7}(?![A-Za-z0-9+/_.=-])", "secret"),
    "endpoint": ("(?i:https?|ftps?|ssh|jdbc:[a-z]{1,20}|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\\x20\\x09-\\x0D\"'<>]+", "endpoint"),
}

#: What every match of a kind contains: cheap to look for, so that few texts meet the full pattern.
HINT: dict[str, list[str]] = {
    "assign": [":", "="], "access": ["AKIA"], "account": [":", "="], "short": [":", "="], "endpoint": ["://"],
    "keylike": list("0123456789"),
}

#: role -> roles that complement it. A strong access identifier counts as an id, the other strong kinds as secrets.
COMPLEMENT = {"id": ["secret"], "secret": ["id", "endpoint"], "endpoint": ["secret"]}

_KINDS = [*STRONG, *WEAK]
_ROLE = {"access": "id", "assign": "secret", "hex": "secret"} | {k: r for k, (_, r) in WEAK.items()}
_SPAN = "struct<start:int,rank:int,end:int>"


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches as structs (start, rank of the kind, end), in code points.

    The text between matches (split) and the matches themselves give the positions.
    """
    found = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x)).alias("len"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.length(x)).alias("counted"))
    found = F.filter(found, lambda x: x["len"].isNotNull())
    walked = F.aggregate(
        found,
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.when(x["counted"] >= least, F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["gap"]).alias("start"), F.lit(_KINDS.index(kind)).alias("rank"), (acc["at"] + x["gap"] + x["len"]).alias("end")))))
            .otherwise(acc["out"]).alias("out")))
    possible = reduce(Column.__or__, [text.contains(x) for x in HINT[kind]]) & text.rlike(pattern) if kind in HINT else text.rlike(pattern)
    return F.when(possible, walked["out"]).otherwise(F.array().cast(f"array<{_SPAN}>"))


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, key of the row, strong and weak spans (arrays of start, rank, end). One projection over the scan."""
    text = F.col("b_text")
    t = docs.select("doc_id", *row_key(), F.coalesce("text", F.lit("")).alias("b_text"))
    return t.select(
        "doc_id", "k_id", "k_text",
        F.array_sort(F.concat(*[_spans(text, k, *STRONG[k]) for k in STRONG])).alias("strong"),
        F.array_sort(F.concat(*[_spans(text, k, WEAK[k][0], 0, 1) for k in WEAK])).alias("weak"))


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """k_id, k_text, linked: weak spans outside strong ones that have a complementary part within the scope.

    Equi-join on the row's key and the buckets of ``scope`` code points that a part
    covers, as a semi-join, so no pairs are made and a text with very many parts is split by its buckets.
    """
    role = F.element_at(F.create_map(*[x for i, k in enumerate(_KINDS) for x in (F.lit(i), F.lit(_ROLE[k]))]), F.col("s.rank"))
    free = F.filter("weak", lambda w: ~F.exists("strong", lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))
    every = found.filter(F.size("weak") > 0).select("k_id", "k_text", "strong", free.alias("weak")).filter(F.size("weak") > 0)
    own = lambda c: every.select("k_id", "k_text", F.explode(c).alias("s")).select("k_id", "k_text", "s", role.alias("role"))
    weak = own(F.col("weak")).distinct().withColumn("bucket", F.explode(F.sequence(F.floor(F.col("s.start") / scope), F.floor(F.col("s.end") / scope))))
    near = own(F.concat("strong", "weak")).select(
        F.col("k_id").alias("c_id"), F.col("k_text").alias("c_text"), F.col("s.start").alias("c_start"), F.col("s.end").alias("c_end"),
        F.explode(F.element_at(F.create_map(*[x for r, c in COMPLEMENT.items() for x in (F.lit(r), F.array(*map(F.lit, [k for k in COMPLEMENT if r in COMPLEMENT[k]])))]), F.col("role"))).alias("c_for"))
    near = near.withColumn("c_bucket", F.explode(F.sequence(F.floor(F.col("c_start") / scope) - 1, F.floor(F.col("c_end") / scope) + 1)))
    hit = weak.join(
        near,
        F.col("k_id").eqNullSafe(F.col("c_id")) & (F.col("k_text") == F.col("c_text")) & (F.col("role") == F.col("c_for")) & (F.col("bucket") == F.col("c_bucket"))
        & (F.col("c_start") - F.col("s.end") <= scope) & (F.col("s.start") - F.col("c_end") <= scope),
        "left_semi")
    return hit.groupBy("k_id", "k_text").agg(F.array_sort(F.collect_set("s")).alias("linked"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, _KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked for each row.

    ``spans`` has kind:start:end of all spans by start, then kind. NULL and empty
    texts have none. Equal rows give equal rows, rows that share an id only are
    told apart by their text; other columns are ignored; an empty table gives an
    empty table. The texts are read once and never shuffled.
    """
    found = saved(parts(docs), "secret-parts")
    more = linked(found, scope).select(F.col("k_id").alias("r_id"), F.col("k_text").alias("r_text"), "linked")
    t = found.drop("weak").join(more, F.col("k_id").eqNullSafe(F.col("r_id")) & (F.col("k_text") == F.col("r_text")), "left")
    count = lambda k: F.size(F.filter("strong", lambda s: s["rank"] == _KINDS.index(k))).cast("long")
    added = F.coalesce("linked", F.array().cast(f"array<{_SPAN}>"))
    return t.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in STRONG],
        F.sha2(_joined(F.col("strong")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("strong", added))).alias("spans"),
        F.size(added).cast("long").alias("n_linked"))
