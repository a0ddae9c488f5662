"""Line deduplication by range-partitioned line hashes and keep bitmaps, in built-in functions only.

Lines with a long enough key become rows of two 64-bit hashes, the document and the
place of the line. They are range-partitioned by the hashes and sorted by document
and place behind them; windows stream over that order and mark the occurrences
outside the last document of each frequent key. What goes back to the documents is
not text but one bitmap a document: words of 64 lines, with a bit for each line that
stays; words of which all lines stay are left out.

A hash range can't split one key. So keys that hold more than a small share of all
lines are found first by frequent-item sketches, of bounded size; the number of
their documents and the last of them come from partial aggregates, and their lines
are marked by a join with that bounded table, without a shuffle of them by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import saved

#: What is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key is frequent with more than 1 / SHARE of all lines (and HOT_LEAST lines). The sketches are
#: BUCKETS groups of TRACKED items, of which TOP are looked at: at most BUCKETS * TOP frequent hashes.
SHARE, HOT_LEAST, BUCKETS, TRACKED, TOP = 4096, 1000, 64, 1024, 128


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case (other letters stay)."""
    k = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(k) == F.char_length(k), F.lower(k)).otherwise(F.translate(k, UPPER, LOWER))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row(text: str = "text") -> Column:
    return F.xxhash64(F.col(text).isNull(), text)


def line_table(docs: DataFrame, least_chars: int) -> DataFrame:
    """(h1, h2, doc_id, t, pos): the lines whose key has ``least_chars`` code points or more; t tells rows of one id apart."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row().alias("t"), "text")
    lines = d.filter(F.char_length("text") >= least_chars).select("doc_id", "t", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    keyed = lines.filter(F.char_length("line") >= least_chars).select("doc_id", "t", "pos", line_key(F.col("line")).alias("key"))
    keyed = keyed.filter(F.char_length("key") >= least_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(11), "key").alias("h2"), "doc_id", "t", "pos")


def hot_hashes(lines: DataFrame, share: int = SHARE, least: int = HOT_LEAST) -> DataFrame:
    """(h1) of the keys with a large share of all lines: at most BUCKETS * TOP rows."""
    some = lines.groupBy(F.pmod("h1", F.lit(BUCKETS)).alias("b")).agg(F.expr(f"approx_top_k(h1, {TOP}, {TRACKED})").alias("top"))
    total = lines.agg(F.count(F.lit(1))).scalar()
    return some.select(F.explode("top").alias("x")).filter((F.col("x.count") * share > total) & (F.col("x.count") > least)).select(F.col("x.item").alias("h1"))


def _cold_drops(lines: DataFrame, least_docs: int) -> DataFrame:
    """Streams each key's lines from its last document to its first."""
    dealt = lines.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", F.desc_nulls_last("doc_id"), "pos")
    key = Window.partitionBy("h1", "h2")
    rank = F.dense_rank().over(key.orderBy(F.desc_nulls_last("doc_id")))
    ranked = dealt.select("h1", "h2", "doc_id", "t", "pos", rank.alias("r"))
    return ranked.select("doc_id", "t", "pos", "r", F.max("r").over(key).alias("docs")).filter((F.col("r") > 1) & (F.col("docs") >= least_docs)).select("doc_id", "t", "pos")


def _hot_drops(lines: DataFrame, least_docs: int) -> DataFrame:
    """Documents are counted by partial aggregates; the facts of the few keys are joined back."""
    by_doc = lines.select("h1", "h2", "doc_id").distinct()
    facts = by_doc.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last")).filter(F.col("docs") >= least_docs)
    return lines.join(F.broadcast(facts.select("h1", "h2", "last")), ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("last"))).select("doc_id", "t", "pos")


def keep_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, share: int = SHARE, hot_least: int = HOT_LEAST) -> DataFrame:
    """(doc_id, t, n_dropped, words): a row for each row of ``docs`` that loses a line.

    ``words`` is the compressed bitmap: (word, bits) by word, where bit i of word w
    tells whether line 64 w + i stays; words of ones only are left out. ``t`` is a
    hash of the text.
    """
    lines = saved(line_table(docs, least_chars), "lines")
    hot = saved(hot_hashes(lines, share, hot_least), "hot-lines").distinct()
    cold = lines.join(F.broadcast(hot), "h1", "left_anti")
    warm = lines.join(F.broadcast(hot), "h1", "left_semi")
    drops = _cold_drops(cold, least_docs).unionByName(_hot_drops(warm, least_docs))
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = drops.groupBy("doc_id", "t", F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("gone"))
    return words.groupBy("doc_id", "t").agg(
        F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"), F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("words"))


def _opened(words: Column) -> Column:
    """The bits of every word up to the last one written, in order: absent words are ones."""
    gap = lambda x, i: x["word"] - F.when(i > 0, F.get(words, i - 1)["word"]).otherwise(F.lit(-1)) - 1
    return F.flatten(F.transform(words, lambda x, i: F.concat(F.array_repeat(F.lit(-1).cast("long"), gap(x, i)), F.array(x["bits"]))))


def _with_lines(docs: DataFrame, carry: list[str], least_chars: int, least_docs: int, share: int, hot_least: int) -> tuple[DataFrame, Column, Column]:
    """``carry`` as the struct ``row`` beside n_dropped; columns for all lines and for the kept ones."""
    maps = keep_bitmaps(docs, least_chars, least_docs, share, hot_least)
    maps = maps.select(F.col("doc_id").alias("m_id"), F.col("t").alias("m_t"), F.col("n_dropped").alias("m_dropped"), _opened(F.col("words")).alias("m_bits"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col("doc_id").cast("long").alias("d_id"), _row().alias("d_t"), F.col("text").alias("d_text"))
    t = keyed.join(maps, F.col("d_id").eqNullSafe(F.col("m_id")) & (F.col("d_t") == F.col("m_t")), "left")
    lines = split_lines(F.col("d_text"))
    word = lambda i: F.get(F.col("m_bits"), F.floor(i / 64).cast("int"))
    stays = lambda _, i: F.coalesce(F.getbit(word(i), F.pmod(i, F.lit(64))) == 1, F.lit(True))
    return t, lines, F.when(F.col("m_bits").isNull(), lines).otherwise(F.filter(lines, stays))


def deduplicated(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, share: int = SHARE, hot_least: int = HOT_LEAST) -> DataFrame:
    """The rows of ``docs`` with the text of the lines that stay; n_chars, if there, is that of the new text. NULL texts stay NULL."""
    t, _, kept = _with_lines(docs, docs.columns, least_chars, least_docs, share, hot_least)
    new = t.select("row", F.when(F.col("m_bits").isNull(), F.col("d_text")).otherwise(F.array_join(kept, "\n")).alias("new"))
    n_chars = F.when(F.col("new").isNotNull(), F.char_length("new"))
    own = lambda c: F.col("new") if c == "text" else n_chars.cast(docs.schema[c].dataType) if c == "n_chars" else F.col(f"row.`{c}`")
    return new.select(*[own(c).alias(c) for c in docs.columns])


def line_report(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, share: int = SHARE, hot_least: int = HOT_LEAST) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 (of the kept lines, joined by newlines) for each row of ``docs``.

    Lines whose key has ``least_chars`` code points and stands in ``least_docs``
    documents go, except in the largest doc_id that holds it, where all of them stay.
    A document is a doc_id: rows that share one count once, NULL ids are one document,
    smaller than all others. NULL and empty texts are one empty line. Repeated rows
    give equal rows, other columns are ignored, an empty table gives an empty table.
    """
    t, lines, kept = _with_lines(docs, ["doc_id"], least_chars, least_docs, share, hot_least)
    return t.select(F.col("row.doc_id").alias("doc_id"), F.size(lines).cast("long").alias("n_lines"), F.coalesce("m_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                    F.sha2(F.when(F.col("m_bits").isNull(), F.coalesce("d_text", F.lit(""))).otherwise(F.array_join(kept, "\n")), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents
), keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
    SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.last AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
