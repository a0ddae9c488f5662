"""Helpers shared by the operators: Arrow batch mapping, words, work tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pitchside.session import ensure_checkpoint_dir

#: Rows of a batch that goes to Python: bounds a worker's memory with long texts.
BATCH_ROWS = 512

#: The separators of words, as in ``[^\x20\x09-\x0D]+``; ``bytes.split()`` uses the same six.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]"

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; none for NULL."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """The words with A-Z lower-cased (other letters stay)."""
    return text.encode().translate(_LOWER).split() if text else []


def map_lists(df: DataFrame, start: Callable[[], Callable[..., tuple]], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` over plain lists.

    ``start`` runs once a task and returns a function that takes one list per
    column of ``df`` and returns one list per column of ``schema``.
    """
    spark = df.sparkSession
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for b in batches:
            out = step(*(c.to_pylist() for c in b.columns))
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def map_tail(df: DataFrame, start: Callable[[], tuple[Callable, Callable]], schema: T.StructType | str) -> DataFrame:
    """As ``map_lists`` for steps that gather over many batches.

    ``start`` returns (step, end): step may return None; end gives what is left.
    """
    spark = df.sparkSession
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, end = start()
        make = lambda out: pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, arrow)], schema=arrow)
        for b in batches:
            if (out := step(*(c.to_pylist() for c in b.columns))) is not None:
                yield make(out)
        if (out := end()) is not None:
            yield make(out)

    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    """Whole texts can be long: no batch with more than BATCH_ROWS rows goes to Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a new Parquet table in the shared checkpoint folder and read it back.

    This cuts the lineage: a lost executor costs a re-read of files only.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_parts(df: DataFrame) -> DataFrame:
    """``df`` in fewer partitions, for larger files; for plans that don't ask a task for its partition.

    On a local or mounted folder Hadoop starts a process of its own for the rights of
    each file and folder that a task makes. So a task takes several partitions, one
    after the other: two tasks a core, or one for 16 shuffle partitions if that is more.
    """
    spark = df.sparkSession
    return df.coalesce(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16))


def saved_few(df: DataFrame, name: str) -> DataFrame:
    """As ``saved``, in fewer files."""
    return saved(few_parts(df), name)


def fresh(names: list[str], *wanted: str) -> list[str]:
    """Column names that none of ``names`` has (Spark's names are alike in either case): the wanted ones behind a prefix."""
    taken, prefix = {n.lower() for n in names}, "z"
    while any(n.startswith(prefix) for n in taken):
        prefix += "z"
    return [f"{prefix}_{w}" for w in wanted]


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """A key for joining results back to rows: equal rows share it, rows that share an id only don't."""
    return [F.col(doc_id).alias("k_id"), F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull()).alias("k_text")]


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's decimal text; 0's crc for NULL ids is that of the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
