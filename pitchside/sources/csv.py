"""CSV readers for the player and team files.

Columns are found by the file's header names, never by position. Types come from
an explicit schema (no inference pass over the data) or, when asked for, from
Spark's inference. Source headers with '.', '(' or ')' are renamed so columns
need no back-ticks.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schema import PLAYER_SCHEMA, RENAMES

CORRUPT = "_corrupt_record"


def rename_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns})


def _file_schema(spark: SparkSession, path: str, schema: T.StructType, header: bool, extra: str) -> T.StructType:
    """The schema in the file's own column order and names, types by (renamed) name.

    Only the header line is read. A missing column raises; a column that the
    schema lacks raises too, or is read as text with ``extra="text"``.
    """
    if not header:
        return schema
    names = spark.read.option("header", True).csv(path).columns
    types = {RENAMES.get(f.name, f.name): f.dataType for f in schema.fields}
    found = [RENAMES.get(n, n) for n in names]
    missing = [n for n in types if n not in found]
    unknown = [n for n in found if n not in types]
    if missing or len(set(found)) != len(found) or (unknown and extra != "text"):
        raise ValueError(f"header of {path}: missing columns {missing}, unknown {unknown if extra != 'text' else []}, in all {len(found)}")
    return T.StructType([T.StructField(n, types.get(f, T.StringType())) for n, f in zip(names, found)])


def _ordered(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Renamed, the schema's columns first and in its order."""
    df = rename_columns(df)
    first = [RENAMES.get(f.name, f.name) for f in schema.fields]
    return df.select(*first, *[c for c in df.columns if c not in first])


def read_players(spark: SparkSession, path: str, schema: T.StructType | None = PLAYER_SCHEMA,
                 header: bool = True, extra: str = "error") -> DataFrame:
    """Header CSV; a blank field becomes NULL, a field that its type can't hold fails.

    Columns are matched by name, whatever their order, and every file's header is
    held against the first one's (``enforceSchema`` off), so a permuted part file
    fails instead of being misread. ``schema=None`` infers the types from the data.
    """
    reader = spark.read.option("header", header).option("mode", "FAILFAST")
    if schema is None:
        return rename_columns(reader.option("inferSchema", True).csv(path))
    own = _file_schema(spark, path, schema, header, extra)
    return _ordered(reader.option("enforceSchema", not header).schema(own).csv(path), schema)


def blanks_as_empty(df: DataFrame) -> DataFrame:
    """Missing strings as '' (a reader that keeps blank fields as text)."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill("", subset=strings)


def _permissive(spark: SparkSession, path: str, schema: T.StructType, header: bool, extra: str) -> DataFrame:
    """Every data record with its text in ``_corrupt_record`` if its width or a field is wrong."""
    own = _file_schema(spark, path, schema, header, extra).add(CORRUPT, T.StringType())
    return (spark.read.schema(own).option("header", header).option("mode", "PERMISSIVE").option("columnPruning", False)
            .option("enforceSchema", True).option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def _rejected(df: DataFrame) -> Column:
    """Whether the record is corrupt.

    Spark prunes a scan to the columns that a query names and casts only those, so a bad field
    elsewhere would pass: every typed column takes part here, in a test that never holds.
    """
    typed = [f.name for f in df.schema.fields if f.name != CORRUPT and not isinstance(f.dataType, T.StringType)] or [df.columns[0]]
    nulls = reduce(add, [F.col(f"`{c}`").isNull().cast("int") for c in typed])
    return F.col(CORRUPT).isNotNull() | (nulls < 0)


def _lines(spark: SparkSession, path: str, header: bool) -> DataFrame:
    """The non-empty lines without the files' header lines (equal to the first line of the first file)."""
    lines = spark.read.text(path).where(F.length("value") > 0)
    first = spark.read.text(path).first() if header else None
    return lines if first is None else lines.where(F.col("value") != F.lit(first["value"]))


def read_strict(spark: SparkSession, path: str, schema: T.StructType = PLAYER_SCHEMA,
                header: bool = True, quoted: bool = True, extra: str = "error") -> DataFrame:
    """Only records with as many fields as the header has and no field that its type can't hold.

    ``quoted=False`` counts every comma, also inside quotes (the strict-width rule
    of the source), and drops further records by that.
    """
    if quoted:
        df = _permissive(spark, path, schema, header, extra)
        return _ordered(df.where(~_rejected(df)).drop(CORRUPT), schema)
    own = _file_schema(spark, path, schema, header, extra)
    kept = _lines(spark, path, header).where(F.size(F.split(F.col("value"), ",", -1)) == len(own.fields))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*own.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = kept.select(F.from_csv(F.col("value"), ddl, {"columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    return _ordered(parsed.select("r.*").where(F.col(CORRUPT).isNull()).drop(CORRUPT), schema)


def count_malformed(spark: SparkSession, path: str, schema: T.StructType = PLAYER_SCHEMA,
                    header: bool = True, quoted: bool = True, extra: str = "error") -> DataFrame:
    """(rows, malformed): data records, and those that ``read_strict`` leaves out."""
    if not quoted:
        own = _file_schema(spark, path, schema, header, extra)
        width = F.size(F.split(F.col("value"), ",", -1))
        return _lines(spark, path, header).agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(width != len(own.fields), F.lit(1))).alias("malformed"))
    df = _permissive(spark, path, schema, header, extra)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(_rejected(df), F.lit(1))).alias("malformed"))


def reject_ledger(spark: SparkSession, path: str, schema: T.StructType = PLAYER_SCHEMA,
                  header: bool = True, extra: str = "error") -> DataFrame:
    """(file, column, reason, record): why ``read_strict`` leaves a record out, a row for each failing field.

    Reasons: ``quote`` (a quote is not closed, as in a record cut by a line break
    inside quotes), ``width`` (fewer or more fields than the header), each with a NULL
    column; ``cast`` (the column's type can't hold its field). The reader tokenises
    every record once; only those it rejects are split again as text, to tell a field
    that failed from one that is blank. No rejects give an empty table.
    """
    df = _permissive(spark, path, schema, header, extra)
    names = [c for c in df.columns if c != CORRUPT]
    typed = {c: f"t{i}" for i, c in enumerate(names)}
    bad = df.select(F.col("_metadata.file_name").alias("file"), F.col(CORRUPT).alias("record"), *[F.col(f"`{c}`").alias(t) for c, t in typed.items()]).where(F.col("record").isNotNull())
    texts = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(len(names))] + [T.StructField("wrong", T.StringType())])
    bad = bad.withColumn("x", F.from_csv("record", texts.simpleString()[len("struct<"):-1].replace(":", " "), {"columnNameOfCorruptRecord": "wrong"}))
    entry = lambda column, reason: F.struct(F.lit(column).cast("string").alias("column"), F.lit(reason).alias("reason"))
    casts = F.array_compact(F.array(*[F.when(F.col(f"x.f{i}").isNotNull() & F.col(t).isNull(), entry(RENAMES.get(c, c), "cast")) for i, (c, t) in enumerate(typed.items())]))
    quotes = F.length("record") - F.length(F.replace("record", F.lit('"'), F.lit("")))
    why = F.when(quotes % 2 == 1, F.array(entry(None, "quote"))).when(F.col("x.wrong").isNotNull(), F.array(entry(None, "width"))).otherwise(casts)
    return bad.select("file", F.explode(why).alias("e"), "record").select("file", "e.column", "e.reason", "record")


def reject_counts(ledger: DataFrame) -> DataFrame:
    """(column, reason, fields) of a ledger; counts of several files or days add up."""
    return ledger.groupBy("column", "reason").agg(F.count(F.lit(1)).alias("fields"))


def write_players(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
