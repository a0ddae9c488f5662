"""CSV sources: columns by header name, explicit or inferred types, renames, blanks, quoting, bad fields."""

import pytest
from pyspark.sql import types as T

from pitchside.session import materialize
from pitchside.sources import csv as CSV


SCHEMA = T.StructType([
    T.StructField("ID", T.LongType()), T.StructField("Name", T.StringType()), T.StructField("Club", T.StringType()),
    T.StructField("Height(cm)", T.IntegerType()), T.StructField("International.Reputation", T.IntegerType()),
    T.StructField("Crossing", T.DoubleType()),
])
SMALL = T.StructType([T.StructField("ID", T.LongType()), T.StructField("Name", T.StringType()), T.StructField("Height_cm", T.IntegerType())])


def _write(tmp_path, text, name="players.csv"):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_read_renames_dotted_headers(spark, tmp_path):
    path = _write(tmp_path, "ID,Name,Club,Height(cm),International.Reputation,Crossing\n1,A,X,180,3,55\n")
    df = CSV.read_players(spark, path, SCHEMA)
    assert df.columns == ["ID", "Name", "Club", "Height_cm", "International_Reputation", "Crossing"]
    assert df.collect()[0].Crossing == 55.0


def test_blank_fields(spark, tmp_path):
    path = _write(tmp_path, "ID,Name,Club,Height(cm),International.Reputation,Crossing\n1,A,,180,3,55\n2,B,Y,,1,\n")
    df = CSV.read_players(spark, path, SCHEMA).orderBy("ID")
    rows = df.collect()
    assert rows[0].Club is None and rows[1].Height_cm is None and rows[1].Crossing is None
    filled = CSV.blanks_as_empty(df).orderBy("ID").collect()
    assert filled[0].Club == "" and filled[1].Height_cm is None


def test_failfast_on_bad_number(spark, tmp_path):
    path = _write(tmp_path, "ID,Name,Club,Height(cm),International.Reputation,Crossing\n1,A,X,18x,3,55\n")
    with pytest.raises(Exception):
        CSV.read_players(spark, path, SCHEMA).collect()


def test_columns_go_by_name_not_position(spark, tmp_path):
    path = _write(tmp_path, "Height(cm),ID,Name\n180,1,A\n")
    assert CSV.read_players(spark, path, SMALL).collect() == [(1, "A", 180)]
    assert CSV.read_strict(spark, path, SMALL).collect() == [(1, "A", 180)]


def test_missing_or_unknown_columns_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="missing"):
        CSV.read_players(spark, _write(tmp_path, "ID,Name\n1,A\n"), SMALL)
    more = _write(tmp_path, "ID,Name,Height(cm),Wage\n1,A,180,5\n", "more.csv")
    with pytest.raises(ValueError, match="unknown"):
        CSV.read_players(spark, more, SMALL)
    assert CSV.read_players(spark, more, SMALL, extra="text").collect() == [(1, "A", 180, "5")]


def test_permuted_part_file_fails(spark, tmp_path):
    d = tmp_path / "parts"
    d.mkdir()
    (d / "a.csv").write_text("ID,Name,Height(cm)\n1,A,180\n")
    (d / "b.csv").write_text("Height(cm),Name,ID\n170,B,2\n")
    with pytest.raises(Exception):
        CSV.read_players(spark, str(d), SMALL).collect()


def test_strict_records(spark, tmp_path):
    path = _write(tmp_path, 'ID,Name,Height(cm)\n1,"Smith, J",180\nx,B,170\n3,C\n4,D,175,9\n5,E,\n')
    assert sorted(CSV.read_strict(spark, path, SMALL).collect()) == [(1, "Smith, J", 180), (5, "E", None)]
    assert tuple(CSV.count_malformed(spark, path, SMALL).first()) == (5, 3)
    # the source's rule counts commas inside quotes too
    assert sorted(CSV.read_strict(spark, path, SMALL, quoted=False).collect()) == [(5, "E", None)]
    assert tuple(CSV.count_malformed(spark, path, SMALL, quoted=False).first()) == (5, 3)


def test_inferred_types(spark, tmp_path):
    df = CSV.read_players(spark, _write(tmp_path, "ID,Name,Height(cm)\n1,A,180\n2,B,181\n"), schema=None)
    assert df.columns == ["ID", "Name", "Height_cm"] and dict(df.dtypes)["Height_cm"] == "int"


def test_materialize_never_reads_a_failed_write(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "t")
    bad = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    schema = spark.range(1).schema
    with pytest.raises(Exception):
        materialize(bad, path, schema=schema)
    assert materialize(spark.range(5), path, schema=schema).count() == 5
