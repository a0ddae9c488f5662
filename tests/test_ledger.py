"""The ledger of rejected CSV records."""

from collections import Counter

from pyspark.sql import types as T

from pitchside.sources import csv as CSV

SCHEMA = T.StructType([T.StructField("ID", T.LongType()), T.StructField("Name", T.StringType()),
                       T.StructField("Overall", T.IntegerType()), T.StructField("Crossing", T.DoubleType())])
GOOD = ['1,Ann,70,1.5', '2,"Lee, Jo",,', '3,,71,2', '4,"say ""hi""",5,0.25']
BAD = {'x,Bo,70,1': {("ID", "cast")}, '5,Cy,7.5,z': {("Overall", "cast"), ("Crossing", "cast")}, '6,Di,70': {(None, "width")}, '7,Ed,70,1,9': {(None, "width")},
       'nine': {(None, "width")}, '8,"Flo,70,1': {(None, "quote")}, 'y,"Gus, Jr.",,1': {("ID", "cast")}}


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_reasons_by_record(spark, tmp_path):
    path = tmp_path / "in"
    write(path, "a.csv", ["ID,Name,Overall,Crossing", *GOOD, *BAD])
    write(path, "b.csv", ["ID,Name,Overall,Crossing", *list(BAD)[:2], "", '10,"a break', 'inside",70,1'])
    got = CSV.reject_ledger(spark, str(path), SCHEMA).collect()
    assert Counter((r.file, r.record, r.column, r.reason) for r in got) == Counter(
        [("a.csv", t, *e) for t, es in BAD.items() for e in es] + [("b.csv", t, *e) for t in list(BAD)[:2] for e in BAD[t]]
        + [("b.csv", '10,"a break', None, "quote"), ("b.csv", 'inside",70,1', None, "quote")])
    total = CSV.count_malformed(spark, str(path), SCHEMA).first()
    assert total.malformed == len({(r.file, r.record) for r in got}) == total.rows - len(GOOD)
    # whatever columns a query names, the same records stay
    strict = CSV.read_strict(spark, str(path), SCHEMA)
    assert strict.count() == len(GOOD)
    assert {r.ID for r in strict.select("ID").collect()} == {1, 2, 3, 4} and strict.select("Name").count() == len(GOOD)


def test_counts_and_clean_file(spark, tmp_path):
    path = tmp_path / "in"
    write(path, "a.csv", ["Overall,ID,Crossing,Name", "q,1,2,n", "r,2,s,n", "3,3,3,n"])   # columns by name
    counts = CSV.reject_counts(CSV.reject_ledger(spark, str(path), SCHEMA))
    assert {tuple(r) for r in counts.collect()} == {("Overall", "cast", 2), ("Crossing", "cast", 1)}
    clean = tmp_path / "clean"
    write(clean, "a.csv", ["ID,Name,Overall,Crossing", *GOOD])
    assert CSV.reject_ledger(spark, str(clean), SCHEMA).count() == 0
