"""The golden micro-fixture (FIXTURES.md section 3): six players, three clubs, five features."""

from pyspark.sql import types as T

F5 = ["f1", "f2", "f3", "f4", "f5"]

PLAYER_ROWS = [
    (1, "A. One", "X", "CB", 50.0, 40.0, 30.0, 20.0, 10.0),
    (2, "B. Two", "X", "CM", 10.0, 20.0, 30.0, 40.0, 50.0),
    (3, "C. Three", "Y", "ST", 60.0, 60.0, 60.0, 60.0, 60.0),
    (4, "D. Four", "Y", "GK", 20.0, 20.0, 20.0, 20.0, 20.0),
    (5, "C. Three", "Z", "LB", 70.0, 50.0, 30.0, 10.0, 90.0),
    (6, "E. Six", None, "RW", 80.0, 80.0, 80.0, 80.0, 80.0),
]
TEAM_ROWS = [
    ("X", 5.0, 1.0, 3.0, 2.0, 9.0),
    ("Y", 2.0, 4.0, 5.0, 10.0, 20.0),
    ("Z", 10.0, 10.0, 10.0, 10.0, 0.0),
]

PLAYER_SCHEMA = T.StructType(
    [T.StructField("ID", T.LongType()), T.StructField("Name", T.StringType()),
     T.StructField("Club", T.StringType()), T.StructField("Position", T.StringType())]
    + [T.StructField(f, T.DoubleType()) for f in F5]
)
TEAM_SCHEMA = T.StructType([T.StructField("Club", T.StringType())] + [T.StructField(f, T.DoubleType()) for f in F5])


def players(spark):
    df = spark.createDataFrame(PLAYER_ROWS, PLAYER_SCHEMA)
    # Extra card columns some operators project.
    from pyspark.sql import functions as F
    return df.select("*", F.lit(25).alias("Age"), F.lit("N").alias("Nationality"),
                     F.lit(170).alias("Height_cm"), F.lit(150).alias("Weight_lbs"))


def teams(spark):
    return spark.createDataFrame(TEAM_ROWS, TEAM_SCHEMA)
