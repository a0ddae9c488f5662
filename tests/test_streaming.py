"""The stateless operators apply unchanged to a streaming DataFrame."""

from fixture_data import F5, PLAYER_SCHEMA, players, teams
from pitchside.operators import matrix as M


def test_club_scores_on_a_stream(spark, tmp_path):
    src = str(tmp_path / "players")
    players(spark).select(*PLAYER_SCHEMA.names).write.parquet(src)
    stream = spark.readStream.schema(PLAYER_SCHEMA).parquet(src)
    scored = M.club_scores(stream, teams(spark), "X", F5, "ALL")
    q = (scored.writeStream.format("memory").queryName("scored_stream").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    try:
        q.processAllAvailable()
        got = {(r.ID, round(r.score, 6)) for r in spark.sql("SELECT * FROM scored_stream").collect()}
    finally:
        q.stop()
    batch = {(r.ID, round(r.score, 6)) for r in M.club_scores(players(spark), teams(spark), "X", F5, "ALL").collect()}
    assert got == batch and len(got) == 6
