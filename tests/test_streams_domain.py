import datetime as dt

from pyspark.sql import functions as F

from lakelayer.plans.streams import (FLOWS, gold_batch, gold_stream, gold_target, silver_passthrough, silver_tracks,
                                     silver_users, star_report)
from lakelayer.streaming.cdc_flow import read_target
from lakelayer.streaming.ingest import file_stream
from paths import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def test_silver_transforms(spark):
    users = spark.createDataFrame([(1, "ann", T0, None), (1, "ann b", T0, None), (2, "bo", T0, "{}")],
                                  "user_id long, user_name string, updated_at timestamp_ntz, _rescued_data string")
    u = silver_users(users).collect()
    assert sorted(r.user_id for r in u) == [1, 2] and all(r.user_name == r.user_name.upper() for r in u)
    assert "_rescued_data" not in silver_users(users).columns
    tracks = spark.createDataFrame([(1, "a-b-c", 149, T0), (2, "x", None, T0)],
                                   "track_id long, track_name string, duration_sec int, updated_at timestamp_ntz")
    t = {r.track_id: r for r in silver_tracks(tracks).collect()}
    assert t[1].track_name == "a b c" and t[1].durationFlag == "low" and t[2].durationFlag == "high"
    assert silver_passthrough(tracks).columns == tracks.columns


def test_gold_flows_stream_equals_batch(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    users = ev.selectExpr("CASE WHEN event_id % 9 = 0 THEN NULL ELSE user_id END AS user_id",
                          "upper(event_type) AS user_name", "ts AS updated_at")
    facts = ev.selectExpr("event_id AS stream_id", "user_id", "user_id AS track_id",
                          "cast(value AS int) AS listen_duration", "ts AS stream_timestamp")
    for flow, df in ((FLOWS[0], users), (FLOWS[3], facts)):
        src, ck, root = scratch("src"), scratch("ck"), scratch("gold")
        df.repartition(3).write.parquet(src)
        gold_stream(flow, file_stream(spark, src, schema=df.schema, max_files_per_trigger=1), root, ck)
        got = sorted(tuple(r) for r in read_target(spark, gold_target(flow, root)).collect())
        want = sorted(tuple(r) for r in gold_batch(flow, df).collect())
        assert got == want and len(got) > 0
    report = star_report(spark, {"factstream": gold_batch(FLOWS[3], facts),
                                 "dimuser": gold_batch(FLOWS[0], users).filter(F.col("__END_AT").isNull()),
                                 "dimtrack": spark.createDataFrame([(1, "t")], "track_id long, track_name string")})
    assert report.count() == facts.count()
    assert report.columns == ["stream_id", "listen_duration", "user_id", "user_name", "track_id", "track_name"]
