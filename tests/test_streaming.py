from lodestone.streaming import events


def test_streams(spark, tmp_path):
    rows = [(1, "a", f"2024-01-{d:02d} 10:00:00", 1.0) for d in (1, 10, 20, 28)] + [(2, "b", "2024-01-05 00:00:00", 2.0)]
    spark.createDataFrame(rows, "user_id long, event_type string, ts string, value double").selectExpr("user_id", "event_type", "CAST(ts AS TIMESTAMP) ts", "value").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("user_id long, event_type string, ts timestamp, value double").parquet(str(tmp_path / "in"))
    for name, df, mode in (("clusters", events.clustered(stream), "append"), ("counts", events.windowed_counts(stream), "update")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    assert sorted((r.user_id, r.ts.day, r.cluster) for r in spark.table("clusters").collect()) == [(1, 1, 1), (1, 10, 1), (1, 20, 2), (1, 28, 2), (2, 5, 1)]
    assert spark.table("counts").count() == 5
