import datetime

from folioforge.streaming import incremental


def at(minute):
    return datetime.datetime(2024, 1, 1, 0, minute)


def drain(df, name, tmp_path, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name).collect()


def test_windowed_counts(spark, tmp_path):
    rows = [(at(1), "click"), (at(2), "click"), (at(7), "view"), (at(40), "view")]
    spark.createDataFrame(rows, "ts timestamp, event_type string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, event_type string").parquet(f"{tmp_path}/in")
    got = {(r["window"]["start"].minute, r["event_type"]): r["n"] for r in drain(incremental.windowed_counts(stream), "windowed", tmp_path)}
    assert got[0, "click"] == 2 and got[5, "view"] == 1


def test_carry_stream(spark, tmp_path):
    schema = "volume string, ts timestamp, surname string"
    for k, rows in enumerate([[("v", at(1), "Ek"), ("v", at(2), None), ("w", at(1), None)], [("v", at(3), None), ("v", at(4), "Berg"), ("w", at(5), "Holm")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = {(r["volume"], r["ts"].minute): r["surname"] for r in drain(incremental.carry_stream(stream), "carried", tmp_path)}
    assert got == {("v", 1): "Ek", ("v", 2): "Ek", ("w", 1): "", ("v", 3): "Ek", ("v", 4): "Berg", ("w", 5): "Holm"}
