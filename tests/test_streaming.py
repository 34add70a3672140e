"""Streams of files: the same rows as a batch, repeats dropped within the watermark."""

from pyspark.sql import functions as F

from caseloom.streaming import arrivals

SCHEMA = "user_id long, event_type string, ts timestamp"


def run(stream, name, mode, folder):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{folder}/{name}").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return stream.sparkSession.table(name)


def test_streams(spark, tmp_path):
    rows = spark.range(300).select((F.col("id") % 40).alias("user_id"), F.concat(F.lit("t"), F.col("id") % 3).alias("event_type"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).alias("ts"))
    rows.repartition(6).write.parquet(f"{tmp_path}/in")
    stream = arrivals.file_stream(spark, f"{tmp_path}/in", rows.schema, 2)
    got = run(arrivals.counts_per_window(stream, "ts", "event_type"), "windows", "complete", tmp_path)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, arrivals.counts_per_window(rows, "ts", "event_type").collect()))
    seen = run(arrivals.first_arrivals(stream, "user_id", "ts").select("user_id"), "first", "append", tmp_path)
    assert sorted(r.user_id for r in seen.collect()) == list(range(40))
