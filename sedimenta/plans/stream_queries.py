"""Incremental jobs: the batch result, reached file by file."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.plans.registry import SCHEMAS, query, table
from sedimenta.session import new_path
from sedimenta.streaming import incremental


def _landed(spark, sf):
    """The events as files of a landing folder. Some are delivered twice, and half of the clicks
    come with a copy that is far too late, in the same file and before the row itself."""
    path = new_path(spark, "landed")
    events = table(spark, sf, "events")
    events.where("event_type <> 'click'").repartition(4, "user_id").write.parquet(path)
    late = events.where("event_type = 'click' AND event_id % 2 = 0")
    late = late.withColumn("ts", F.col("ts") - F.expr("INTERVAL 400 DAYS")).withColumn("value", F.lit(-1.0))
    clicks = events.where("event_type = 'click'").unionByName(late)
    clicks.repartition(2, "event_id").sortWithinPartitions("ts").write.mode("append").parquet(path)
    events.where("event_type = 'view'").write.mode("append").parquet(path)
    return path, events.schema


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_ingest(spark, sf):
    """Two runs over a folder that grows in between; no file is read twice."""
    path, sink, mark = (new_path(spark, n) for n in ("landed", "sink", "mark"))
    events = table(spark, sf, "events")
    events.where("event_type = 'click'").write.parquet(path)
    stream = incremental.read_new_files(spark, path, events.schema, max_files=2)
    incremental.stream_ingest(stream, sink, mark)
    events.where("event_type <> 'click'").write.mode("append").parquet(path)
    incremental.stream_ingest(stream, sink, mark)
    done = spark.read.schema(SCHEMAS["events"]).parquet(sink)
    return done.select("event_id", "user_id", "event_type", "value")


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_dedupe(spark, sf):
    path, schema = _landed(spark, sf)
    stream = incremental.read_new_files(spark, path, schema, max_files=2)
    sink = new_path(spark, "sink")
    unique = incremental.stream_dedupe(stream, ["event_id"], "ts", "45 days")
    incremental.stream_ingest(unique, sink, new_path(spark, "mark"))
    return spark.read.schema(unique.schema).parquet(sink).select(
        "event_id", "user_id", "event_type", "value"
    )


@query("""
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def stream_upsert(spark, sf):
    """The newest event per user, upserted from two deliveries, the newer one first and then the
    older one, by appending; the table is compacted in between, and once more rows follow."""
    path, target, mark = (new_path(spark, n) for n in ("landed", "target", "mark"))
    events = table(spark, sf, "events").withColumn("idade", -F.col("event_id"))
    half = F.lit(events.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0])
    events.where(F.col("event_id") > half).write.parquet(path)
    stream = incremental.read_new_files(spark, path, events.schema)
    incremental.stream_upsert(stream, target, mark, "user_id", ["idade"])
    incremental.compact(spark, target, events.schema, "user_id", ["idade"])
    events.where(F.col("event_id") <= half).write.mode("append").parquet(path)
    incremental.stream_upsert(stream, target, mark, "user_id", ["idade"])
    now = incremental.read_upserted(spark, target, events.schema, "user_id", ["idade"])
    return now.select("user_id", "event_id", "event_type", "value")
