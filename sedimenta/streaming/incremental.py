"""Process what is new: ingest, dedupe and upsert as streams that run until they are up to date."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.operators.dedupe import keep_first
from sedimenta.session import file_system
from sedimenta.sources.landing import column
from sedimenta.sources.tables import read_table


def read_new_files(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Stream over the files of a folder; `max_files` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_ingest(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Append what is new and stop. The checkpoint remembers the files that are done, so a
    run after a failure neither loses nor repeats rows."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start(sink)
    )
    query.awaitTermination()


def stream_dedupe(stream: DataFrame, key: Sequence[str], at: str, delay: str) -> DataFrame:
    """First row per key among those that arrive within `delay` of each other.

    The delay bounds the state: a key is forgotten once the watermark has passed it. A
    timestamp without zone is taken as UTC, since a watermark needs an instant. Rows behind
    the watermark are dropped first, so a late row never hides a timely one of its key.
    """
    data_type = stream.schema[at].dataType
    if not isinstance(data_type, T.TimestampType):
        stream = stream.withColumn(at, column(at).cast("timestamp"))
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(key))


VERSION = "versao"  # microseconds: when a row was written; of equal rows the newest counts


def stream_upsert(stream: DataFrame, target: str, checkpoint: str, key: str, order: Sequence[str] = ()) -> None:
    """Upsert every micro-batch into a table by appending to it.

    A micro-batch writes its own rows, one per key, and reads nothing of the table. `read_upserted` gives the state,
    `compact` brings the table back to one row per key. Of several rows with one key the first by `order` counts,
    stored rows included, so the result does not depend on how files fall into micro-batches; of rows that are
    equal in `order`, the last one written. A batch that is run again after a failure ends in the same state. Versions
    are taken from the driver's clock: one stream at a time writes to a table.
    """
    last = 0

    def apply(batch: DataFrame, _: int) -> None:
        nonlocal last
        last = max(last + 1, time.time_ns() // 1000)
        newest = keep_first(batch, [key], order).withColumn(VERSION, F.lit(last).cast("bigint"))
        newest.write.mode("append").parquet(target)

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _versions(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    layout = T.StructType([*schema.fields, T.StructField(VERSION, T.LongType())])
    return read_table(spark, target, layout, optional=True)


def _newest(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    aged = rows.withColumn("__age", -F.col(VERSION))
    return keep_first(aged, [key], [*order, "__age"]).drop("__age")


def read_upserted(
    spark: SparkSession, target: str, schema: T.StructType, key: str, order: Sequence[str] = ()
) -> DataFrame:
    """The state of a table that `stream_upsert` writes: one row per key. A table that is not there yet is empty."""
    return _newest(_versions(spark, target, schema), key, order).drop(VERSION)


def compact(spark: SparkSession, target: str, schema: T.StructType, key: str, order: Sequence[str] = ()) -> int:
    """Write the state of the table next to its files, then delete the files it was made of; their number.

    The state does not change: rows that stand in old and new files at once count once, so an interruption at any
    point is mended by the next call, and files that a stream appends meanwhile stay. Queries that still read
    the old files fail and are to be repeated: compact when there are none.
    """
    rows = _versions(spark, target, schema)
    old = rows.inputFiles()
    if not old:
        return 0
    current = spark.read.schema(rows.schema).parquet(*old)
    _newest(current, key, order).write.mode("append").parquet(target)
    for name in old:
        files, path = file_system(spark, name)
        files.delete(path, False)
    return len(old)
