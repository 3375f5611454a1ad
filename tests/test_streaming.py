import datetime as dt

from pyspark.sql import functions as F

from sedimenta.operators.dedupe import keep_first
from sedimenta.streaming import incremental
from tests.conftest import values

SCHEMA = "id long, ts timestamp_ntz, v int"


def deliver(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder + "/in")


def at(day):
    return dt.datetime(2024, 1, day)


def test_ingest_resumes(spark, folder):
    deliver(spark, folder, [(1, at(1), 10)])
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = incremental.read_new_files(spark, folder + "/in", schema)
    for rows in ([], [(2, at(2), 20)], []):
        if rows:
            deliver(spark, folder, rows)
        incremental.stream_ingest(stream, folder + "/out", folder + "/mark")
    assert values(spark.read.parquet(folder + "/out"), "id", "v") == [(1, 10), (2, 20)]


def test_dedupe_equals_the_batch(spark, folder):
    rows = [(i, at(1 + i % 20), i) for i in range(50)]
    deliver(spark, folder, rows[:30])
    deliver(spark, folder, rows[20:])
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = incremental.read_new_files(spark, folder + "/in", schema, max_files=1)
    unique = incremental.stream_dedupe(stream, ["id"], "ts", "30 days")
    incremental.stream_ingest(unique, folder + "/out", folder + "/mark")
    batch = keep_first(spark.read.schema(schema).parquet(folder + "/in"), ["id"])
    assert values(spark.read.parquet(folder + "/out"), "id", "v") == values(batch, "id", "v")


def test_upsert_equals_the_batch_and_appends_only_its_rows(spark, folder):
    deliver(spark, folder, [(i, at(1), 10) for i in range(40)])
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = incremental.read_new_files(spark, folder + "/in", schema)
    out, mark = folder + "/out", folder + "/mark"
    assert incremental.read_upserted(spark, out, schema, "id").count() == 0
    incremental.stream_upsert(stream, out, mark, "id", ["v"])

    def state():
        return incremental.read_upserted(spark, out, schema, "id", ["v"])

    def files():
        return set(spark.read.parquet(out).inputFiles())

    before = files()
    deliver(spark, folder, [(3, at(2), 2), (3, at(2), 9), (4, at(2), 11), (5, at(2), 10), (100, at(2), 5)])
    incremental.stream_upsert(stream, out, mark, "id", ["v"])
    got = dict(values(state(), "id", "v"))
    assert got == {**{i: 10 for i in range(40)}, 3: 2, 100: 5}
    stored = {r.id: r.ts for r in state().collect()}
    assert stored[5] == at(2) and stored[4] == at(1)  # equal in order: the new row; behind: the stored one
    assert before < files() and spark.read.parquet(out).count() == 44, "a micro-batch writes its own rows"
    # the same deliveries under a new checkpoint are applied again: no value changes
    want = values(state(), "id", "v")
    incremental.stream_upsert(stream, out, folder + "/mark2", "id", ["v"])
    assert values(state(), "id", "v") == want
    want = values(state())
    assert incremental.compact(spark, out, schema, "id", ["v"]) > len(before)
    assert values(state()) == want and spark.read.parquet(out).count() == 41
    # rows behind what was compacted stay behind
    deliver(spark, folder, [(3, at(3), 7), (6, at(3), 10)])
    incremental.stream_upsert(stream, out, mark, "id", ["v"])
    stored = {r.id: (r.ts, r.v) for r in state().collect()}
    assert stored[3][1] == 2 and stored[6] == (at(3), 10)


def test_an_interrupted_compaction_changes_nothing(spark, folder, monkeypatch):
    schema = spark.createDataFrame([], SCHEMA).schema
    for day in (1, 2):
        deliver(spark, folder, [(i, at(day), 10 - day) for i in range(day, 30)])
        stream = incremental.read_new_files(spark, folder + "/in", schema)
        incremental.stream_upsert(stream, folder + "/out", folder + "/mark", "id")
    want = values(incremental.read_upserted(spark, folder + "/out", schema, "id"))

    def stopped(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, "file_system", stopped)
        try:
            incremental.compact(spark, folder + "/out", schema, "id")
        except RuntimeError:
            pass
    assert values(incremental.read_upserted(spark, folder + "/out", schema, "id")) == want
    incremental.compact(spark, folder + "/out", schema, "id")
    assert values(incremental.read_upserted(spark, folder + "/out", schema, "id")) == want
    assert spark.read.parquet(folder + "/out").count() == 29


def test_a_late_row_does_not_hide_a_timely_one(spark, folder):
    deliver(spark, folder, [(1, at(10), 1)])
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = incremental.read_new_files(spark, folder + "/in", schema, max_files=1)
    unique = incremental.stream_dedupe(stream, ["id"], "ts", "1 day")
    incremental.stream_ingest(unique, folder + "/out", folder + "/mark")
    deliver(spark, folder, [(2, at(1), 2), (2, at(11), 3), (3, at(11), 4)])
    incremental.stream_ingest(unique, folder + "/out", folder + "/mark")
    assert values(spark.read.parquet(folder + "/out"), "id", "v") == [(1, 1), (2, 3), (3, 4)]
