import random

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import joins
from sedimenta.operators.dedupe import keep_first, keep_valid_ids, reject_report
from sedimenta.operators.keys import surrogate_key
from tests.conftest import values


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows have one key, some have none, some find no partner."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = 1 if i % 3 == 0 else None if i % 17 == 0 else rng.randrange(2, 60)
        rows.append((i, key))
    left = spark.createDataFrame(rows, "i int, k int").repartition(8)
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 50)], "k int, v string")
    return left, right


def test_lookup_join_picks_by_size(skewed):
    left, right = skewed
    small = joins.lookup_join(left, right, ["k"])
    large = joins.lookup_join(left, right, ["k"], max_bytes=10)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert values(small) == values(large)
    with pytest.raises(ValueError):
        joins.lookup_join(left, right, ["k"], "full_outer")


def test_measured_bytes_grows_with_text(spark):
    short = spark.createDataFrame([("a",)] * 10, "s string")
    long = spark.createDataFrame([("a" * 1000,)] * 10, "s string")
    assert joins.measured_bytes(long) - joins.measured_bytes(short) == 9990
    vectors = spark.createDataFrame([([1.0] * 100,)], "v array<float>")
    assert joins.measured_bytes(vectors) > 400
    assert joins.measured_bytes(spark.createDataFrame([], "s string")) == 0


@pytest.mark.parametrize("partitions", [1, 5])
def test_surrogate_key_is_dense_and_ordered(spark, partitions):
    rows = [(i * 7 % 1009, f"n{i}") for i in range(1009)]
    df = spark.createDataFrame(rows, "k int, n string").repartition(5)
    out = surrogate_key(df, "sk", ["k"], partitions=partitions)
    assert values(out, "sk", "k") == sorted(((i + 1, i) for i in range(1009)), key=repr)


@pytest.mark.parametrize("partitions", [1, 5])
def test_surrogate_key_splits_a_hot_natural_key(spark, partitions):
    df = spark.range(0, 900, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("k"), "id"
    )
    out = surrogate_key(df, "sk", ["k"], partitions=partitions).collect()
    assert sorted(r["sk"] for r in out) == list(range(1, 901))
    by_sk = sorted((r["sk"], r["k"]) for r in out)
    assert [k for _, k in by_sk] == sorted(k for _, k in by_sk)


def test_surrogate_key_of_nothing(spark):
    empty = spark.createDataFrame([], "k int, n string")
    assert surrogate_key(empty, "sk", ["k"]).collect() == []
    assert surrogate_key(empty, "sk", ["k"]).collect() == []


def test_keep_first(spark):
    df = spark.createDataFrame(
        [(1, 2, "b"), (1, 1, "c"), (None, 5, "x"), (None, 4, "y"), (2, 1, "z"), (2, 1, "z")],
        "k int, o int, t string",
    )
    once = keep_first(df, ["k"], ["o"])
    assert values(once) == sorted([(1, 1, "c"), (None, 4, "y"), (2, 1, "z")], key=repr)
    assert values(keep_first(once, ["k"], ["o"])) == values(once)
    assert keep_first(df, None).count() == 5


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), "id")
    plan = keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_valid_ids_and_rejects(spark):
    df = spark.createDataFrame(
        [("12",), ("12",), ("0",), ("-1",), ("1.5",), ("abc",), (None,), ("7.0",)], "id string"
    )
    assert values(keep_valid_ids(df)) == [(12,), (12,), (7,)]
    report = dict(values(reject_report(df, "id", ["id"])))
    assert report == {"read": 8, "invalid_id": 5, "duplicate": 1, "kept": 2}
    assert report["read"] == report["invalid_id"] + report["duplicate"] + report["kept"]
