import datetime as dt

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import quality, star
from sedimenta.operators.report import Window, digest, html_card, ranked, top_of_window
from sedimenta.spec import DimRef, DimSpec, FactSpec
from tests.conftest import values

DIM = DimSpec(
    "dim_body",
    key="sk_body",
    natural="id_body",
    columns={"id_body": "id", "sg_body": "code", "nm_body": "name", "dt_body": "day", "nr_score": "score"},
    codes=frozenset({"sg_body"}),
    members={"nr_score": (0.0, 0.5)},
)
FACT = FactSpec(
    "ft",
    dims=(
        DimRef("dim_body", "body", "id_body", "sk_body"),
        DimRef("dim_event", "event", "id_event", "sk_event", optional=True),
    ),
    dates={"sk_data": "day"},
    columns={"tp": "kind"},
    constants={"qtd": 1},
)


@pytest.fixture(scope="module")
def bodies(spark):
    day = dt.date(2024, 1, 5)
    rows = [(20, "B", "Bee", day, 0.1), (10, "A", "Ay", day, 0.2), (10, "A", "Ay", day, 0.2)]
    return spark.createDataFrame(rows, "id long, code string, name string, day date, score double")


@pytest.fixture(scope="module")
def events(spark):
    spec = DimSpec("dim_event", "sk_event", "id_event", {"id_event": "id", "nm": "name"})
    return star.build_dim(spark.createDataFrame([(5, "x")], "id long, name string"), spec)


def test_build_dim(spark, bodies):
    unknown = dt.date(9999, 12, 31)
    assert values(star.build_dim(bodies, DIM)) == sorted(
        [
            (-1, -1, "N/I", "NÃO INFORMADO", unknown, 0.0),
            (-3, -3, "N/A", "NÃO SE APLICA", unknown, 0.5),
            (1, 10, "A", "Ay", dt.date(2024, 1, 5), 0.2),
            (2, 20, "B", "Bee", dt.date(2024, 1, 5), 0.1),
        ],
        key=repr,
    )


def votes(spark):
    rows = [
        (10, 5, dt.date(2024, 1, 5), "Sim"),
        (-1, 99, dt.date(2024, 1, 6), "Não"),
        (-3, None, dt.date(9999, 12, 31), "Sim"),
        (77, 5, dt.date(2024, 1, 7), "Sim"),
        (None, 5, dt.date(2024, 1, 7), "Sim"),
    ]
    return spark.createDataFrame(rows, "body long, event long, day date, kind string")


@pytest.mark.parametrize("max_bytes", [star.BROADCAST_BYTES, 0])
def test_build_fact(spark, bodies, events, max_bytes):
    dims = {"dim_body": star.build_dim(bodies, DIM), "dim_event": events}
    fact = star.build_fact(votes(spark), FACT, dims, max_bytes=max_bytes)
    assert fact.columns == ["sk_body", "sk_event", "sk_data", "tp", "qtd"]
    assert values(fact) == sorted(
        [
            (1, 1, 20240105, "Sim", 1),
            (-1, -1, 20240106, "Não", 1),
            (-3, -1, 99991231, "Sim", 1),
        ],
        key=repr,
    )


def test_fact_refuses_a_dimension_that_fans_out(spark, bodies, events):
    double = bodies.withColumn("name", F.concat("name", F.monotonically_increasing_id().cast("string")))
    dims = {"dim_body": star.build_dim(double, DIM), "dim_event": events}
    with pytest.raises(ValueError, match="dim_body"):
        star.build_fact(votes(spark), FACT, dims)


def test_fill(spark):
    df = spark.createDataFrame([(None, None, 1)], "a string, b long, c int")
    assert star.fill(df, a="code", b="not_applicable_id").first() == ("N/I", -3, 1)


def test_stamps(spark):
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    row = star.stamp_load(spark.range(1), at, validity=True).first()
    assert row["dh_ingestao"] == at
    assert (row["dt_inicio_vigencia"], row["dt_fim_vigencia"]) == (at.date(), dt.date(9999, 12, 31))


def test_dim_date(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 27),), (dt.date(2024, 3, 1),)], "d date")
    days = star.dim_date(df, "d")
    assert values(days, "sk_data") == [(20240227,), (20240228,), (20240229,), (20240301,)]
    assert days.where("sk_data = 20240301").first()["nr_dia_semana"] == 4


@pytest.mark.parametrize("max_bytes", [star.BROADCAST_BYTES, 0])
def test_roll_up(spark, max_bytes):
    fact = spark.createDataFrame([(1, "x", 10), (1, "y", 5), (2, "x", 1)], "sk long, kind string, v long")
    dim = spark.createDataFrame([(1, "A", 7), (2, "A", 8)], "sk long, name string, other int")
    out = star.roll_up(fact, {"sk": dim}, ["name", "kind"], {"total": "v"}, max_bytes)
    assert values(out) == [("A", "x", 11), ("A", "y", 5)]


def test_window_top_and_digest(spark):
    fact = spark.createDataFrame(
        [(i, 20240101 + i % 20, float(i % 5), i % 3) for i in range(60)],
        "id long, sk_data int, score double, sk long",
    )
    dim = spark.createDataFrame([(0, "a<b"), (1, "B")], "sk long, name string")
    order = [F.desc("score"), F.desc("sk_data"), F.asc("id")]
    window = Window(dt.date(2024, 1, 20), back=10, until=3)
    top = top_of_window(fact, {"sk": dim}, "sk_data", window, order, 4)
    rows = [
        (r["id"], r["sk_data"], r["score"])
        for r in fact.collect()
        if 20240110 <= r["sk_data"] < 20240117 and r["sk"] < 2
    ]
    want = [r[0] for r in sorted(rows, key=lambda r: (-r[2], -r[1], r[0]))[:4]]
    assert [r["id"] for r in top.collect()] == want
    one = digest(
        ranked(top, order), "posicao", ["id"], html_card([F.col("posicao")], [("Nome", F.col("name"))]), "<h>", "</h>"
    ).collect()
    assert len(one) == 1 and one[0]["itens"] == 4
    assert [r["id"] for r in one[0]["proposicoes"]] == want
    assert one[0]["html"].startswith("<h><div") and one[0]["html"].endswith("</h>")
    assert "a<b" not in one[0]["html"]


def test_a_window_skips_data_of_a_published_fact(spark):
    from sedimenta.operators.report import Window
    from sedimenta.plans import star_queries as sq

    sf = "/root/testdata/sf0.001"
    fact = sq.published_orders(spark, sf).read("ft_orders")
    cut = fact.where(Window(sq.REFERENCE_DAY).condition(F.col("sk_data_order")))
    assert "GreaterThanOrEqual(sk_data_order" in cut._jdf.queryExecution().toString()
    files = [sorted(r.sk_data_order for r in fact.where(F.input_file_name() == f.f).collect()) for f in fact.select(F.input_file_name().alias("f")).distinct().collect()]
    spans = sorted((f[0], f[-1]) for f in files)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    plan = sq.top_orders(spark, sf)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "SinglePartition" not in plan.split("== Physical Plan ==")[1].split("TakeOrdered")[0]


def test_a_large_look_up_does_not_sort_the_fact(spark, monkeypatch):
    """Votes of an unknown person share one key, so a task that sorts them holds them all."""
    fact = spark.range(0, 2000).select(F.when(F.col("id") % 7 == 0, -1).otherwise(F.col("id") % 50).alias("k"), "id")
    keys = spark.range(-1, 40).select(F.col("id").alias("k"), (F.col("id") + 100).alias("sk"))
    out = star._look_up(fact, keys, 41, False, 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
    want = [(i, -1 if i % 7 == 0 else i % 50) for i in range(2000)]
    assert values(out, "id", "sk") == sorted(((i, k + 100) for i, k in want if k < 40), key=repr)
    left = star._look_up(fact, keys, 41, True, 0)
    assert left.count() == 2000 and left.where("sk IS NULL").count() == sum(k >= 40 for _, k in want)
    monkeypatch.setattr(star, "_KEY_ROWS", 1)  # too many keys for a hash table of a task
    sorted_ = star._look_up(fact, keys, 41, False, 0)
    assert "ShuffledHashJoin" not in sorted_._jdf.queryExecution().executedPlan().toString() and values(sorted_) == values(out)


def test_keys_are_dealt_before_they_are_counted(spark, monkeypatch):
    df = spark.createDataFrame([(i % 990, "x") for i in range(1000)], "k long, t string")
    monkeypatch.setattr(quality, "KEY_ROWS", 100)
    out = quality.pk_violations(df, ["k", "t"], 1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and ", 10), REPARTITION_BY_NUM" in plan and plan.count("Exchange") == 1
    assert values(out) == sorted(((i, "x", 2) for i in range(10)), key=repr)
