import datetime as dt
import json
import os
from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.vectors import from_text, to_text
from sedimenta.session import new_path, shared_dir, stage_counted, together
from sedimenta.sources import landing, tables
from sedimenta.sources.tables import Layer
from tests.conftest import values

NESTED = (
    "id int, nome string, status struct<sigla: string, lider: struct<uri: string>>, "
    "orgaos array<struct<id: int, sigla: string>>"
)
ROWS = [
    (1, "Ana", ("PT", ("x/7",)), [(10, "A"), (11, None)]),
    (2, None, ("PL", None), []),
    (3, "Caio", None, None),
]


@pytest.fixture(scope="module")
def nested(spark):
    return spark.createDataFrame(ROWS, NESTED)


def test_flatten_keeps_paths_and_lists(nested):
    flat = landing.flatten(nested)
    assert flat.columns == ["id", "nome", "status.sigla", "status.lider.uri", "orgaos"]
    assert values(flat, "`id`", "`status.lider.uri`") == [(1, "x/7"), (2, None), (3, None)]


def test_jsonify_keeps_null_fields_and_accents(spark):
    df = spark.createDataFrame([([(1, None), (2, "ação")],)], "l array<struct<id: int, s: string>>")
    text = landing.jsonify_complex(df).first()[0]
    assert json.loads(text) == [{"id": 1, "s": None}, {"id": 2, "s": "ação"}]
    assert "ação" in text


def test_explode_children(nested):
    children = landing.explode_children(nested, "orgaos", "id", "idEventoContexto")
    assert children.columns == ["id", "sigla", "idEventoContexto"]
    assert values(children) == [(10, "A", 1), (11, None, 1)]


def test_evolve_schema(spark):
    old = spark.createDataFrame([(1, "a")], "id int, x string")
    new = spark.createDataFrame([("2", 5.5)], "id string, y double")
    out = landing.evolve_schema(old, new)
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "string", "string"]
    assert values(out) == [(1, "a", None), (2, None, "5.5")]


def test_lookback_and_year_reach_the_scan(spark, folder):
    days = spark.range(0, 800).select(
        F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("d"), "id"
    )
    days.write.parquet(folder + "/days")
    read = spark.read.parquet(folder + "/days")
    recent = landing.lookback(read, "d", dt.date(2001, 3, 1), 30)
    assert recent.agg(F.min("d")).first()[0] == dt.date(2001, 1, 30)
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d" in (
        recent._jdf.queryExecution().executedPlan().toString()
    )
    assert landing.this_year(read, "d", dt.date(2001, 3, 1)).count() == 365


def test_samples_and_parents(spark):
    parents = spark.createDataFrame([(i,) for i in (3, 1, 2)], "id int")
    children = spark.createDataFrame([(i, p) for p in (1, 2, 3) for i in range(p)], "i int, p int")
    assert values(landing.sample_head(parents, 2, "id")) == [(1,), (2,)]
    assert values(landing.latest_parents(children, parents, "id", "p"), "p") == [(2,)] * 2 + [(3,)] * 3
    detail = spark.createDataFrame([(1, "a"), (9, "z")], "id int, v string")
    assert values(landing.expand_details(parents, detail, "id")) == [(1, "a")]


def test_read_landed(spark, folder):
    path = folder + "/deputados"
    spark.range(2).coalesce(1).select(
        F.lit(json.dumps({"dados": [{"id": 1, "nome": "Ana"}, {"id": 2}], "links": []})).alias("value")
    ).limit(1).write.text(path)
    out = landing.read_landed(spark, path, T.StructType.fromDDL("id int, nome string"))
    assert values(out) == [(1, "Ana"), (2, None)]


def test_parent_from_path(spark, folder):
    for parent in (7, 8):
        spark.createDataFrame([(parent * 10,)], "id int").write.json(f"{folder}/votos/id={parent}.json")
    df = spark.read.schema("id int").json(f"{folder}/votos/*")
    out = landing.stamp_parent_from_path(df, r"id=(\d+)\.json", "idVotacaoContexto")
    assert values(out) == [(70, "7"), (80, "8")]


def test_stamp(spark):
    df = landing.stamp_capture(spark.range(1), dt.datetime(2024, 1, 2, 3, 4, 5))
    assert df.first()["data_captura"] == "2024-01-02 03:04:05"


def test_read_table(spark, folder):
    schema = T.StructType.fromDDL("a int")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_table(spark, folder + "/none").count()
    assert tables.read_table(spark, folder + "/none", schema, optional=True).count() == 0


def test_layer_replaces_and_keeps(spark, folder):
    layer = tables.Layer(spark, folder + "/layer")
    assert layer.names() == []
    assert layer.replace("t", spark.range(3))
    assert not layer.replace("t", spark.range(0))
    assert layer.read("t").count() == 3
    with pytest.raises(KeyError):
        layer.read("u")


def test_refresh_is_all_or_nothing_and_keeps_enrichment(spark, folder):
    layer = tables.Layer(spark, folder + "/layer")
    layer.refresh({"a": spark.range(1), "bills_ia": spark.range(2)})
    broken = spark.range(1).select(F.raise_error(F.lit("broken")).cast("int").alias("x"))
    with pytest.raises(Exception, match="broken"):
        layer.refresh({"b": spark.range(5), "c": broken})
    assert layer.names() == ["a", "bills_ia"]
    layer.refresh({"b": spark.range(5), "e": spark.range(0)}, skip_empty=True)
    assert layer.names() == ["b", "bills_ia"]
    assert layer.read("bills_ia").count() == 2
    # a table can be replaced by something that is read from it
    layer.refresh({"b": layer.read("b").where("id > 2")})
    assert layer.read("b").count() == 2


def test_batches_and_vectors_as_text(spark, folder):
    rows = [(i, [i / 3.0, -1.0], i // 4 + 1) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, v array<float>, batch_id int")
    tables.write_batches(df.withColumn("v", to_text(F.col("v"))), folder + "/b")
    back = tables.read_batches(
        spark, folder + "/b", T.StructType.fromDDL("id int, v string, batch_id int"), [1, 3]
    )
    assert values(back, "id") == [(0,), (1,), (2,), (3,), (8,), (9,)]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert all(x in plan.split("PushedFilters")[1] for x in ("LessThanOrEqual(batch_id,3)", "In(batch_id, [")), plan
    assert tables.read_batches(spark, folder + "/b", back.schema, []).count() == 0
    assert len(back.inputFiles()) <= 8, "files follow rows, not batches"
    vector = back.where("id = 1").select(from_text(F.col("v"))).first()[0]
    assert vector == pytest.approx([1 / 3, -1.0])


def test_csv_round_trip(spark, folder):
    df = spark.createDataFrame([(1, 'a "b", c\nd'), (2, None), (3, "ação\\")], "id int, t string")
    path = tables.export_csv(df, folder, "stg_partidos_bruto", dt.datetime(2024, 1, 2, 3, 4, 5))
    assert path.endswith("/stg_partidos_ajustada_20240102_030405.csv")
    assert values(tables.import_csv(spark, path, df.schema)) == values(df)


def test_stage_counts_and_uses_the_configured_folder(spark):
    df, n = stage_counted(spark.range(10).where("id > 3"))
    assert (n, df.count()) == (6, 6)
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", shared_dir(spark)).rstrip("/")
    assert new_path(spark, "x") != new_path(spark, "x")


def test_clear_stages_takes_only_its_own_folder(spark, folder, monkeypatch):
    from sedimenta import session

    monkeypatch.setattr(session, "shared_dir", lambda _: folder)
    spark.range(3).write.parquet(folder + "/other")
    staged = session.stage(spark.range(5))
    assert staged.count() == 5
    session.clear_stages(spark)
    assert not session.path_exists(spark, f"{folder}/sedimenta/{spark.sparkContext.applicationId}")
    assert spark.read.parquet(folder + "/other").count() == 3


def test_publications_at_once_keep_all_tables(spark, folder):
    layer = Layer(spark, folder + "/layer")
    together({f"t{i}": partial(layer.replace, f"t{i}", spark.range(i + 1)) for i in range(6)})
    assert [layer.read(n).count() for n in layer.names()] == [1, 2, 3, 4, 5, 6]


def test_an_unfinished_version_is_passed_over(spark, folder, monkeypatch):
    layer = Layer(spark, folder + "/layer")
    layer.replace("t", spark.range(3))
    with open(folder + "/layer/_catalogue/000000000002.json", "w") as half:
        half.write('{"t": "/not')
    assert layer.read("t").count() == 3
    monkeypatch.setattr(tables, "_PATIENCE", 0.2)
    layer.replace("u", spark.range(4))
    assert layer.names() == ["t", "u"] and layer.read("u").count() == 4


_SLOW_WRITER = """
import os, sys, time
sys.path.insert(0, {root!r})
from sedimenta.session import build_session
from sedimenta.sources.tables import Layer
spark = build_session("slow", "local[1]")
layer = Layer(spark, {layer!r})
spark.range(7).write.parquet({layer!r} + "/slow")
rounds = []
def change(tables):
    rounds.append(dict(tables))
    if len(rounds) == 1:
        open({flag!r}, "w").close()
        while not os.path.exists({flag!r} + ".go"):
            time.sleep(0.05)
    return {{**tables, "slow": {layer!r} + "/slow"}}
layer._publish(change)
print("ROUNDS", len(rounds))
"""


def test_a_stalled_writer_loses_nothing(spark, folder, monkeypatch):
    """Another process takes a version, stalls until it was passed over, and then finishes it."""
    import subprocess
    import sys
    import time

    from tests.conftest import ROOT

    layer, flag = Layer(spark, folder + "/layer"), folder + "/flag"
    layer.replace("first", spark.range(1))
    code = _SLOW_WRITER.format(root=ROOT, layer=folder + "/layer", flag=flag)
    slow = subprocess.Popen([sys.executable, "-c", code], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True)
    try:
        until = time.time() + 90
        while not os.path.exists(flag):
            assert time.time() < until and slow.poll() is None
            time.sleep(0.1)
        monkeypatch.setattr(tables, "_PATIENCE", 0.2)
        layer.replace("second", spark.range(2))  # passes the stalled version over
        assert layer.names() == ["first", "second"]
        open(flag + ".go", "w").close()
        assert "ROUNDS 2" in slow.communicate(timeout=90)[0]
    finally:
        slow.kill()
    assert {n: layer.read(n).count() for n in layer.names()} == {"first": 1, "second": 2, "slow": 7}
