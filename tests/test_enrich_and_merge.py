import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.operators import enrich, merge, quality
from sedimenta.operators import similarity as sim
from sedimenta.operators.keys import row_ranges
from sedimenta.plans.parliament import THEMES
from sedimenta.sources.tables import read_table
from tests.conftest import values


@pytest.fixture(scope="module")
def items(spark):
    rows = [(3, "c"), (1, "a"), (2, "  "), (4, None), (5, "e")]
    return spark.createDataFrame(rows, "id int, text string")


def test_pending(spark, items):
    done = spark.createDataFrame([(1,), (1,), (9,)], "id int")
    ids = lambda df: [r["id"] for r in df.collect()]
    assert ids(enrich.pending(items, done, "id", "text")) == [3, 5]
    assert ids(enrich.pending(items, done, "id", "text", limit=1)) == [3]
    assert ids(enrich.pending(items, done, "id", "text", reprocess=True)) == [1, 3, 5]
    assert ids(enrich.pending(items, None, "id", "text")) == [1, 3, 5]


def test_batches(spark):
    df = spark.range(0, 103).select((F.col("id") * 3).alias("id"))
    planned = enrich.plan_batches(df, "id", 50)
    assert values(planned.groupBy("batch_id").count()) == [(1, 50), (2, 50), (3, 3)]
    assert planned.where("batch_id = 3").agg(F.min("id")).first()[0] == 300
    counters = enrich.batch_counters(df.withColumn("r", F.when(F.col("id") > 30, 1)), 50, "r").first()
    assert tuple(counters) == (103, 3, 92, 11)
    assert enrich.unfinished(df, df.where("id < 30"), "id").count() == 93


def test_hook_loads_once_and_chunks(spark):
    def load():
        import pandas as pd

        state = {"calls": 0}

        def score(frame):
            state["calls"] += 1
            return pd.DataFrame({"id": frame["id"], "n": len(frame), "call": state["calls"]})

        return score

    df = spark.range(0, 100, numPartitions=1)
    out = enrich.enrich_batches(df, load, "id long, n int, call int", chunk=32, name="test_hook").collect()
    assert sorted(r["id"] for r in out) == list(range(100))
    assert max(r["n"] for r in out) == 32
    assert max(r["call"] for r in out) == 4


def test_providers_are_asked_in_turn(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    def first(text):
        calls.add(1)
        if len(text) > 1:
            raise RuntimeError("429 tokens")
        return "1:" + text

    def second(text):
        if text == "bad":
            raise ValueError("cannot")
        return "2:" + text

    def spent(e):
        return "429" in str(e)

    rows = [(1, "x"), (2, "long"), (3, "y"), (4, "bad")]
    df = spark.createDataFrame(rows, "id int, text string")
    show = ("id", "result", "provider", "error", "asked", "lot")
    out = enrich.ask_in_turn(df, [("a", first), ("b", second)], spent, "id", "text", folder + "/p", size=1)
    assert values(out, *show) == [
        (1, "1:x", "a", None, ["a"], 1),
        (2, "2:long", "b", None, ["a", "b"], 2),
        (3, "2:y", "b", None, ["b"], 3),  # `a` is known to be used up
        (4, None, "b", "cannot", ["b"], 4),
    ]
    assert calls.value == 2
    # a later run over the same folder sends new items only, and knows who is used up
    more = df.union(spark.createDataFrame([(5, "z")], df.schema))
    out = enrich.ask_in_turn(more, [("a", first), ("b", second)], spent, "id", "text", folder + "/p", size=1)
    assert values(out.where("id = 5"), *show) == [(5, "2:z", "b", None, ["b"], 5)] and out.count() == 5
    assert calls.value == 2


def test_an_exhausted_provider_is_left_alone_by_all_tasks(spark, folder):
    """Four tasks a lot: each may call it once, before the first refusals are stored, and none afterwards."""
    calls = spark.sparkContext.accumulator(0)

    def only(_):
        calls.add(1)
        raise RuntimeError("429")

    df = spark.createDataFrame([(i, "t") for i in range(400)], "id int, text string")
    out = enrich.ask_in_turn(df, [("a", only)], lambda e: True, "id", "text", folder + "/p", size=100)
    assert 1 <= calls.value <= spark.sparkContext.defaultParallelism
    assert values(out.select("result", "provider", "error").distinct()) == [(None, None, "all providers are exhausted")]
    assert out.count() == 400 and out.where("lot > 1 AND size(asked) > 0").count() == 0
    # they stay open: once a provider answers again, a run over them gets results
    out = enrich.ask_in_turn(df, [("a", only), ("b", str.upper)], lambda e: True, "id", "text", folder + "/p", size=400)
    assert values(out.select("result", "provider").distinct()) == [("T", "b")] and out.count() == 400
    assert enrich.ask_in_turn(df.limit(0), [("a", only)], lambda e: True, "id", "text", folder + "/q").count() == 0


def test_lots_are_ranges_that_use_the_cluster(spark):
    df = spark.range(0, 103).select((F.col("id") * 3).alias("id"))
    lots = [[r["id"] for r in lot.collect()] for lot in enrich.in_lots(df, "id", 50)]
    assert [len(x) for x in lots] == [50, 50, 3] and max(lots[0]) < min(lots[1]) and max(lots[1]) < min(lots[2])
    assert next(enrich.in_lots(df, "id", 50)).rdd.getNumPartitions() > 1
    assert list(enrich.in_lots(df.limit(0), "id", 50)) == []


def test_many_lots_take_few_jobs(spark, folder):
    df = spark.range(0, 300).select((F.col("id") * 3).alias("id"))
    calls = []
    enrich.score_in_lots(df, "id", 3, lambda lot: calls.append(1) or lot, folder + "/few")
    assert len(calls) <= 8  # 100 lots: one write for each before
    assert sorted(r["id"] for r in spark.read.parquet(folder + "/few").collect()) == [3 * i for i in range(300)]


@pytest.mark.parametrize("wrong", [0, 4, 62, 99])
def test_the_lots_before_a_failure_are_kept_and_no_other(spark, folder, wrong):
    df = spark.range(0, 100, numPartitions=3)

    def score(lot):
        return lot.select(F.when(F.col("id") == wrong, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))

    with pytest.raises(Exception, match="broken"):
        enrich.score_in_lots(df, "id", 5, score, folder + "/kept")
    kept = read_table(spark, folder + "/kept", df.schema, optional=True)
    assert sorted(r["id"] for r in kept.collect()) == list(range(wrong // 5 * 5))


def test_a_range_of_rows_reads_its_own_part(spark):
    df = spark.range(0, 25_000).withColumn("t", F.repeat(F.lit("x"), 50))
    between, n = row_ranges(df.unionAll(df.where("id = 7")), ["id"])
    assert n == 25_001 and [r["id"] for r in between(1, 3).collect()] == [0, 1, 2]
    assert [r["id"] for r in between(7, 10).collect()] == [6, 7, 7, 8]
    assert sorted(r["id"] for r in between(9_000, 25_001).collect()) == list(range(8_998, 25_000))
    plan = between(1, 3)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(__at), GreaterThanOrEqual(__at" in plan


def test_merge_partials(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id int")
    a = spark.createDataFrame([(1, "t")], "id int, theme string")
    b = spark.createDataFrame([(2, "s"), (9, "z")], "id int, summary string")
    assert values(enrich.merge_partials(ids, [a, b], "id")) == [(1, "t", None), (2, None, "s")]


def test_classify_matches_brute_force_and_first_label_wins_ties(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(200, 16)).astype("float32")
    labels = [(f"l{i}", vectors[i].tolist()) for i in range(7)]
    labels.insert(3, ("twin", labels[0][1]))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None)]
    df = spark.createDataFrame(rows, "id int, embedding array<float>").repartition(5)
    got = {r["id"]: r for r in sim.classify_top1(df, labels).collect()}
    products = vectors.astype("float64") @ np.array([v for _, v in labels]).T
    for i in range(200):
        best = int(products[i].argmax())
        assert got[i]["tema_classificado"] == labels[best][0]
        assert got[i]["score_similaridade"] == pytest.approx(products[i, best], abs=6e-5)
    assert got[900]["tema_classificado"] is None and got[900]["score_similaridade"] is None


def test_labels_in_blocks_give_the_same(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(50, 4)).round(0))], "id int, embedding array<float>")
    labels = [(f"l{i}", v.tolist()) for i, v in enumerate(rng.normal(size=(9, 4)).round(0))]
    want = values(sim.classify_top1(df, labels).drop("embedding"))
    for block in (1, 2, 4):
        assert values(sim.classify_top1(df, labels, block=block).drop("embedding")) == want


def test_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 8)).astype("float32")
    vectors[7] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id int, v array<float>")
    query = vectors[0]
    with np.errstate(invalid="ignore"):
        cosines = vectors @ query / np.linalg.norm(vectors, axis=1) / np.linalg.norm(query)
    want = sorted((i for i in range(300) if i != 7), key=lambda i: -cosines[i])[:10]
    got = sim.nearest(df, "v", F.array(*[F.lit(float(x)) for x in query]), "id", 10)
    assert [r["id"] for r in got.collect()] == want


def test_distribution_and_label_top(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (2, "b", 0.9), (3, "a", 0.7)], "id int, t string, s double")
    assert [tuple(r) for r in sim.distribution(df, "t").collect()] == [("a", 2), ("b", 1)]
    assert [r["id"] for r in sim.label_top(df, "t", "a", "s", "id").collect()] == [3, 1]


def test_words_find_the_theme(spark):
    texts = [(0, "hospitais e medicamentos do sistema de saúde"), (1, "rodovias, ferrovias e portos"), (2, None)]
    themes = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(THEMES.items())], "o int, n string, t string")
    items = spark.createDataFrame(texts, "id int, t string")
    got = {r["id"]: r for r in sim.lexical_top1(items, themes, "id", "t", "n", "o").collect()}
    assert (got[0].tema_classificado, got[1].tema_classificado) == ("Saúde", "Infraestrutura")
    assert got[2].score_similaridade == 0 and len(got) == 3


def test_themes_of_repeated_and_missing_keys(spark):
    """The texts of one key count as one, and a row without a key has the first theme; no word moves for the others."""
    themes = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(THEMES.items())], "o int, n string, t string")
    texts = [(1, "rodovias x"), (1, "ferrovias e portos"), (2, "escolas, escolas"), (None, "hospitais"), (None, "x"), (3, ""), (4, "clima")]
    items = spark.createDataFrame(texts, "id int, t string")
    got = values(sim.lexical_top1(items, themes, "id", "t", "n", "o"), "id", "tema_classificado")
    want = [(1, "Infraestrutura"), (1, "Infraestrutura"), (2, "Educação"), (3, "Saúde"), (4, "Meio Ambiente"), (None, "Saúde")]
    assert got == sorted([*want, (None, "Saúde")], key=repr)
    together = spark.createDataFrame([(1, "rodovias x ferrovias e portos"), *texts[2:]], "id int, t string")
    again = values(sim.lexical_top1(together, themes, "id", "t", "n", "o").where("id = 1"), "score_similaridade")
    assert 0 < again[0][0] and len(again) == 1
    plan = sim.lexical_top1(items.where("id > 1"), themes, "id", "t", "n", "o")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_word_counts_are_those_of_the_hash(spark):
    import hashlib

    df = spark.createDataFrame([(1, "Ação, ação 2x"), (1, "x"), (2, None), (None, "é")], "id int, t string")
    place = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 1024
    want = [(1, place("ação"), 2), (1, place("2x"), 1), (1, place("x"), 1), (None, place("é"), 1)]
    assert values(sim.word_counts(df, "id", "t")) == sorted(want, key=repr)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, None, None)], "id int, t string, s double")


@pytest.mark.parametrize("max_bytes", [10**6, 0])
def test_upsert(spark, target, max_bytes):
    updates = spark.createDataFrame([("B", 2), (None, 1), ("new", 9)], "t string, id int")
    once = merge.upsert(target, updates, ["id"], max_bytes)
    assert values(once) == sorted([(1, None, 1.0), (2, "B", 2.0), (3, None, None), (9, "new", None)], key=repr)
    assert values(merge.upsert(once, updates, ["id"], max_bytes)) == values(once)
    with pytest.raises(ValueError):
        merge.upsert(target, updates.withColumn("x", F.lit(1)), ["id"])


def test_latest_update(spark):
    df = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "only", 1)], "id int, t string, at long")
    assert values(merge.latest_update(df, ["id"], "at")) == [(1, "new", 2), (2, "only", 1)]


def test_backfill(spark):
    target = spark.createDataFrame([(1, None), (2, "kept"), (3, None)], "id int, o string")
    found = spark.createDataFrame([(1, "found"), (2, "other"), (3, None), (8, "x")], "id int, o string")
    once = merge.backfill(merge.audit_copy(target, "o"), found, "id", "o")
    want = sorted([(1, "found", None), (2, "kept", "kept"), (3, None, None)], key=repr)
    assert values(once) == want
    again = merge.backfill(merge.audit_copy(once, "o"), found, "id", "o")
    assert values(again) == want


def test_quality(spark, target):
    profile = {r["coluna"]: r for r in quality.profile(target).collect()}
    assert tuple(profile["t"]) == ("t", "string", 33.33, 2, "a")
    assert tuple(profile["id"]) == ("id", "int", 0.0, 3, "1")
    approx = {r["coluna"]: tuple(r) for r in quality.profile(target, approx=True).collect()}
    assert approx == {k: tuple(v) for k, v in profile.items()}
    assert dict(values(quality.null_violations(target))) == {"id": 0, "t": 1, "s": 1}
    assert values(quality.pk_violations(target.union(target.where("id = 1")), ["id"])) == [(1, 2)]
    empty = target.where("id > 10")
    assert values(quality.row_counts({"a": target, "b": empty})) == [("a", 3, False), ("b", 0, True)]
    assert quality.require({"a": target, "b": empty}, ["a", "b"]) == ["b"]
    with pytest.raises(LookupError, match="c"):
        quality.require({"a": target}, ["a", "c"])


@pytest.mark.parametrize("max_bytes", [10**6, 0])
def test_upsert_computes_its_updates_once_and_refuses_repeated_keys(spark, target, max_bytes):
    runs = spark.sparkContext.accumulator(0)

    def score(frames):
        for frame in frames:
            runs.add(len(frame))
            yield frame

    updates = spark.createDataFrame([(i, f"t{i}") for i in range(10)] + [(None, "loose")], "id int, t string")
    out = merge.upsert(target, updates.mapInPandas(score, updates.schema), ["id"], max_bytes)
    assert out.count() == 11 and runs.value == 11
    with pytest.raises(ValueError, match="more than once"):
        merge.upsert(target, updates.union(updates), ["id"], max_bytes)


def test_merged_parts_do_not_fan_out(spark):
    ids = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    part = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    assert values(enrich.merge_partials(ids, [part], "id")) == [(1, "a"), (2, None)]


def test_profiles_of_loads_add_up(spark):
    first = spark.createDataFrame([(1, "a", 1.5), (2, None, 2.5)], "id int, t string, s double")
    second = spark.createDataFrame([(2, "a"), (3, "c"), (4, None)], "id int, t string")
    loads = quality.profile_sketch(first).unionByName(quality.profile_sketch(second))
    got = {r["coluna"]: tuple(r)[1:] for r in quality.merge_profiles(loads).collect()}
    assert got == {"id": ("int", 5, 0.0, 4), "t": ("string", 5, 40.0, 2), "s": ("double", 5, 60.0, 2)}
    empty = quality.merge_profiles(quality.profile_sketch(first.limit(0))).collect()
    assert {tuple(r)[2:] for r in empty} == {(0, None, 0)}
