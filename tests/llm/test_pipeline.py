import random
import re

import pytest

import corpus_pipeline
from sedimenta.llm.queries import ORACLES, QUERIES
from sedimenta.llm.quality_rules import POLICIES, Rule, measure, MEASURES, rules
from tests.llm.conftest import ODD_SCHEMA, odd_texts, prose
from tests.llm.test_signature_trees import expected as components_of
from tests.llm.test_tokens_and_packing import check_places

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "exact_dedup", "near_dedup", "packing"]
    assert all(isinstance(r, Rule) for r in rules())


def failed(spark, text):
    schema = ", ".join(f"{m} long" for m in MEASURES)
    row = spark.createDataFrame([measure(text)], schema)
    return [bool(x) for x in row.select(*(r.fails for r in rules())).head()]


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(21)
    base = prose(rng, 150)
    rows = [(i, t) for i, t in enumerate(odd_texts())]
    rows += [(200 + i, base + " " * i) for i in range(6)]  # exact copies
    words = base.split()
    rows += [(300 + i, " ".join([*words[: 20 * i], f"new{i}", *words[20 * i :]])) for i in range(5)]  # near copies
    rows += [(None, base), (None, base), (200, base), (400, "w*** " * 100), (401, prose(rng, 90).upper())]
    full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), 1, "a", "b", "c", 2) for i, t in rows]
    return spark.createDataFrame(full, ODD_SCHEMA).repartition(3).cache()


def test_stages(spark, documents, tmp_path):
    docs, seen = documents, {}
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.schema.names == documents.schema.names
        seen[name] = docs.collect()

    mask = POLICIES[corpus_pipeline.POLICY]
    bits = {t: sum(f << i for i, f in enumerate(failed(spark, t))) for t in {r.text for r in documents.collect()}}
    good = sorted((repr(tuple(r)) for r in documents.collect() if bits[r.text] & mask == 0))
    assert sorted(repr(tuple(r)) for r in seen["quality"]) == good
    assert {r.doc_id for r in seen["quality"]}.isdisjoint({0, 1, 2, 3, 400, 401})
    assert sorted(repr(tuple(r)) for r in seen["language"]) == good  # all of it is prose

    groups = {}
    for r in seen["language"]:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", r.text), []).append(r)
    best = {min(g, key=lambda r: (-len(r.text), r.doc_id is None, r.doc_id or 0)) for g in groups.values()}
    assert sorted(repr(tuple(r)) for r in seen["exact_dedup"]) == sorted(repr(tuple(r)) for r in best)

    links = components_of(seen["exact_dedup"], percent=80, width=5)
    assert sorted(r.doc_id for r in seen["near_dedup"]) == sorted({c for _, _, c in links})
    assert len([r for r in seen["near_dedup"] if r.doc_id in (205, 300, 301, 302, 303, 304)]) == 1

    check_places(seen["packing"])
    assert {r.doc_id for r in seen["packing"]} == {r.doc_id for r in seen["near_dedup"]}


def test_no_documents(spark, nothing, tmp_path):
    docs = nothing
    for name, apply in corpus_pipeline.STAGES:
        docs = apply(spark, docs, SF)
        assert docs.collect() == []


def test_columns_that_stages_use_inside(spark, documents):
    names = {"n": "key", "name": "_key", "kind": "row", "label": "rank"}
    docs = documents.drop("key").withColumnsRenamed(names).filter("doc_id >= 200")
    for _, apply in corpus_pipeline.STAGES[:-1]:
        docs = apply(spark, docs, SF)
        assert docs.select("key", "_key", "row", "rank").distinct().collect() == [(1, "a", "b", 2)]


def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    check_places(rows)
    ids = {r.doc_id for r in rows}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert not ids & {r.doc_id for r in labels if r.quality == 0}
