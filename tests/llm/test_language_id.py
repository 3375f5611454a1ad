import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import language_id as li

SAMPLES = {
    "en": "the river is in the valley and the market of the town was open for all of them with this".split(),
    "fr": "la rivière est dans la vallée et le marché de la ville était ouvert pour tous avec une".split(),
    "de": "der fluss ist in dem tal und der markt von der stadt war offen für alle mit einer".split(),
    "es": "el río está en el valle y el mercado de la ciudad estaba abierto para todos con una".split(),
}


def corpus(n=40):
    rows = []
    for i in range(n):
        for j, (language, words) in enumerate(SAMPLES.items()):
            text = " ".join(words[(i * 7 + k * 5) % len(words)] for k in range(3 + i))
            host = f"https://www.{language}{i % 3}.example.{'com' if i % 2 else language}/p/{i}"
            rows.append((i * 4 + j, text, language if i % 5 else None, host))
    return rows


@pytest.fixture(scope="module")
def mixed(spark):
    wrong = [(900, " ".join(SAMPLES["de"] * 3), "fr", "https://de1.example.de/x"), (901, "ok", "es", "https://www.es1.example.es/")]
    junk = [(902, "zxqj wvkq jjxz qqzk xkcd vqxz jkwq zzqx " * 9, None, None), (903, "12 34 !!", "en", None), (904, None, "en", None)]
    rows = corpus() + wrong + junk
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4).cache()


def test_clean_documents_stay_with_their_language(mixed):
    got = {r.doc_id: r for r in li.identify(mixed).collect()}
    for d, _, _, host in corpus():
        assert got[d].kept and got[d].language == host[12:14], got[d]


def test_text_outweighs_a_wrong_declaration_and_the_rest_decides_short_ones(mixed):
    got = {r.doc_id: r for r in li.identify(mixed).collect()}
    assert (got[900].declared, got[900].language, got[900].kept) == ("fr", "de", True)
    assert got[901].language == "es" and got[901].kept
    assert got[902].language == "und" and not got[902].kept
    assert not got[903].kept and not got[904].kept and got[903].n_grams == 0


def plain(rows, languages=li.LANGUAGES):
    """The fusion row by row in Python."""
    names = [*languages, li.UNKNOWN]
    counts = np.zeros((len(names), li.BUCKETS))
    for r in rows:
        if r.lang in languages:
            np.add.at(counts[languages.index(r.lang)], li.trigrams(r.text), 1)
    model = np.log((counts + li.SMOOTHING) / (counts.sum(axis=1, keepdims=True) + li.SMOOTHING * li.BUCKETS))
    evidence = [model[:, li.trigrams(r.text)].sum(axis=1) / li.OVERLAP for r in rows]
    share = [np.exp(e - e.max()) / np.exp(e - e.max()).sum() for e in evidence]
    some = [len(li.trigrams(r.text)) > 0 for r in rows]
    whole = sum(s for s, ok in zip(share, some) if ok)
    n = whole.sum()
    base = (whole + 1) / (n + len(names))
    host = [r.source.split("//")[1].split("/")[0] if r.source else None for r in rows]
    keys = {
        "declared": [r.lang for r in rows],
        "suffix": [h and h.split(".")[-1] for h in host],
        "domain": [h and ".".join(h.split(".")[-2:]) for h in host],
        "host": host,
    }
    sums = {k: {} for k in keys}
    for k, own in keys.items():
        for value, s, ok in zip(own, share, some):
            if value is not None and ok:
                sums[k][value] = sums[k].get(value, 0) + s
    out = {}
    for i, r in enumerate(rows):
        mine = share[i] if some[i] else np.zeros(len(names))
        rest = lambda k: np.maximum(0, sums[k].get(keys[k][i], np.zeros(len(names))) - mine)
        log = evidence[i].copy() if some[i] else np.zeros(len(names))
        for k in ("declared", "suffix"):
            if keys[k][i] is not None:
                common = (rest(k).sum() + 1) / (n + 1)
                log += np.log((rest(k) + li.WEIGHT * common) / (whole - mine + li.WEIGHT))
        domain = (rest("domain") + li.WEIGHT * base) / (rest("domain").sum() + li.WEIGHT)
        log += np.log((rest("host") + li.WEIGHT * domain) / (rest("host").sum() + li.WEIGHT))
        p = np.exp(log - log.max()) / np.exp(log - log.max()).sum()
        out[r.doc_id] = (names[int(p.argmax())], float(p.max()))
    return out


def test_against_plain_python(mixed):
    want = plain(mixed.collect())
    for r in li.identify(mixed).collect():
        language, confidence = want[r.doc_id]
        assert r.confidence == pytest.approx(confidence, rel=1e-6)
        assert r.language == language or math.isclose(confidence, 0.5, rel_tol=1e-3)


def test_pages_with_markup_and_address(spark):
    rows = [(d, f'<html lang="{u[12:14]}"><p>{t}', u) for d, t, _, u in corpus(12)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string").withColumn("text", F.regexp_replace("html", "<[^>]*>", " "))
    got = li.identify(pages, "page_id", "text", declared=li.markup_language(F.col("html")), address=F.col("url")).collect()
    assert all(r.kept and r.language == r.declared for r in got) and len(got) == len(rows)


def test_odd_rows(odd, nothing):
    got = li.identify(odd, carry=("name", "label")).collect()
    assert len(got) == odd.count() and got[0].name in ("n", "", None)
    assert not any(r.kept for r in got if r.doc_id in (0, 1, 2))
    assert all(r.language for r in got)
    assert li.identify(nothing).collect() == []


def test_query(spark):
    from sedimenta.llm.queries import QUERIES

    got = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 1000 and sum(r.language == r.declared for r in got) > 990 and sum(r.kept for r in got) > 990
