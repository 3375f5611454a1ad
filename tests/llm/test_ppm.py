import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm.ppm import END, ORDER, canonical, gram_scores, grams, low_counts, score_texts, values


def slow_grams(texts, order):
    out = []
    for text in texts:
        data = bytes([END]) * order + text + bytes([END])
        out += [int.from_bytes(data[i : i + order + 1], "big") for i in range(len(text) + 1)]
    return out


def slow_log(counts, context, symbol):
    """log10 of a symbol behind a context by plain recursion over Counters of (context, symbol)."""
    gone, total = set(), 0.0
    for k in range(len(context), -1, -1):
        own = {s: c for (x, s), c in counts.items() if x == context[len(context) - k :]}
        if not own:
            continue
        seen = {s: c for s, c in own.items() if s not in gone}
        n, d = sum(seen.values()), len(seen)
        if n:
            if symbol in seen:
                return total + math.log10((2 * seen[symbol] - 1) / (2 * n))
            total += math.log10(d / (2 * n))
        gone |= set(own)
    return total - math.log10(256 - len(gone))


TEXTS = [canonical(t) for t in ("the cat sat on the mat", "a cat and a dog", "", "zebra", "the the the the", "été à")]


@pytest.mark.parametrize("order", [2, 3, 5])
def test_grams(order):
    packed, sizes = grams(TEXTS, order)
    assert packed.tolist() == slow_grams(TEXTS, order) and sizes.tolist() == [len(t) + 1 for t in TEXTS]


def table(train, ask, order):
    seen = Counter(grams(train, order)[0].tolist())
    keys = np.array(sorted(set(seen) | set(grams(ask, order)[0].tolist())), np.int64)
    counts = np.array([seen[k] for k in keys.tolist()], np.int64)
    return keys, values(keys, counts, low_counts(keys, counts), order)


@pytest.mark.parametrize("order", [2, 3, 5])
def test_values_against_plain_recursion(order):
    counts = Counter()
    for text in TEXTS[:4]:
        data = bytes([END]) * order + text + bytes([END])
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts[data[i - k : i], data[i]] += 1
    ask = [*TEXTS, canonical("the dog sat qqq")]
    keys, logs = table(TEXTS[:4], ask, order)
    for key, log in zip(keys.tolist(), logs.tolist()):
        data = key.to_bytes(order + 1, "big")
        assert log == pytest.approx(slow_log(counts, data[:-1], data[-1]), abs=1e-9)


def test_probabilities_of_all_symbols_sum_to_one():
    contexts = [b"the", b"zqx", b"t t", bytes([END]) * 3, b"cat"]
    keys = np.unique([int.from_bytes(c + bytes([s]), "big") for c in contexts for s in range(256)])
    seen = Counter(grams(TEXTS, 3)[0].tolist())
    every = np.union1d(keys, list(seen))
    counts = np.array([seen[k] for k in every.tolist()], np.int64)
    logs = values(every, counts, low_counts(every, counts), 3)
    for c in contexts:
        own = (every >> 8) == int.from_bytes(c, "big")
        assert (10 ** logs[own]).sum() == pytest.approx(1)


def expected(rows, held, order=ORDER):
    texts = [canonical(r.text) for r in rows]
    train = [t for t, h in zip(texts, held) if not h]
    words = Counter(w for t in train for w in t.split())
    n, kinds = sum(words.values()) + len(train), len(words) + (len(train) > 0)
    keys, logs = table(train, texts, order) if texts else (None, None)
    out = []
    for r, t, h in zip(rows, texts, held):
        tokens = t.split()
        base = sum(math.log10((words[w] + 1) / (n + kinds + 1)) for w in tokens)
        base += math.log10((len(train) + 1) / (n + kinds + 1))
        known = sum(words[w] > 0 for w in tokens) + (len(train) > 0)
        out.append((r.doc_id, h, len(tokens) + 1, known, n, base, float(gram_scores([t], keys, logs, order)[0])))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 3))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-5, abs=1e-3)


def test_odd_rows(odd):
    rows = odd.collect()
    held = [r.doc_id is not None and r.doc_id % 4 == 1 for r in rows]
    same(score_texts(odd, F.col("doc_id") % 4 == 1, chunk_bytes=4000).collect(), expected(rows, held))


def test_nothing_to_learn_from(odd, nothing):
    rows = odd.filter("doc_id < 8").collect()
    same(score_texts(odd.filter("doc_id < 8"), F.lit(True)).collect(), expected(rows, [True] * len(rows)))
    assert score_texts(nothing, F.lit(False)).collect() == []


def test_query_and_held_out_texts(spark):
    from sedimenta.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    held = [zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
    got = QUERIES["op8_ppm"](spark, sf).collect()
    same(got, expected(rows, held))
    bytes_ = {r.doc_id: len(canonical(r.text)) + 1 for r in rows}
    bits = -sum(r.score for r in got if r.held_out) * math.log2(10) / sum(bytes_[r.doc_id] for r in got if r.held_out)
    assert bits < 2.6  # a byte alone takes about 3.8
