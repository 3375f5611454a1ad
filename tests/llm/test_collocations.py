import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sedimenta.llm import collocations as co


def pieces(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", folded)]


def counted(rows, longest=4):
    """(lang, phrase) -> count of all phrases, and lang -> words, by plain Python."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    return f, n


def expected(rows, longest=4, least=30, top=2000, covered_percent=80):
    f, n = counted(rows, longest)
    f = {k: v for k, v in f.items() if v >= least}
    around = Counter()
    for (lang, words), a in f.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = lang, words[i : i + size]
                around[key] = max(around[key], a)
    out = []
    for (lang, words), a in f.items():
        if len(words) < 2 or 100 * around[lang, words] >= covered_percent * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, -score, -a, " ".join(words).encode(), left, right))
    out.sort()
    ranks, done = Counter(), []
    for lang, score, a, phrase, left, right in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            done.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return done


def check(df, **options):
    got = co.collocations(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(map(tuple, got.collect())) == sorted(expected([(r.lang, r.text) for r in df.collect()], **options))


def corpus(seed, n, vocabulary=40):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)] + ["Ünder", "日本", "it's", "a|b", "\x85x", "\x1cy", "A"]
    fixed = ["new york city hall", "carbon dioxide", "to be or not", "New York"]
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(60)):
            words.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(names))
            if rng.random() < 0.15:
                words.append(rng.choice([".", ", ", ";", "\n", "\r", "\x0b", "\t", "!?"]))
        out.append((i, rng.choice(["en", "de", None, ""]), " ".join(words)))
    return out


def test_random_corpora(spark):
    schema = "doc_id long, lang string, text string"
    df = spark.createDataFrame(corpus(1, 400), schema).repartition(5)
    check(df, least=4)
    check(df, least=2, top=25, covered_percent=60)
    check(df, least=3, longest=2)
    check(df, least=3, longest=3)
    check(spark.createDataFrame(corpus(2, 60), schema), least=1)


def test_odd_rows(odd, nothing):
    check(odd)
    check(odd, least=2)
    assert co.collocations(nothing).collect() == []


def test_ties_go_by_the_bytes_of_the_phrase(spark):
    text = ". ".join(["zz top", "é top2", "a b", "Z q", "~ k"])
    check(spark.createDataFrame([(i, "en", text) for i in range(40)], "doc_id long, lang string, text string"), top=3)


@pytest.mark.parametrize("burst, limit, chunk", [(16_384, 1_000_000, 500_000), (3, 40, 17), (1, 5, 4), (50, 200, 1000)])
def test_bursts_and_spills_lose_nothing(monkeypatch, burst, limit, chunk):
    """Bounds of memory, down to tiny ones, do not change a count."""
    monkeypatch.setattr(co, "LIMIT", limit)
    monkeypatch.setattr(co, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(co.HatTrie.__init__, "__defaults__", (burst,))
    rows = [("und" if lang is None else lang, text) for _, lang, text in corpus(3, 120)]
    found, langs_seen = Counter(), {}
    for lengths in ((1,), (2,), (3, 4)):
        batches = [
            pa.record_batch([pa.array([r[0] for r in rows[s : s + 25]]), pa.array([r[1] for r in rows[s : s + 25]])], names=["lang", "text"])
            for s in range(0, len(rows), 25)
        ]
        parts = {}
        for batch in co._count_in_tasks(lengths, 7, None, None)(iter(batches)):
            for row in batch.to_pylist():
                parts.setdefault(row["part"], []).append(row)
        for runs in parts.values():
            for run in runs:
                of = [run["langs"][i] for i in np.frombuffer(run["lang_of"], "<u4")]
                words = list(zip((langs_seen.setdefault(x, len(langs_seen)) for x in of), run["words"].split(b"\n")))
                assert len(set(words)) == len(words)
                grams = np.frombuffer(run["grams"], "<u4").reshape(max(lengths), -1).T.tolist()
                assert grams == sorted(grams)
            for row in co._merge_runs(1, max(lengths))(pa.Table.from_pylist(runs, schema=co._RUN)).to_pylist():
                if row["phrase"] is not None:
                    found[row["lang"], tuple(row["phrase"].split(" "))] += row["f"]
    assert found == counted(rows)[0]


def test_the_largest_subtrees_leave_first():
    trie = co.HatTrie(burst=4)
    trie.add(np.array([1] * 20 + [2] * 3), np.concatenate([np.arange(1, 21) << co._SECOND, np.arange(1, 4) << co._SECOND]))
    assert trie.entries == 23 and not isinstance(trie.top[1], Counter) and isinstance(trie.top[2], Counter)
    first, rest, count = trie.spill(10)
    assert set(first.tolist()) == {1} and sorted((rest >> co._SECOND).tolist()) == list(range(1, 21)) and set(count.tolist()) == {1}
    assert trie.entries == 3 and list(trie.top) == [2]


def test_rejects_lengths_it_cannot_count(nothing):
    with pytest.raises(ValueError):
        co.collocations(nothing, longest=5)


def test_bitmap_size_follows_the_keys():
    from sedimenta.llm.bits import bits_for

    assert [bits_for(n) for n in (0, 1, 2048, 2049, 1 << 20, 1 << 40)] == [15, 15, 15, 16, 24, 28]
