from collections import Counter

from sedimenta.llm.quality_rules import (
    BASE,
    MEASURES,
    POLICIES,
    ablations,
    apply_policy,
    ledger,
    measure,
    policy_changes,
    repeated_words,
    rules,
)


def slow_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    return len({j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 3)})


def test_repeated_words_against_brute_force():
    for text in (b"a b c a b c", b"a a a a", b"a b c d a b c", b"", b"a b", b"x y z w x y z q x y z"):
        assert repeated_words(text.split()) == slow_repeats(text.split())


def test_measures():
    m = dict(zip(MEASURES, measure("AB cd* é\nAB cd* é\n \nx|y")))
    assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"]) == (7, 15, 3, 1, 6)
    assert (m["n_lines"], m["n_upper_words"], m["n_distinct_words"], m["n_top_word"]) == (3, 2, 4, 2)
    assert measure(None) == measure("") == measure(" \n") == (0,) * len(MEASURES)


def test_ledger_of_odd_rows(odd):
    rows = ledger(odd).collect()
    assert len(rows) == odd.count()
    want = sorted((r.doc_id, *measure(r.text)) for r in odd.collect() if r.doc_id is not None)
    assert sorted((r.doc_id, *(r[m] for m in MEASURES)) for r in rows if r.doc_id is not None) == want
    for r in rows:
        assert bool(r.failed & 1) == (r.n_words < 50)
        assert bool(r.failed & 2) == (100 * r.n_repeat_words > 50 * r.n_words)


def test_policies_and_ablations_equal_a_second_evaluation(odd):
    entries = ledger(odd).cache()
    kept = apply_policy(entries, "strict-1").collect()
    mask = POLICIES["strict-1"]
    assert all(r.kept == (r.failed & mask == 0) for r in kept)
    found = {r.rule: r for r in ablations(entries, "strict-1").collect()}
    assert set(found) == {r.name for i, r in enumerate(rules()) if mask >> i & 1}
    for i, rule in enumerate(rules()):
        without = sum(r.failed & mask & ~(1 << i) == 0 for r in kept)
        assert found[rule.name].n_kept_without == without
        assert found[rule.name].n_failed == sum(r.failed >> i & 1 for r in kept)
    changes = {(r.kept_old, r.kept_new): r.n for r in policy_changes(entries, "base-1", "strict-1").collect()}
    assert sum(changes.values()) == len(kept) and (False, True) not in changes


def test_clean_prose_stays_and_junk_goes(spark):
    clean = " ".join(f"word{i % 37}a the{i % 11}b of{i % 7}c" for i in range(60))
    junk = " ".join(f"w{i}***" for i in range(100))
    loud = " ".join(f"LOUD{chr(65 + i % 26)}{chr(65 + i // 26)}" for i in range(100))
    df = spark.createDataFrame([(1, clean), (2, junk), (3, loud)], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in apply_policy(ledger(df)).collect()} == {1: True, 2: False, 3: False}


def test_no_rows(nothing):
    assert ledger(nothing).collect() == [] and ablations(ledger(nothing)).collect() == []
    assert BASE == 3
