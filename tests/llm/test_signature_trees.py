import random

import numpy as np
import pytest

from sedimenta.llm import signature_trees as st
from sedimenta.llm.components import components


def sets(rows, width=4):
    out = []
    for r in rows:
        w = (r.text or "").encode().lower().split()
        n = min(width, len(w))
        out.append(set(zip(*(w[i:] for i in range(n)))) if n else set())
    return out


def expected(rows, percent=85, width=4):
    own = sets(rows, width)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(own):
        for j in range(i):
            common = len(a & own[j])
            if common and 100 * common >= percent * (len(a) + len(own[j]) - common):
                parent[root(i)] = root(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append(r.doc_id)
    low = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((r.doc_id, len(s), low[root(i)]) for i, (r, s) in enumerate(zip(rows, own))), key=repr)


def check(df, **options):
    rows = st.jaccard_components(df, **options).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)
    assert got == expected(df.select("doc_id", "text").collect(), **options)


def families(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    out = []
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 4, 6, 8, 9, 10, 12, 15, 20, 30, 60, 120, 300]))]
        for _ in range(rng.choice([2, 5, 20])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 45))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text = text[: max(1, len(text) - rng.randint(0, len(text) // 8))]
            out.append(" ".join(text))
    return out


@pytest.mark.parametrize("block, rounds", [(512, 3), (4, 3), (512, 0), (5, 1)])
def test_families_of_near_copies(spark, monkeypatch, block, rounds):
    monkeypatch.setattr(st, "BLOCK", block)
    monkeypatch.setattr(st, "ROUNDS", rounds)
    check(spark.createDataFrame(list(enumerate(families(block + rounds, 25))), "doc_id long, text string"))


def test_other_shingles_and_thresholds(spark):
    df = spark.createDataFrame(list(enumerate(families(77, 20))), "doc_id long, text string")
    check(df, percent=80, width=5)
    check(df, percent=60, width=2)


def test_odd_rows(odd, nothing):
    check(odd)
    assert st.jaccard_components(nothing).collect() == []


def test_linked_sets_meet_among_their_rarest_shingles():
    """At the edge of the threshold, for every size, whatever the order of the shingles: the largest difference that links."""
    rng = np.random.default_rng(3)
    for n in [*range(1, 80), 150, 400, 1000]:
        for grow in (0, 1):
            a = rng.permutation(1 << 20)[:n]
            if grow:  # b holds a
                b = np.concatenate([a, (1 << 20) + np.arange(n * 100 // 85 - n)])
            else:  # both have the same size
                common = -(-2 * n * 85 // 185)
                b = np.concatenate([a[:common], (1 << 20) + np.arange(n - common)])
            order = rng.permutation(1 << 21)
            rarest = [set(sorted(x.tolist(), key=order.__getitem__)[: st.prefix_length(len(x))]) for x in (a, b)]
            assert rarest[0] & rarest[1], n


def test_a_shared_passage_alone_makes_no_pairs(spark, monkeypatch):
    """Documents of 4,000 words that share 3,200 of them (similarity about 0.67) do not meet at all; with 3,760 shared
    (0.88) they are one component, with 3,640 (0.83) they meet, and none is linked."""
    rng = random.Random(4)
    met = []
    forest = st._forest

    def counted(percent):
        met.append(percent)
        return forest(percent)

    monkeypatch.setattr(st, "_forest", counted)
    for shared, linked in ((3200, False), (3760, True), (3640, False)):
        passage = [f"p{i}" for i in range(shared)]
        texts = [" ".join([*passage, *(f"w{rng.randrange(10**9)}" for _ in range(4000 - shared))]) for _ in range(60)]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        got = {r.component_id for r in st.jaccard_components(df).collect()}
        assert len(got) == (1 if linked else 60)
    assert len(met) == 3


def test_passages_give_no_candidates():
    """The rarest shingles of such documents are their own: nothing is shown to the others."""
    import pyarrow as pa

    passage = [f"p{i}" for i in range(3200)]
    own = {i: st.shingles(" ".join([*passage, *(f"w{i} {j}" for j in range(400))])) for i in range(30)}
    rows = []
    for name, tokens in own.items():
        names = np.full(len(tokens), name, np.int64)
        rows.append({"bucket": 0, **st._by_class(names, np.full(len(tokens), st.spare_of(tokens, 1)), tokens >> np.uint64(32))})
    table = pa.Table.from_pylist(rows, schema=pa.schema([("bucket", pa.int32()), *st._CLASSES]))
    shared = st._shared(3)(table)
    assert shared.num_rows
    for owner in set(shared["owner"].to_pylist()):
        some = pa.Table.from_pylist([r for r in shared.to_pylist() if r["owner"] == owner], schema=shared.schema)
        assert st._rarest(some).num_rows == 0


def test_the_tree_leaves_out_no_linked_pair():
    rng = random.Random(9)
    own = [st.shingles(t) for t in families(1, 12)]
    tree = st.Tree(np.array([len(s) for s in own]), np.array([st.bitmap_of(s) for s in own]))
    a, b = tree.pairs()
    found = {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    pairs = [(i, j) for i in range(len(own)) for j in range(i) if len(own[i])]
    assert all(frozenset(p) in found for p in pairs if st.linked(own[p[0]], own[p[1]]))
    assert len(found) < len(pairs) / 3 and rng


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1300)]
    label = {}
    for a, b in edges:
        for n in (a, b):
            label.setdefault(n, n)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    label = {n: v for n, v in label.items() if any(n in e and e[0] != e[1] for e in edges)}
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in rows} == label


def test_query(spark):
    from sedimenta.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op10_signature_trees"](spark, sf).collect()), key=repr)
    assert got == expected(rows)
