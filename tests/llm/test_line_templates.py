import math
import random
from collections import Counter

import pytest

from sedimenta.llm.line_templates import drop_recurring, leaf_of, levels, masked


def expected(rows, min_docs=5, share=0.7):
    """The same tree, grown in memory."""
    lines = [[(i, masked(x)) for i, x in enumerate((r.text or "").split("\n")) if masked(x)] for r in rows]
    texts = {r.text or "": own for r, own in zip(rows, lines)}.values()
    line_docs = Counter(m for own in texts for m in {m for _, m in own})
    total, token_docs = Counter(), Counter()
    for m, n in line_docs.items():
        total[leaf_of(m)] += n
        for at, token in enumerate(m.split(" ")):
            token_docs[leaf_of(m), at, token] += n
    templates, least = {}, {}
    for m, n in line_docs.items():
        tokens, leaf = m.split(" "), leaf_of(m)
        templates[m] = {m} if n >= min_docs and set(tokens) != {"<*>"} else set()
        least[m] = min_docs
        for level in levels(min_docs):
            constant = [(i, t) for i, t in enumerate(tokens) if t != "<*>" and token_docs[leaf, i, t] >= level]
            if constant and len(constant) / len(tokens) >= share:
                expected = math.prod(token_docs[leaf, i, t] / total[leaf] for i, t in constant) * total[leaf]
                found = (leaf, len(tokens), tuple(constant))
                templates[m].add(found)
                least[found] = min_docs if expected >= total[leaf] / 4 else max(min_docs, math.ceil(2 * expected + 8 * math.sqrt(expected)))
    docs = Counter(t for own in texts for t in set().union(*(templates[m] for _, m in own)))
    out = []
    for r, own in zip(rows, lines):
        gone = {i for i, m in own if any(docs[t] >= least[t] for t in templates[m])}
        text = "\n".join(x for i, x in enumerate((r.text or "").split("\n")) if i not in gone)
        out.append((r.doc_id, text, len(gone)))
    return sorted(out, key=repr)


def check(df, **options):
    rows = drop_recurring(df, **options).collect()
    got = sorted(((r.doc_id, r.text, r.n_dropped) for r in rows), key=repr)
    assert got == expected(df.select("doc_id", "text").collect(), **options)
    return got


@pytest.fixture
def logs(spark):
    rows = []
    for i in range(40):
        user = "ann bob cid dee eva fay".split()[i % 6]
        lines = [f"own{'abcdefghij'[i % 10]}{'klmn'[i // 10]} line of this document"]
        if i % 2:
            lines.append(f"Posted on 2024-01-{i:02d} by {user} in the news section of the site")
        if i % 3 == 0:
            lines.append("Read more")
        if i % 10 == 0:
            lines.append("Rarely repeated footer line")
        rows.append((i, "\n".join(lines)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_fields_are_generalised_and_rare_lines_stay(logs):
    got = {d: t for d, t, _ in check(logs)}
    assert "Posted" not in got[1] and "Read more" not in got[3]
    assert "Rarely" in got[10] and "line of this" in got[0]


def test_lists_inside_one_document_do_not_recur(spark):
    text = "\n".join(f"Item number {c} of the list" for c in "abcdefgh")
    df = spark.createDataFrame([(1, text), (2, "other")], "doc_id long, text string")
    assert check(df) == [(1, text, 0), (2, "other", 0)]


def test_odd_rows(odd, nothing):
    check(odd, min_docs=2)
    assert drop_recurring(nothing).collect() == []


def test_one_line_in_every_document(spark):
    df = spark.createDataFrame([(i, f"The same line\nown{chr(97 + i % 26)} {i % 7} text") for i in range(600)], "doc_id long, text string")
    got = check(df)
    assert all("same line" not in t for _, t, _ in got)


@pytest.mark.parametrize("n", [100, 4000])
def test_fields_stay_fields_in_many_documents(spark, n):
    rng = random.Random(n)
    word = lambda kind, k: f"{kind}{'abcdefghijklmnopqrst'[k // 20]}{'abcdefghijklmnopqrst'[k % 20]}"
    rows = []
    for i in range(n):
        a, b, c = (word(kind, rng.randrange(200)) for kind in ("name", "part", "city"))
        line = f"This post was written by {a} in {b} and filed under {c} for all subscribers today"
        if i % 50 == 0:  # a rarer template of the same leaf, whose values recur too
            line = f"This post was shared by {word('x', i // 50 % 4)} at noon with {word('y', i // 200 % 4)} and then read by many"
        rows.append((i, f"own{word('', i % 400)} {'q' * (i // 400)}\n{line}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = [r.text for r in drop_recurring(df).collect() if "written" in r.text or n > 100 and "shared" in r.text]
    assert left == []


@pytest.mark.parametrize("n", [100, 400, 1600])
def test_unique_prose_stays_at_any_size(spark, n):
    rng = random.Random(n)
    words = "the of and to in is that for it was on are as with at by this be from or".split()
    seen, rows = set(), []
    while len(rows) < n:
        lines = {" ".join(rng.choice(words[:4] if k < 3 else words) for k in range(8)) for _ in range(3)}
        if len(lines) == 3 and not lines & seen:
            seen |= lines
            rows.append((len(rows), "\n".join(sorted(lines))))
    got = check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [d for d, _, dropped in got if dropped] == []


def test_short_furniture_goes_and_numbers_alone_stay(spark):
    furniture = "Posted on 2024-01-{0:02d} at 10:{0:02d}\nPage {0} of 12\nPublished {0} March 2024 at 10:33 by admin\n{0} 20"
    rows = [(i, f"own{chr(97 + i % 26)}{chr(97 + i // 26)} words of this text\n" + furniture.format(i)) for i in range(60)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(t.split("\n") == [rows[d][1].split("\n")[0], f"{d} 20"] for d, t, _ in got)


def test_copies_of_a_text_count_once(spark):
    article = "First line of an article\nand the second one of it"
    rows = [(i, article) for i in range(20)] + [(i, article) for i in range(3)]
    rows += [(100 + i, f"unlike {'abcdef'[i]} text\nand a line of all these") for i in range(6)]
    got = {d: t for d, t, _ in check(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got[0] == got[19] == article and "all these" not in got[103]


def test_query(spark):
    from sedimenta.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted(((r.doc_id, r.text, r.n_dropped) for r in QUERIES["op2_line_templates"](spark, sf).collect()), key=repr)
    assert got == expected(rows)
