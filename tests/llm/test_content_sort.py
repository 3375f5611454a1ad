import hashlib
import re

from sedimenta.llm.content_sort import content_sort


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", r.text or ""), []).append(r)
    out = []
    for norm, group in groups.items():
        best = min(group, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(r.doc_id, best.doc_id, len(group), digest) for r in group]
    return sorted(out, key=repr), len(groups)


def check(df):
    rows = content_sort(df).collect()
    want, groups = expected(df.select("doc_id", "text").collect())
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr) == want
    kept = [r for r in rows if r.kept]
    assert len(kept) == len({r.text_sha256 for r in rows}) == groups
    assert all(r.doc_id == r.keep_id for r in kept)


def test_odd_rows(odd):
    check(odd)


def test_hot_text_is_split_and_put_together(spark):
    hot = [(i, "the same text" + " " * (i % 7)) for i in range(900)]
    check(spark.createDataFrame(hot + [(1000 + i, f"text {i % 50}") for i in range(200)], "doc_id long, text string"))


def test_no_rows(nothing):
    assert content_sort(nothing).collect() == []


def test_runs_without_python(odd):
    plan = content_sort(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
