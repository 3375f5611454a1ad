import hashlib
import re

import pytest
from pyspark.sql import functions as F

from sedimenta.llm import fingerprints as fp


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    run = min(width, len(words))
    return {" ".join(words[i : i + run]) for i in range(len(words) - run + 1)} if words else set()


def sketch(text, width=5, least=32):
    every = sorted({hashlib.md5(s.encode()).hexdigest()[:16] for s in shingles(text, width)})
    low = [h for h in every if h < "2"]
    if len(low) >= least:
        return "2", low
    return ("~", every) if len(every) <= least else (every[least - 1] + "~", every[:least])


def as_text(s):
    return s[0] + ":" + "".join(s[1])


def likeness(a, b):
    below = min(a[0], b[0])
    x, y = ({h for h in s[1] if h < below} for s in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def expected(rows):
    def digest(r):
        own = "" if r.doc_id is None else str(r.doc_id)
        return hashlib.md5(":".join([str(r.doc_id is None).lower(), own, r.text or ""]).encode()).hexdigest()

    rows = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, digest(r)))
    out = []
    for i, r in enumerate(rows):
        text, follows = r.text or "", rows[(i + 1) % len(rows)].text or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + follows[:cut]
        a, b, c = map(sketch, (text, edited, follows))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((r.doc_id, len(text), sha, as_text(a), as_text(b), likeness(a, b), likeness(a, c)))
    return sorted(out, key=repr)


def got(df):
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted((tuple(r) for r in fp.fingerprint_edits(df).select(columns).collect()), key=repr)


def test_odd_rows(odd, nothing):
    assert got(odd) == expected(odd.select("doc_id", "text").collect())
    assert got(nothing) == []


def test_one_document_is_its_own_next(spark):
    df = spark.createDataFrame([(7, "one two three four five six seven eight")], "doc_id long, text string")
    assert got(df) == expected(df.collect())


def test_equal_texts_have_equal_sketches(odd):
    by = {}
    for r in fp.fingerprint_edits(odd).select("fingerprint").distinct().collect():
        by[r.fingerprint] = 1
    texts = {r.text or "" for r in odd.select("text").collect()}
    assert set(by) == {as_text(sketch(t)) for t in texts}


def test_a_part_is_found_in_a_text_fifty_times_as_long(spark):
    """Containment holds between very unequal texts, and the merged sketch of parts is that of the whole."""
    import random

    rng = random.Random(5)
    words = [f"w{rng.randrange(5000)}" for _ in range(40_000)]
    rows = [(" ".join(words), " ".join(words[10_000:10_800]), " ".join(words[:20_004]), " ".join(words[20_000:]))]
    df = spark.createDataFrame(rows, "whole string, part string, head string, tail string")
    for c in df.columns:
        df = fp.with_sketch(df, c, f"{c}_s")
    row = df.select(
        fp.containment(F.col("part_s"), F.col("whole_s")).alias("inside"),
        fp.containment(F.col("whole_s"), F.col("part_s")).alias("around"),
        fp.likeness(F.col("whole_s"), F.col("part_s")).alias("like"),
        (fp.merged(F.col("head_s"), F.col("tail_s")) == F.col("whole_s")).alias("same"),
    ).first()
    assert row.inside == 1.0 and row.same
    assert row.around == pytest.approx(0.02, abs=0.01) and row.like == pytest.approx(0.02, abs=0.01)


def test_estimates_are_close_to_the_sets(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    from sedimenta.llm.queries import QUERIES

    found = {r.doc_id: r for r in QUERIES["op11_fingerprints"](spark, "/root/testdata/sf0.01").collect()}
    rows.sort(key=lambda r: r.doc_id)
    off = []
    for i, r in enumerate(rows):
        follows = rows[(i + 1) % len(rows)].text
        cut = len(r.text) // 4
        a, b = shingles(r.text, 5), shingles(r.text[: len(r.text) - cut] + follows[:cut], 5)
        if a | b:
            off.append(abs(found[r.doc_id].near_edited - len(a & b) / len(a | b)))
    assert len(found) == len(rows) and sum(off) / len(off) < 0.05 and max(off) < 0.35


def test_plan_runs_in_the_jvm_and_moves_texts_once(spark):
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = fp.fingerprint_edits(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
        done.collect()
        plan = done._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert "Python" not in plan and "Arrow" not in plan
    assert "ReusedExchange" in plan and plan.count("FileScan parquet [doc_id") == 1
