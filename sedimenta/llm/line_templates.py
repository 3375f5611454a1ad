"""Line dedup by a tree of log templates.

Lines fall to a leaf by their number of tokens and their leading tokens, tokens with digits being variable. In
a leaf, a token that stands at its place in enough documents is constant and every other one is a variable
field; lines with the same constants share a template. Templates that recur across documents are dropped.

How many documents are enough depends on the template: in many documents the values of a field are frequent as
well. So constants are taken at growing numbers of documents, and a line has one template for each of them.
Prose fits templates by chance where its words are common. So a template with fields must stand in clearly more
documents than its constants would meet in if they were dealt to the leaf's lines independently, unless they make up
most of the leaf. A masked line that recurs as it is needs no such proof.

Documents are distinct texts. Leaves, tokens and templates are grouped sums, so no leaf is gathered in one task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.bits import bitmap, bits_for, maybe
from sedimenta.session import stage, stage_counted

DEPTH = 3
MIN_DOCS = 5
CONSTANT_SHARE = 0.7
LEVEL_STEP = 4  # a field is told from constants if each of its values stands in a quarter of their documents at most
MOST_DOCS = 1 << 40
CHANCE = (2, 8)  # documents of a template: twice what chance gives, and eight times its square root more
LEAF_SHARE = 0.25  # constants that chance alone would bring together in so much of the leaf are its template
FIELD = "<*>"
_DIGIT = re.compile(r"\d")


def masked(line: str) -> str:
    """The tokens of a line, those with digits as fields."""
    tokens = line.split()
    if _DIGIT.search(line):
        tokens = [FIELD if _DIGIT.search(t) else t for t in tokens]
    return " ".join(tokens)


def leaf_of(line: str, depth: int = DEPTH) -> int:
    """The leaf of a masked line as a signed 64-bit number: its number of tokens and its first ones."""
    head = line.split(" ", depth)[:depth]
    key = f"{line.count(' ') + 1} {' '.join(head)}"
    return xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass")) - (1 << 63)


def name_of(line: str) -> int:
    """The identity of a masked line as a signed 64-bit number."""
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass"), seed=1) - (1 << 63)


def levels(min_docs: int) -> list[int]:
    """Numbers of documents from which on a token is constant: `min_docs`, and its growing multiples."""
    out = [min_docs]
    while 0 < out[-1] < MOST_DOCS:
        out.append(out[-1] * LEVEL_STEP)
    return out


def _lines(text: str | None) -> Iterator[tuple[int, str]]:
    for i, line in enumerate((text or "").split("\n")):
        found = masked(line)
        if found:
            yield i, found


def drop_recurring(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    min_docs: int = MIN_DOCS,
    constant_share: float = CONSTANT_SHARE,
) -> DataFrame:
    """Per row of `docs`: doc_id, text without its recurring lines, n_lines, n_dropped.

    A line goes, in every row, also the first,
    * if it stands, masked, in `min_docs` distinct texts or more and not all of its tokens are fields, or
    * if lines of one of its templates do: a template at `min_docs` texts or at any of the higher `levels`, of whose tokens
      at least `constant_share` are constant. With `expected` the texts that chance gives such a template (the leaf's
      lines times the share of each constant), it needs 2 expected + 8 sqrt(expected) texts, unless `expected` is a
      quarter of the leaf or more.
    Copies of a text count once, so copies of an otherwise unlike text stay whole. Lines without tokens stay and are not
    counted. Null and empty texts come back empty. Rows that repeat id and text get the same result each. Other columns
    are ignored.
    """
    source = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("key", F.xxhash64(F.col("doc_id"), F.col("text"))).withColumn("body", F.xxhash64("text"))
    texts = source.select("text", "body")

    bodies = texts.groupBy("body").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    bodies, n_bodies = stage_counted(bodies.select("body"), "copied")
    copied = bitmap(bodies, "body", bits_for(n_bodies))  # of a text that is not in it there is one row only

    def count_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter()
            for text in batch.column(0):
                counts.update({leaf_of(line, depth) for _, line in _lines(text.as_py())})
            yield pa.record_batch([pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], names=["leaf", "n"])

    # Rows are counted here: no leaf of enough texts is missed.
    leaves = texts.select("text").mapInArrow(count_leaves, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n"))
    leaves, n_leaves = stage_counted(leaves.filter(F.col("n") >= min_docs).select("leaf"), "leaves")
    near = bitmap(leaves, "leaf", bits_for(n_leaves))

    def count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter()
            maybe_copied = maybe(copied, batch.column(1).to_numpy()).tolist()
            for text, body, several in zip(batch.column(0), batch.column(1).to_pylist(), maybe_copied):
                found = list(_lines(text.as_py()))
                keys = np.array([leaf_of(line, depth) for _, line in found], np.int64)
                own = {(leaf, line, body if several else None) for (_, line), leaf, ok in zip(found, keys.tolist(), maybe(near, keys)) if ok}
                if several:
                    counts.update(dict.fromkeys(own - counts.keys(), 1))
                else:
                    counts.update(own)
            keys = list(counts)
            yield pa.record_batch(
                [
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([name_of(k[1]) for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.string()),
                    pa.array([k[2] for k in keys], pa.int64()),
                    pa.array(counts.values(), pa.int64()),
                ],
                names=["leaf", "name", "line", "body", "n"],
            )

    counted = texts.mapInArrow(count_lines, "leaf long, name long, line string, body long, n long")
    counted = counted.groupBy("leaf", "name", "line", "body").agg(F.sum("n").alias("n"))
    counted = counted.groupBy("leaf", "name", "line").agg(F.sum(F.when(F.col("body").isNull(), F.col("n")).otherwise(1)).alias("n"))
    counted = stage(counted.join(leaves, "leaf", "left_semi"), "lines")
    total = counted.groupBy("leaf").agg(F.sum("n").alias("total"))
    tokens = counted.select("leaf", "name", "n", F.posexplode(F.split("line", " ")).alias("at", "token"))
    constant = tokens.filter(F.col("token") != FIELD).groupBy("leaf", "at", "token").agg(F.sum("n").alias("docs"))
    constant = constant.filter(F.col("docs") >= min_docs)
    marked = tokens.join(constant, ["leaf", "at", "token"], "left").groupBy("leaf", "name").agg(
        F.max("n").alias("n"),
        F.array_sort(
            F.collect_list(F.when(F.col("docs").isNotNull(), F.struct("at", "token", "docs")))  # a line's own tokens
        ).alias("constants"),
        F.count(F.lit(1)).alias("n_tokens"),
    )
    marked = marked.filter(F.size("constants") > 0).join(total, "leaf")

    def template_at(least):
        own = F.filter("constants", lambda c: c["docs"] >= least)
        expected = F.aggregate(own, F.lit(1.0), lambda x, c: x * (c["docs"] / F.col("total"))) * F.col("total")
        enough = F.ceil(expected * CHANCE[0] + F.sqrt(expected) * CHANCE[1])
        return F.struct(
            F.xxhash64("leaf", "n_tokens", F.transform(own, lambda c: F.struct(c["at"], c["token"]))).alias("template"),
            F.when(expected >= F.col("total") * LEAF_SHARE, min_docs).otherwise(F.greatest(F.lit(min_docs), enough)).cast("long").alias("least"),
            (F.size(own) / F.col("n_tokens")).alias("share"),
        )

    most = F.array_max(F.col("constants.docs"))
    reached = F.filter(F.array(*[F.lit(n).cast("long") for n in levels(min_docs)]), lambda n: n <= most)
    at_levels = F.array_distinct(F.filter(F.transform(reached, template_at), lambda t: t["share"] >= constant_share))
    # A line that recurs as it is needs no more texts; with fields, the sum over a template's lines is the most it can have.
    as_it_is = F.when(F.col("n") >= min_docs, F.array(F.struct(F.col("name").alias("template"), F.lit(0).cast("long").alias("least"), F.lit(1.0).alias("share"))))
    templates = marked.select("name", "n", F.explode(F.concat(at_levels, F.coalesce(as_it_is, F.array()))).alias("t"))
    templates = stage(templates.select("name", "n", "t.template", "t.least"), "templates")
    enough = templates.groupBy("template").agg(F.sum("n").alias("most"), F.max("least").alias("needs")).filter("most >= needs")
    templates, n_templates = stage_counted(templates.join(enough, "template", "left_semi").select("name", "template", "least"), "likely")
    likely = bitmap(templates, "name", bits_for(n_templates))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, names = [], [], []
            for row, text in enumerate(batch.column(0)):
                for i, line in _lines(text.as_py()):
                    rows.append(row)
                    at.append(i)
                    names.append(name_of(line))
            names = np.array(names, np.int64)
            ok = maybe(likely, names)
            rows = np.array(rows, np.int64)[ok]
            yield pa.record_batch(
                [batch.column(1).take(pa.array(rows)), batch.column(2).take(pa.array(rows)), pa.array(np.array(at, np.int32)[ok]), pa.array(names[ok])],
                names=["key", "body", "at", "name"],
            )

    found = source.select("text", "key", "body").mapInArrow(occurrences, "key long, body long, at int, name long")
    found = stage(found.join(templates, "name").select("key", "body", "at", "template", "least"), "occurrences")
    held = found.select("template", "least", "body").distinct()  # a line that is in a hot template is split by its texts
    recurring = held.groupBy("template").agg(F.count(F.lit(1)).alias("docs"), F.max("least").alias("least"))
    recurring = recurring.filter(F.col("docs") >= F.col("least"))
    gone = found.join(recurring.select("template"), "template", "left_semi")
    gone = gone.groupBy("key").agg(F.collect_set("at").alias("gone"))
    lines = F.split("text", "\n")
    kept = F.when(
        F.col("gone").isNull(), F.col("text")
    ).otherwise(F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("gone", i)), "\n"))
    with_tokens = F.size(F.filter(lines, lambda x: x.rlike(r"\S")))
    return source.join(gone, "key", "left").select(
        "doc_id",
        kept.alias("text"),
        with_tokens.cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
