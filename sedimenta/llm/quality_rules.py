"""Quality rules as a bitmask ledger.

Every document is measured once. Every rule is evaluated once, and the ledger stores one failure
bit per rule next to the measurements. A policy is a named, versioned mask of rules, so that
policies are applied, compared and ablated on the ledger without touching a text again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct_words",
    "n_top_word",
    "n_upper_words",
    "n_alpha_words",
    "n_lines",
    "longest_word",
)


def measure(text: str | None) -> tuple[int, ...]:
    """The values of `MEASURES` for one text; null has no words and no lines."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode("utf-8", "surrogatepass").split()  # splits bytes at ASCII white space only
    n = len(words)
    if not n:
        return (0,) * len(MEASURES)
    joined = b" ".join(words).decode("utf-8", "surrogatepass")
    strings = joined.split(" ")
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    counts = Counter(words)
    return (
        n,
        len(joined) - (n - 1),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(counts),
        max(counts.values()),
        sum(map(str.isupper, strings)),
        sum(1 for w in strings if w[0].isalpha()),
        len(lines),
        max(map(len, strings)),
    )


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which occurs twice or more, its first occurrence included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, reach = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(i, reach)
            reach = i + 3
    return covered


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(t.as_py()) for t in batch.column(1)]
        columns = list(zip(*rows)) if rows else [()] * len(MEASURES)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in columns), *batch.columns[2:]],
            names=["doc_id", *MEASURES, *batch.schema.names[2:]],
        )


def share(part: str, whole: str) -> Column:
    """part / whole, 0 where the whole is 0."""
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


@dataclass(frozen=True)
class Rule:
    """A document fails the rule where `fails` holds over the measurements."""

    name: str
    fails: Column


def base_rules() -> list[Rule]:
    return [
        Rule("few_words", F.col("n_words") < 50),
        Rule("repetition", 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    ]


def rules() -> list[Rule]:
    """Bit i of a ledger belongs to rule i; append new rules, never reorder."""
    return base_rules() + [
        Rule("symbols", share("n_symbols", "n_words") > 0.1),
        Rule("shouting", share("n_upper_words", "n_words") > 0.3),
        Rule("one_word", share("n_top_word", "n_words") > 0.2),
        Rule("repeated_lines", share("n_dup_lines", "n_lines") > 0.4),
        Rule("few_letters", share("n_alpha_words", "n_words") < 0.6),
        Rule("word_length", ~share("word_chars", "n_words").between(2.0, 15.0)),
        Rule("endless_word", F.col("longest_word") > 1000),
    ]


BASE = 0b11
# Versioned policies: a document goes if it fails any rule of the mask.
POLICIES: Mapping[str, int] = {
    "base-1": BASE,
    "prose-1": BASE | 0b1111100,
    "strict-1": BASE | 0b111111100,
}


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: str | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, the measurements, and `failed`, the bits of failed rules.

    Null and empty texts have no words and fail `few_words`. Rows that repeat an id are measured
    each. Other columns are ignored, but for the one named by `carry`, which is passed on. Nothing is shuffled.
    """
    more = [F.col(carry)] if carry else []
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *more)
    measures = [F.lit(0).cast("long").alias(m) for m in MEASURES]
    schema = rows.select("doc_id", *measures, *more).schema
    bits = [F.when(r.fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(rules())]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return rows.mapInArrow(_measured, schema).withColumn("failed", failed.cast("long"))


def apply_policy(entries: DataFrame, policy: str = "prose-1", out: str = "kept") -> DataFrame:
    """The ledger with a boolean column: no rule of the policy failed."""
    return entries.withColumn(out, F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) == 0)


def ablations(entries: DataFrame, policy: str = "prose-1") -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (they come back without the
    rule), and that stay if it is left out. Rows are first merged by their bits (at most 2^rules)."""
    mask = POLICIES[policy]
    named = F.array(
        *(
            F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
            for i, r in enumerate(rules())
            if mask >> i & 1
        )
    )
    bits = entries.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    each = bits.select("bits", "n", F.explode(named).alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone = F.col("bits") == F.col("bit")
    return each.groupBy("rule", "bit").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when((F.col("bits") == 0) | alone, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )


def policy_changes(entries: DataFrame, old: str, new: str) -> DataFrame:
    """Rows by (kept under `old`, kept under `new`)."""
    both = apply_policy(apply_policy(entries, old, "kept_old"), new, "kept_new")
    return both.groupBy("kept_old", "kept_new").agg(F.count(F.lit(1)).alias("n"))
