"""Language of documents by Bayesian fusion of what speaks for it.

    text       letter trigrams under a model per language, counted over all documents that declare one
    declared   the language a document or its markup declares, with its reliability learned from the texts
    suffix     the last label of the address
    host       a prior per host, smoothed towards its domain and the corpus

Reliabilities and priors are grouped sums of the languages that the texts alone speak for; the share of the
document itself is taken out of them. A further candidate, `und`, has a flat trigram model and takes
texts in no known language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.session import stage

LANGUAGES = ("en", "fr", "de", "es")
UNKNOWN = "und"
BUCKETS = 1 << 16
SMOOTHING = 0.5
OVERLAP = 3  # a letter stands in three trigrams
WEIGHT = 20.0  # documents that a parent counts for

_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the trigrams of letters and word borders; a text without letters has none."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()
    if not raw:
        return np.zeros(0, np.int64)
    data = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8).astype(np.uint32)
    packed = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    return ((packed * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def markup_language(html: Column) -> Column:
    """The language that the markup of a page declares, or null."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1))
    return F.when(found != "", found)


def host_of(address: Column) -> Column:
    """The host of an address, or the source name itself."""
    host = F.regexp_extract(F.lower(address), r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]+)", 1)
    return F.when(host != "", host)


def domain_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]+(?:\.[^.]+)?)$", 1)


def suffix_of(host: Column) -> Column:
    found = F.regexp_extract(host, r"\.([^.]+)$", 1)
    return F.when(found != "", found)


def train(docs: DataFrame, text_col: str, declared: Column, languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """log P(trigram bucket | language), one column per language and one for `und`; at most
    `BUCKETS` x languages counts reach the driver. All rows that declare a known language count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in batches:
            for text, language in zip(batch.column(0), batch.column(1).to_pylist()):
                found = trigrams(text.as_py())
                if len(found):
                    np.add.at(counts[language], found, 1)
        at, bucket = np.nonzero(counts)
        yield pa.record_batch(
            [pa.array(at, pa.int64()), pa.array(bucket, pa.int64()), pa.array(counts[at, bucket])],
            names=["language", "bucket", "n"],
        )

    number = F.coalesce(*(F.when(declared == name, F.lit(i)) for i, name in enumerate(languages)))
    rows = docs.select(F.col(text_col).alias("text"), number.alias("language")).filter("language IS NOT NULL")
    sums = rows.mapInArrow(run, "language long, bucket long, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(languages) + 1, BUCKETS))
    for row in sums.collect():
        counts[row.language, row.bucket] = row.n
    share = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.log(share).T.copy()


def softmax(logs: np.ndarray) -> np.ndarray:
    parts = np.exp(logs - logs.max(axis=1, keepdims=True))
    return parts / parts.sum(axis=1, keepdims=True)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(pa.float64()))


def text_evidence(rows: DataFrame, model: np.ndarray, text_col: str = "text") -> DataFrame:
    """`rows` without the text, plus n_grams, `evidence` (log P(text | candidate), overlaps taken out) and
    `share` (how far the text alone speaks for each candidate; nothing without letters)."""
    keep = [c for c in rows.columns if c != text_col]
    source = rows.select(*keep, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, found = np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, model.shape[1]))
            for i, text in enumerate(batch.column(len(keep))):
                grams = trigrams(text.as_py())
                n[i] = len(grams)
                found[i] = model[grams].sum(axis=0) / OVERLAP
            share = softmax(found) * (n > 0)[:, None]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n), _lists(found), _lists(share)],
                names=[*keep, "n_grams", "evidence", "share"],
            )

    numbers = F.array().cast("array<double>")
    schema = source.select(*keep, F.lit(0).cast("long").alias("n_grams"), numbers.alias("evidence"), numbers.alias("share"))
    return source.mapInArrow(run, schema.schema)


GROUPS = ("_declared", "_suffix", "_domain", "_host")


def fuse(evidence: np.ndarray, share: np.ndarray, whole: np.ndarray, sums: dict[str, np.ndarray], known: dict[str, np.ndarray]) -> np.ndarray:
    """Posteriors of rows. `sums` holds for each row the shares that its group has in all, itself included;
    `known` tells which rows have a value."""
    n = whole.sum()
    base = (whole + 1.0) / (n + len(whole))
    rest = {k: np.maximum(0.0, sums[k] - share) for k in GROUPS}  # without the row itself
    logs = evidence.copy()
    for k in ("_declared", "_suffix"):
        common = (rest[k].sum(axis=1, keepdims=True) + 1.0) / (n + 1.0)  # the value's share of the corpus
        likelihood = (rest[k] + WEIGHT * common) / (np.maximum(0.0, whole - share) + WEIGHT)
        logs += np.log(likelihood) * known[k][:, None]
    prior = base
    for k in ("_domain", "_host"):
        prior = (rest[k] + WEIGHT * prior) / (rest[k].sum(axis=1, keepdims=True) + WEIGHT)
    return softmax(logs + np.log(prior))


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared: Column | None = None,
    address: Column | None = None,
    carry: tuple[str, ...] = (),
    languages: tuple[str, ...] = LANGUAGES,
    least: float = 0.5,
) -> DataFrame:
    """Per row of `docs`: doc_id, declared, language, confidence, n_grams, kept, and the columns in `carry`.

    `declared` and `address` are columns of `docs` (default: lang and source); null ones are no evidence. A row is
    kept if its text has letters, and its language is one of `languages` with at least `least` posterior. Null and
    empty texts and texts without letters are not kept; their language still follows the
    other evidence. Rows that repeat an id are judged each. Ties go to the first candidate.

    Only slim rows are joined with the grouped sums; these are as many as there are hosts, domains, suffixes
    and declared values, and Spark broadcasts them only where it has measured them to be small.
    """
    names = np.array([*languages, UNKNOWN], object)
    declared = F.lower(F.col("lang") if declared is None else declared)
    host = host_of(F.col("source") if address is None else address)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        declared.alias("_declared"),
        host.alias("_host"),
        *(F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)),
        F.col(text_col).alias("_text"),
    )
    model = train(rows, "_text", F.col("_declared"), languages)
    weighed = text_evidence(rows, model, "_text")
    weighed = weighed.withColumns({"_domain": domain_of(F.col("_host")), "_suffix": suffix_of(F.col("_host"))})
    weighed = stage(weighed, "language-evidence")
    shares = [F.sum(F.col("share")[i]) for i in range(len(names))]
    whole = np.array([x or 0.0 for x in weighed.agg(*shares).head()])
    joined = weighed
    for key in GROUPS:
        grouped = weighed.filter(F.col(key).isNotNull()).groupBy(key).agg(F.array(*shares).alias(f"{key}_sum"))
        joined = joined.join(grouped, key, "left")
    passed = [f"_carry{i}" for i in range(len(carry))]
    source = joined.select("n_grams", "evidence", "share", *(f"{k}_sum" for k in GROUPS), "doc_id", "_declared", *passed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(0).to_numpy()
            evidence, share = (batch.column(i).flatten().to_numpy().reshape(-1, len(names)) for i in (1, 2))
            sums, known = {}, {}
            for i, key in enumerate(GROUPS):
                column = batch.column(3 + i)
                known[key] = column.is_valid().to_numpy(zero_copy_only=False)
                sums[key] = np.zeros_like(share)
                sums[key][known[key]] = column.flatten().to_numpy().reshape(-1, len(names))
            posterior = fuse(evidence, share, whole, sums, known)
            best, confidence = posterior.argmax(axis=1), posterior.max(axis=1)
            kept = (n > 0) & (best < len(languages)) & (confidence >= least)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(7),
                    batch.column(8),
                    pa.array(names[best], pa.string()),
                    pa.array(confidence),
                    batch.column(0),
                    pa.array(kept),
                    *batch.columns[9:],
                ],
                names=["doc_id", "declared", "language", "confidence", "n_grams", "kept", *carry],
            )

    schema = joined.select(
        "doc_id",
        F.col("_declared").alias("declared"),
        F.lit("").alias("language"),
        F.lit(0.0).alias("confidence"),
        "n_grams",
        F.lit(True).alias("kept"),
        *(F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)),
    ).schema
    return source.mapInArrow(run, schema)
