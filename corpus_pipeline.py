"""From raw documents to packed sequences: five stages, each one written before the next reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.llm.content_sort import content_sort, normalised
from sedimenta.llm.language_id import identify
from sedimenta.llm.packing import pack_documents
from sedimenta.llm.quality_rules import apply_policy, ledger
from sedimenta.llm.queries import share_code
from sedimenta.llm.signature_trees import jaccard_components
from sedimenta.plans.registry import table
from sedimenta.session import stage

POLICY = "prose-1"
VOCABULARY = "byte_bpe_50k.json"
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80  # near duplicates of the pipeline


def free(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def row_key() -> Column:
    """What tells rows apart even where doc_id is null or repeated; rows that agree in it are the same document."""
    return F.struct("doc_id", F.xxhash64("text").alias("text"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the policy. Null and empty texts go."""
    row = free(docs, "row")
    rows = docs.withColumn(row, F.struct(*docs.columns))
    return apply_policy(ledger(rows, carry=row), POLICY).filter("kept").select(f"{row}.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, whatever they declare."""
    key = free(docs, "key")
    keyed = docs.withColumn(key, F.struct(row_key().alias("row"), "lang", "source"))  # all that a decision depends on
    kept = identify(keyed, carry=(key,)).filter("kept").select(key).distinct()
    return keyed.join(kept, key, "left_semi").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that `content_sort` keeps. Of rows that repeat a kept one under its id, the longest stays."""
    key, rank = free(docs, "key"), free(docs, "rank")
    same = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text_sha256"))
    kept = content_sort(docs).filter("kept").select(same.alias(key))
    digest = F.sha2(normalised(F.col("text")), 256)
    keyed = docs.withColumn(key, F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), digest))
    longest = Window.partitionBy(key).orderBy(F.char_length("text").desc_nulls_last(), F.col("text").asc_nulls_last())
    ranked = keyed.join(kept, key, "left_semi").withColumn(rank, F.row_number().over(longest))
    return ranked.filter(F.col(rank) == 1).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of linked documents (five-word shingles, similarity 0.8) the one with the smallest id;
    documents without words stay."""
    key = free(docs, "key")
    keyed = docs.withColumn(key, row_key())
    groups = jaccard_components(keyed, id_col=key, width=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    kept = groups.filter("doc_id <=> component_id").select(F.col("doc_id").alias(key))
    return keyed.join(kept.distinct(), key, "left_semi").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality", quality),
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]
# Components of links, subset sums and tokenizers are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    share_code(spark)
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
