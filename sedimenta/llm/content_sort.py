"""Exact dedup by a content sort: equal texts become neighbours and one row of each group stays.

Splitters sampled by Spark cut the normalised texts into ranges, every range is sorted outside
memory, and rows are grouped by comparing whole neighbouring texts. Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import stage

BLANKS = r"[\x20\x09-\x0D]+"
PREFIX = 16  # characters of a text that take part in the range key, so that splitters stay small


def normalised(text):
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space. Of a group stays the row with the most
    code points in its original text, then the smallest id (null ids last); of rows that agree
    in both, any one. Null texts count as empty, and all empty texts form one group. Other
    columns are ignored. An empty table gives an empty result.

    The range key is (first characters, 64-bit hash, salt). Texts with more than one row in
    `4 * partitions` are salted by their id, so that a hot group is sorted by many tasks; there
    are fewer than `4 * partitions` of them, which bounds the broadcast. The heads of their
    parts (at most one per group and salt) are then compared as whole texts once more.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("n"),
        normalised(F.col(text_col)).alias("norm"),
    ).withColumn("hash", F.xxhash64("norm"))
    many = max(1, docs.count() // (4 * parts))
    hot = rows.groupBy("hash").count().filter(F.col("count") > many).select("hash", F.lit(True).alias("hot"))
    tagged = rows.join(F.broadcast(hot), "hash", "left").select(
        "doc_id",
        "n",
        "norm",
        "hash",
        F.coalesce("hot", F.lit(False)).alias("hot"),
        F.left("norm", F.lit(PREFIX)).alias("prefix"),
        F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(parts))).otherwise(F.lit(0)).alias("salt"),
    )
    ranged = tagged.repartitionByRange(parts, "prefix", "hash", "salt")
    group = Window.partitionBy("prefix", "hash", "salt", "norm").orderBy(
        F.col("n").desc(), F.col("doc_id").asc_nulls_last()
    )
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.row_number().over(group) == 1
    sorted_rows = ranged.select(
        "doc_id",
        "hot",
        "salt",
        "norm",
        F.sha2("norm", 256).alias("text_sha256"),
        F.first("doc_id").over(whole).alias("keep_id"),
        F.first("n").over(whole).alias("keep_n"),
        F.count(F.lit(1)).over(whole).alias("group_size"),
        first.alias("kept"),
    ).withColumn("norm", F.when(F.col("hot") & F.col("kept"), F.col("norm")))
    done = stage(sorted_rows, "content-sort")

    best = Window.partitionBy("norm").orderBy(F.col("keep_n").desc(), F.col("keep_id").asc_nulls_last(), "salt")
    over = best.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = done.filter(F.col("hot") & F.col("kept")).select(
        "text_sha256",
        "salt",
        F.first("keep_id").over(over).alias("head_id"),
        F.sum("group_size").over(over).alias("head_size"),
        (F.row_number().over(best) == 1).alias("head_kept"),
    )
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    salted = (
        done.filter("hot")
        .join(heads, ["text_sha256", "salt"])
        .select(
            "doc_id",
            F.col("head_id").alias("keep_id"),
            F.col("head_size").alias("group_size"),
            (F.col("kept") & F.col("head_kept")).alias("kept"),
            "text_sha256",
        )
    )
    return done.filter(~F.col("hot")).select(*out).unionByName(salted)
