"""Document fingerprints: a threshold-scaled sketch of word shingles, by DataFrame functions only.

Every distinct shingle is hashed (64 bits, as hex digits that sort like the number). A sketch keeps every hash
below a fixed fraction of the hash space; a text with fewer than `LEAST` of those keeps its `LEAST` smallest hashes,
so short texts still have one. `below` says up to which value the sketch is complete. Two sketches are comparable
below the lower of their bounds, whatever the lengths of their texts, and so is their union: sketches merge
without the texts.

As a string a sketch is its bound, a colon, and its hashes in ascending order, 16 digits each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import stage

WIDTH = 5  # words of a shingle
FRACTION = "2"  # hashes below this hex digit are kept: one eighth of the hash space
LEAST = 32  # hashes that every longer sketch keeps
DIGITS = 16
ALL = "~"  # above every hash: the sketch holds the whole set
_PART_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_sketch(df: DataFrame, text: str, name: str, width: int = WIDTH, least: int = LEAST) -> DataFrame:
    """`df` with the sketch of a text column: struct(below, hashes).

    Words are runs of other characters than ASCII white space, as written. Fewer than `width` words are one shingle;
    null, empty and blank texts have none, and an empty sketch. Equal texts have equal sketches.
    """
    words, hashes, low, every = (f"{name} {x}" for x in ("words", "hashes", "low", "every"))

    def digits(run: Column) -> Column:
        return F.left(F.md5(F.array_join(run, " ")), F.lit(DIGITS))

    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(1), n - width + 1), lambda i: digits(F.slice(F.col(words), i, width)))
    none = F.array().cast("array<string>")
    stepped = (
        df.withColumn(words, F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
        .withColumn(
            hashes, F.when(n >= width, runs).when(n > 0, F.array(digits(F.col(words)))).otherwise(none)
        )
        .withColumn(low, F.sort_array(F.array_distinct(F.filter(hashes, lambda h: h < FRACTION))))
        # Only texts with few hashes below the fraction need all of theirs in order.
        .withColumn(every, F.when(F.size(low) < least, F.sort_array(F.array_distinct(hashes))).otherwise(none))
    )
    last = F.get(every, F.lit(least - 1))
    sketch = (
        F.when(F.size(low) >= least, F.struct(F.lit(FRACTION).alias("below"), F.col(low).alias("hashes")))
        .when(F.size(every) <= least, F.struct(F.lit(ALL).alias("below"), F.col(every).alias("hashes")))
        .otherwise(F.struct(F.concat(last, F.lit(ALL)).alias("below"), F.slice(every, 1, least).alias("hashes")))
    )
    return stepped.withColumn(name, sketch).drop(words, hashes, low, every)


def as_text(sketch: Column) -> Column:
    return F.concat(sketch["below"], F.lit(":"), F.array_join(sketch["hashes"], ""))


def packed(sketch: Column) -> Column:
    """A sketch as struct(below, bytes), with eight bytes for a hash, to be moved and stored."""
    return F.struct(sketch["below"].alias("below"), F.unhex(F.array_join(sketch["hashes"], "")).alias("bytes"))


def unpacked(packed_sketch: Column) -> Column:
    """struct(below, hashes) of a packed sketch."""
    raw = packed_sketch["bytes"]
    n = (F.octet_length(raw) / 8).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(at, lambda i: F.lower(F.hex(F.substring(raw, i * 8 + 1, F.lit(8)))))
    return F.struct(packed_sketch["below"].alias("below"), hashes.alias("hashes"))


def _comparable(a: Column, b: Column) -> tuple[Column, Column, Column]:
    below = F.least(a["below"], b["below"])
    return below, *(F.filter(s["hashes"], lambda h: h < below) for s in (a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1; of two empty sets 1."""
    _, x, y = _comparable(a, b)
    both = F.size(F.array_intersect(x, y))
    return F.coalesce(F.try_divide(both, F.size(x) + F.size(y) - both), F.lit(1.0))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of `a` that `b` holds, 0 to 1; of an empty set 1."""
    _, x, y = _comparable(a, b)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)), F.size(x)), F.lit(1.0))


def merged(a: Column, b: Column) -> Column:
    """The sketch of the union of two shingle sets, complete below the lower bound."""
    below, x, y = _comparable(a, b)
    return F.struct(below.alias("below"), F.sort_array(F.array_union(x, y)).alias("hashes"))


def _with_previous(keys: DataFrame) -> DataFrame:
    """`keys` (key, doc_id, n_chars, copies) with the key and n_chars of the row before in the order of (doc_id, key),
    nulls last; before the first comes the last.

    Rows are sorted in ranges and written with their place; one row per range then says where each one starts.
    """
    placed = keys.repartitionByRange(F.col("doc_id").asc_nulls_last(), "key")
    placed = placed.sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "key")
    placed = stage(placed.withColumn("at", F.monotonically_increasing_id()), "fingerprint-order")
    part = F.shiftright("at", _PART_BITS)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    starts = starts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    row = F.col("at").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    numbered = placed.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("at", F.col("start") + row)
    total = placed.count()
    after = numbered.select(
        F.pmod(F.col("at") + 1, F.lit(max(1, total))).alias("at"),
        F.col("key").alias("before_key"),
        F.col("n_chars").alias("before_chars"),
    )
    return numbered.drop("part", "start").join(after, "at").drop("at")


def fingerprint_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, least: int = LEAST
) -> DataFrame:
    """One row per row of `docs`: its sketch, and that of its text with an edited end.

    The last floor(n_chars / 4) code points are replaced by the first as many (or all) of the next document by
    ascending id (after the last: the first). Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next (`likeness`), contained_edited, contained_next (`containment`).

    Null texts count as empty. Null ids come last; rows with equal ids follow each other by a digest of their text,
    and rows that agree in both come one after the other. Other columns are ignored. An empty table gives an empty
    result; a single document is its own next.

    Whole texts are shuffled once, by a digest of the row, next to their places in the order, which are found on
    digests and lengths alone; of a text only the start that its predecessor needs is sent to it, with the sketch.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.col(id_col).isNull().cast("string"), own, text))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), key.alias("key"))

    keys = rows.select("key", "doc_id", F.char_length("text").alias("n_chars")).groupBy("key")
    keys = keys.agg(F.min("doc_id").alias("doc_id"), F.min("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    keys = stage(_with_previous(keys), "fingerprint-neighbours")

    copy = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    texts = with_sketch(rows.select("key", "text"), "text", "sketch", width, least)
    texts = texts.withColumn("sketch", packed(F.col("sketch"))).withColumn("copy", copy)
    placed = texts.join(keys, "key")
    sent = placed.filter("copy >= copies").select(  # one row per key; as the other side has it, so the shuffle is shared
        F.col("before_key").alias("key"),
        F.expr("left(text, before_chars div 4)").alias("next_start"),
        F.col("sketch").alias("next_sketch"),
    )
    last = F.col("copy") == F.col("copies")
    start = F.when(last, F.col("next_start")).otherwise(F.expr("left(text, n_chars div 4)"))
    joined = placed.join(sent, "key").select(
        "doc_id",
        "n_chars",
        F.concat(F.expr("left(text, n_chars - n_chars div 4)"), start).alias("edited"),
        "sketch",
        F.when(last, F.col("next_sketch")).otherwise(F.col("sketch")).alias("next_sketch"),
    )
    done = with_sketch(joined, "edited", "edited_sketch", width, least)
    done = done.withColumns({c: unpacked(F.col(c)) for c in ("sketch", "next_sketch")})
    sketch, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return done.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(sketch).alias("fingerprint"),
        as_text(edited).alias("edited_fingerprint"),
        likeness(sketch, edited).alias("near_edited"),
        likeness(sketch, following).alias("near_next"),
        containment(sketch, edited).alias("contained_edited"),
        containment(sketch, following).alias("contained_next"),
    )
