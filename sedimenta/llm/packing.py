"""Packing of documents into token sequences with the least slack per sequence.

Documents longer than a sequence are cut; what is left over is packed whole. Only the number of pieces of
each length matters for that, at most `capacity` counts, so the driver solves the packing on the counts: it
fills one sequence after another by a subset-sum search over the remaining lengths, and uses each
multiset of lengths as often as its counts allow. Pieces then find their place by their rank among
the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.ppm import give_back
from sedimenta.llm.tokens import tokenizer
from sedimenta.session import stage

CAPACITY = 2048


def tokenise(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of every row; null text is empty, each ends with `end_id`."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = tokenizer(vocabulary, True).ids
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):  # rows that a task holds at once
                part = batch.slice(s, 1024)
                found = [x + end for x in ids(t.as_py() for t in part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], names=["doc_id", "ids"])
        give_back()

    return rows.mapInArrow(run, f"doc_id {kind}, ids binary")


def cut(tokens: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most `capacity` ids: doc_id, start, length, ids_crc32, doc_tokens. No ids, no piece."""
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, start, length, crc, total = [], [], [], [], []
            for i, ids in enumerate(batch.column(1)):
                view = memoryview(ids.as_py() or b"")
                n = len(view) // 4
                for s in range(0, n, capacity):
                    e = min(n, s + capacity)
                    at.append(i)
                    start.append(s)
                    length.append(e - s)
                    crc.append(zlib.crc32(view[4 * s : 4 * e]))
                    total.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in (start, length, crc, total))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    return tokens.select("doc_id", "ids").mapInArrow(run, schema)


def padding(total: int, capacity: int) -> int:
    """A sequence is filled up to `capacity`, except at a power of two."""
    return 0 if total & (total - 1) == 0 else capacity - total


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """A multiset of the remaining lengths, with the longest in it, that leaves the least padding.

    Bit s of a set tells that the sum s can be reached. Copies of a length enter as 1, 2, 4, ... at
    once; the sets before each step are kept to track back which steps led to the chosen sum.
    """
    longest = max(counts)
    room = capacity - longest
    full = (1 << room + 1) - 1
    reach, steps = 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left = min(counts[length] - (length == longest), room // length)
        copies = 1
        while left > 0:
            copies = min(copies, left)
            steps.append((length, copies, reach))
            reach |= reach << length * copies & full
            left -= copies
            copies *= 2
        if reach >> room & 1:
            break
    sums = [s for s in range(room, -1, -1) if reach >> s & 1][:1] + [
        s for s in ((1 << k) - longest for k in range(capacity.bit_length())) if 0 <= s <= room and reach >> s & 1
    ]
    rest = min(sums, key=lambda s: (padding(longest + s, capacity), -s))
    window = {longest: 1}
    for length, copies, before in reversed(steps):
        if not before >> rest & 1:
            window[length] = window.get(length, 0) + copies
            rest -= length * copies
    return window


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(multiset of lengths, number of sequences with it), using up all counts."""
    counts, out = {n: c for n, c in counts.items() if c}, []
    while counts:
        window = fill_window(counts, capacity)
        times = min(counts[n] // k for n, k in window.items())
        out.append((window, times))
        for n, k in window.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
    return out


def places(windows: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length rows (first rank, pieces per sequence, first sequence, offset), in the order of ranks."""
    used: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for window, times in windows:
        offset = 0
        for length in sorted(window, reverse=True):
            k = window[length]
            rows.setdefault(length, []).append((used.get(length, 0), k, sequence, offset))
            used[length] = used.get(length, 0) + k * times
            offset += k * length
        sequence += times
    return {n: np.array(r, np.int64) for n, r in rows.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (with a positive `length` up to `capacity`, told apart by all their columns) plus
    sequence_id and offset.

    Every piece gets one place; places of a sequence follow each other from 0 without gaps.
    Ranks among the pieces of a length are counted per (length, bucket), so that no length is
    numbered by one task; the counts, at most capacity x partitions, give each bucket's first rank.
    An empty table stays empty.
    """
    spark = pieces.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = pieces.columns
    staged = stage(pieces.withColumn("_bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")), "pieces")
    counts = stage(staged.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")), "lengths")
    lengths = counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # at most `capacity` rows
    table = places(plan({r.length: r.n for r in lengths}, capacity))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("length", "_bucket").orderBy(*columns)
    ranked = (
        staged.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(first, ["length", "_bucket"])
        .select(*columns, (F.col("_first") + F.col("_rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    )
    at = columns.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(at).to_numpy(zero_copy_only=False)
            rank = batch.column(len(columns)).to_numpy(zero_copy_only=False)
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for n in np.unique(length).tolist():
                own = length == n
                ranks = rank[own]
                r = table[n][np.searchsorted(table[n][:, 0], ranks, "right") - 1]
                nth = ranks - r[:, 0]
                sequence[own] = r[:, 2] + nth // r[:, 1]
                offset[own] = r[:, 3] + nth % r[:, 1] * n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array(sequence), pa.array(offset)], names=batch.schema.names
            )

    return ranked.mapInArrow(place, ranked.schema)


def sequences(tokens: DataFrame, placed: DataFrame, pad_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens without padding, ids with padding. Needs unique doc_ids."""
    pad = np.array([pad_id], "<u4").tobytes().hex()
    piece = F.substring("ids", F.col("start") * 4 + 1, F.col("length") * 4)
    n = F.col("n_tokens")
    fill = F.when(n.bitwiseAND(n - 1) == 0, F.lit(0)).otherwise(F.lit(capacity) - n)
    return (
        placed.join(tokens.select("doc_id", "ids"), "doc_id")
        .select("sequence_id", "offset", "length", F.hex(piece).alias("hex"))
        .groupBy("sequence_id")  # at most `capacity` ids
        .agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "hex"))).alias("parts"))
        .select(
            "sequence_id",
            "n_tokens",
            F.unhex(F.concat(F.array_join(F.col("parts.hex"), ""), F.repeat(F.lit(pad), fill.cast("int")))).alias("ids"),
        )
    )


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text is empty and has only its end id. Rows that repeat an id are packed each.
    Other columns are ignored; a null id is kept.
    """
    return pack(cut(tokenise(docs, vocabulary, end_id), capacity), capacity)
