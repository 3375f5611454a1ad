"""Token files: ids of documents in blocks of a static range asymmetric numeral system.

All blocks share one frequency table. A block holds whole documents, is coded by interleaved lanes, can be
read without any other block, and carries checkpoints (the state of all lanes and the place in the
word stream) from which decoding can start in the middle. Files are written by Spark, as rows of
(part, block, ids before the block, document index, payload, checksums), in ascending order of doc_id.

    path/blocks   one file per part; parts follow each other in the order of doc_id
    path/parts    ids before each part (one row per part)
    path/table    frequencies of the ids, scaled to a power of two (one row)
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.llm.tokens import tokenizer
from sedimenta.session import new_path, stage

SCALE_BITS = 20
LOW_BITS = 31  # a lane's state lies in [2^31, 2^63) between symbols
LANES = 1024
BLOCK_IDS = 1 << 19
CHECKPOINT_STEPS = 256


def scale(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that sum to 2^bits, at least 1 for each id that occurs."""
    total, seen = int(counts.sum()), counts > 0
    target = 1 << bits
    if not total:
        return np.zeros(len(counts), np.int64)
    if int(seen.sum()) > target:
        raise ValueError("more distinct ids than the frequency table has room for")
    freq = np.where(seen, np.maximum(1, np.floor(counts.astype(float) * (target / total))), 0).astype(np.int64)
    over = int(freq.sum()) - target
    order = np.argsort(-freq, kind="stable")
    if over < 0:
        freq[order[0]] -= over
    for i in order:
        if over <= 0:
            break
        take = min(over, int(freq[i]) - 1)
        freq[i] -= take
        over -= take
    return freq


@dataclass(frozen=True)
class Coder:
    """Encoder and decoder for one frequency table."""

    freq: np.ndarray
    start: np.ndarray
    symbol: np.ndarray | None

    @staticmethod
    def of(freq: np.ndarray, decode: bool) -> Coder:
        start = np.concatenate([[0], np.cumsum(freq)[:-1]])
        symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq) if decode else None
        return Coder(freq.astype(np.uint64), start.astype(np.uint64), symbol)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(words, checkpoints) of a block. Checkpoint k stands before step k * CHECKPOINT_STEPS.

        Steps are coded from the last to the first, so a decoder meets them in order. The last
        step is filled up with the block's last id.
        """
        if not len(ids):
            return b"", b""
        steps = -(-len(ids) // LANES)
        table = np.full(steps * LANES, ids[-1], np.int64)
        table[: len(ids)] = ids
        table = table.reshape(steps, LANES)
        state = np.full(LANES, 1 << LOW_BITS, np.uint64)
        words: list[np.ndarray] = []
        written, marks = 0, []
        shift = np.uint64(LOW_BITS - SCALE_BITS + 32)
        bits, word, low = np.uint64(SCALE_BITS), np.uint64(32), np.uint64(0xFFFFFFFF)
        for k in range(steps - 1, -1, -1):
            f, c = self.freq[table[k]], self.start[table[k]]
            over = state >= f << shift
            out = state[over]
            if len(out):
                words.append((out & low).astype("<u4"))
                written += len(out)
                state[over] = out >> word
            whole = state // f
            state = (whole << bits) + (state - whole * f) + c
            if k % CHECKPOINT_STEPS == 0:
                marks.append((written, state.copy()))
        marks = [np.concatenate([[np.uint64(written - w)], s]).astype("<u8") for w, s in reversed(marks)]
        return b"".join(x.tobytes() for x in reversed(words)), b"".join(x.tobytes() for x in marks)

    def decode(self, words: bytes, checkpoints: bytes, n: int, first: int = 0) -> np.ndarray:
        """The ids of a block from checkpoint `first` on, `n` being the number of all its ids."""
        if not n:
            return np.zeros(0, np.uint32)
        stream = np.frombuffer(words, "<u4").astype(np.uint64)
        mark = np.frombuffer(checkpoints, "<u8").reshape(-1, LANES + 1)[first]
        at, state = int(mark[0]), mark[1:].astype(np.uint64)
        steps = -(-n // LANES) - first * CHECKPOINT_STEPS
        out = np.empty((steps, LANES), np.uint32)
        bits, word = np.uint64(SCALE_BITS), np.uint64(32)
        mask, least = np.uint64((1 << SCALE_BITS) - 1), np.uint64(1 << LOW_BITS)
        for k in range(steps):
            slot = state & mask
            ids = self.symbol[slot]
            out[k] = ids
            state = self.freq[ids] * (state >> bits) + slot - self.start[ids]
            under = state < least
            m = int(np.count_nonzero(under))
            if m:
                state[under] = (state[under] << word) | stream[at : at + m]
                at += m
        return out.reshape(-1)[: n - first * CHECKPOINT_STEPS * LANES]


SLICE = 1024  # rows that a task holds at once


def narrow(ids: bytes) -> bytes:
    """The same ids (little-endian unsigned 32-bit) in 16 bits each, where they fit."""
    wide = np.frombuffer(ids, "<u4")
    return wide.astype("<u2").tobytes() if len(wide) and int(wide.max()) < 1 << 16 else ids


def widen(ids: bytes, n: int) -> np.ndarray:
    """`n` ids as they were before `narrow`."""
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")


def tokenise(
    docs: DataFrame, vocabulary: str, end_id: int, byte_level: bool, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n and ids of every row, ended by `end_id`, in 16 bits each where they fit; null text is empty."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = tokenizer(vocabulary, byte_level).ids
        for batch in batches:
            for s in range(0, batch.num_rows, SLICE):
                part = batch.slice(s, SLICE)
                found = [x + end for x in ids(t.as_py() for t in part.column(1))]
                n = pa.array([len(x) // 4 for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), n, pa.array(map(narrow, found), pa.binary())], names=["doc_id", "n", "ids"]
                )

    return rows.mapInArrow(run, f"doc_id {kind}, n long, ids binary")


def _count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        for s in range(0, batch.num_rows, SLICE):
            part = batch.slice(s, SLICE)
            n, ids = int(pc.sum(part.column(0)).as_py() or 0), part.column(1)
            if pc.sum(pc.binary_length(ids)).as_py() == 2 * n:  # all of them in 16 bits: one array
                offsets = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
                found = np.frombuffer(ids.buffers()[2], "<u2", n, int(offsets[0]))
            else:
                found = np.concatenate([widen(x.as_py(), n) for n, x in zip(part.column(0).to_pylist(), ids)])
            more = np.bincount(found)
            if len(more) > len(counts):
                counts, more = more, counts
            counts[: len(more)] += more
    seen = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], names=["id", "n"])


def write_token_file(tokens: DataFrame, path: str) -> None:
    """Write the ids of all rows (doc_id, n, ids) in ascending order of doc_id, null first, ties by their ids.

    The frequency table has at most as many rows as the vocabulary has ids. Parts are ranges of doc_id; within a
    part a task streams through its rows and keeps one block in memory (`BLOCK_IDS` ids, or one
    document if that is longer).
    """
    spark = tokens.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = stage(tokens.select("doc_id", "n", "ids"), "token-ids")
    kind = staged.schema["doc_id"].dataType.simpleString()
    rows = staged.select("n", "ids").mapInArrow(_count_ids, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = {r.id: r.n for r in rows.collect()}
    counts = np.zeros(max(found, default=0) + 1, np.int64)
    counts[list(found)] = list(found.values())
    freq = scale(counts)
    table = spark.createDataFrame([(SCALE_BITS, bytearray(freq.astype("<u4").tobytes()))], "bits int, freq binary")
    table.coalesce(1).write.parquet(f"{path}/table")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.of(freq, decode=False)
        part = TaskContext.get().partitionId()
        names: list = []
        held: list[np.ndarray] = []
        size, block, before = 0, 0, 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held).astype("<u4")
            words, marks = coder.encode(ids)
            lengths = list(map(len, held))
            return pa.record_batch(
                {
                    "part": pa.array([part], pa.int32()),
                    "block": pa.array([block], pa.int32()),
                    "ids_before": pa.array([before], pa.int64()),
                    "n_ids": pa.array([len(ids)], pa.int64()),
                    "doc_ids": pa.array([names], pa.list_(doc_type)),
                    "lengths": pa.array([lengths], pa.list_(pa.int64())),
                    "words": pa.array([words], pa.binary()),
                    "checkpoints": pa.array([marks], pa.binary()),
                    "stored_crc32": pa.array([zlib.crc32(marks, zlib.crc32(words))], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids)], pa.int64()),
                }
            )

        doc_type = pa.int64()
        for batch in batches:
            doc_type = batch.schema.field(0).type
            for name, n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                names.append(name)
                held.append(widen(ids.as_py(), n))
                size += n
                if size >= BLOCK_IDS:
                    yield flush()
                    names, held, block, before, size = [], [], block + 1, before + size, 0
        if held:
            yield flush()

    schema = (
        f"part int, block int, ids_before long, n_ids long, doc_ids array<{kind}>, lengths array<long>, "
        "words binary, checkpoints binary, stored_crc32 long, ids_crc32 long"
    )
    ranged = staged.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "ids"
    )
    ranged.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(f"{path}/blocks")

    blocks = spark.read.schema(schema).parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_before")).coalesce(1).write.parquet(
        f"{path}/parts"
    )


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids. Checksums of every block are verified."""
    row = spark.read.parquet(f"{path}/table").head()
    freq = np.frombuffer(row.freq, "<u4")
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = spark.read.parquet(f"{path}/parts")  # one row per file
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    source = blocks.join(F.broadcast(parts), "part").select(
        (F.col("part_before") + F.col("ids_before")).alias("before"),
        "n_ids",
        "doc_ids",
        "lengths",
        "words",
        "checkpoints",
        "stored_crc32",
        "ids_crc32",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.of(freq, decode=True)
        for batch in batches:
            for i in range(batch.num_rows):
                before, n, names, lengths, words, marks, stored, crc = (c[i] for c in batch.columns)
                words, marks = words.as_py(), marks.as_py()
                if zlib.crc32(marks, zlib.crc32(words)) != stored.as_py():
                    raise ValueError("a block of the token file is damaged")
                ids = coder.decode(words, marks, n.as_py()).astype("<u4")
                if zlib.crc32(ids) != crc.as_py():
                    raise ValueError("a block of the token file does not decode to what was written")
                length = np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(length)
                found = [ids[e - k : e].tobytes() for e, k in zip(ends.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        names.values,
                        pa.array(before.as_py() + ends - length, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(found, pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return source.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary")


def new_token_file(spark: SparkSession) -> str:
    """A fresh path in the shared folder."""
    return new_path(spark, "token-file")
