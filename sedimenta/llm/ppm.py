"""Scoring of texts by prediction by partial matching over bytes.

The trie of byte contexts is a table of grams: `ORDER` context bytes and the byte that follows, as one
integer, with the number of times it occurs in training texts. Shorter contexts are suffixes of longer
ones, so their counts are sums over the same table. A byte that a context has not seen is coded by an
escape to the next shorter context, in which the bytes seen before are excluded. The code length of a
gram depends on nothing but the gram, so it is computed once per distinct gram, and documents add up
what their grams cost.

Spark deals the texts into chunks of some megabytes. A task counts the grams and words of its chunk, tables
are merged by grouped aggregation, grams are valued where those with equal two last context bytes
meet, and every chunk gets back the values of its own grams and words.
"""

from __future__ import annotations

import ctypes
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import stage

ORDER = 5
END = 0xFF  # never a byte of UTF-8: ends a text, and fills the context before its beginning
CHUNK_BYTES = 8 << 20
SYMBOLS = 256


def give_back() -> None:
    """Return freed memory to the system, so that a worker that waits for its next task does not hold it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


def canonical(text: str | None) -> bytes:
    """Words in lower case (A-Z only) with one blank between them."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every byte and of the end of each text, and the number of grams of each text."""
    pad = bytes([END]) * order
    data = np.frombuffer(pad + pad.join(texts) + pad, np.uint8).astype(np.int64)
    n = len(data) - order
    packed = np.zeros(n, np.int64)
    for k in range(order + 1):
        packed <<= 8
        packed |= data[k : k + n]
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    keep = np.ones(n, bool)
    ends = np.cumsum(sizes + order - 1)[:-1] if order > 1 else np.zeros(0, np.int64)
    for k in range(1, order):  # fillers behind the end of a text are context only
        keep[ends - k] = False
    return packed[keep][: int(sizes.sum())], sizes


class Level:
    """Contexts of one order: counts of grams, totals and distinct symbols of contexts."""

    def __init__(self, packed: np.ndarray, counts: np.ndarray, order: int):
        mask = (1 << 8 * (order + 1)) - 1
        seen = counts > 0
        keys = packed[seen] & mask
        by = np.argsort(keys, kind="stable")
        keys, counts = keys[by], counts[seen][by]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.grams = keys[first]
        self.counts = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
        heads = self.grams >> 8
        self.begin = np.flatnonzero(np.concatenate([[True], heads[1:] != heads[:-1]])) if len(heads) else first
        self.contexts = heads[self.begin]
        self.totals = self.of_contexts(self.counts)
        self.kinds = np.diff(np.concatenate([self.begin, [len(heads)]]))
        self.excluded = np.zeros(len(self.contexts), np.int64)  # what its symbols count one order below

    def of_contexts(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.begin) if len(self.begin) else np.zeros(0, np.int64)

    def exclude(self, below: np.ndarray) -> None:
        self.excluded = self.of_contexts(below)


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, whether it is there) of each key."""
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return at, (sorted_keys[at] == keys) if len(sorted_keys) else np.zeros(len(keys), bool)


def low_counts(packed: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counts of (last byte, symbol): 65,536 numbers at any size of the corpus."""
    return np.bincount(packed & 0xFFFF, weights=counts, minlength=1 << 16).astype(np.int64)


def values(packed: np.ndarray, counts: np.ndarray, low: np.ndarray, order: int = ORDER) -> np.ndarray:
    """log10 of the probability of each distinct gram.

    `packed` must hold all grams of the corpus that share their two last context bytes with one in it;
    `low` is `low_counts` of the whole corpus. A symbol seen c times among n (d kinds of them) costs
    (2c - 1) / 2n and an escape d / 2n, n and d without the excluded symbols.
    """
    pairs = low.reshape(SYMBOLS, SYMBOLS)
    single = pairs.sum(axis=0)
    levels = {j: Level(packed, counts, j) for j in range(order, 1, -1)}
    for j, level in levels.items():
        if j > 2:
            below = levels[j - 1]
            at, there = find(below.grams, level.grams & ((1 << 8 * j) - 1))
            level.exclude(np.where(there, below.counts[at] if len(below.counts) else 0, 0))
        else:
            level.exclude(low[level.grams & 0xFFFF])
    out = np.zeros(len(packed))
    open_ = np.ones(len(packed), bool)
    gone, kinds_gone = np.zeros(len(packed), np.int64), np.zeros(len(packed), np.int64)

    def step(c, n, d, met, excluded) -> None:
        """One order: c of the symbol, n and d of its context (0: context not met), what it excludes below."""
        nonlocal gone, kinds_gone
        total, kinds = n - gone, d - kinds_gone
        live = open_ & met & (total > 0)
        hit = live & (c > 0)
        out[hit] += np.log10((2 * c[hit] - 1) / (2 * total[hit]))
        miss = live & (c == 0)
        out[miss] += np.log10(kinds[miss] / (2 * total[miss]))
        open_[hit] = False
        gone = np.where(met, excluded, gone)
        kinds_gone = np.where(met, d, kinds_gone)

    for j, level in levels.items():
        own = packed & ((1 << 8 * (j + 1)) - 1)
        at, met = find(level.contexts, own >> 8)
        where, there = find(level.grams, own)
        none = np.zeros(len(packed), np.int64)
        pick = lambda a, i, ok: np.where(ok, a[i], 0) if len(a) else none
        step(
            pick(level.counts, where, there),
            pick(level.totals, at, met),
            pick(level.kinds, at, met),
            met,
            pick(level.excluded, at, met),
        )
    head, symbol = packed >> 8 & 0xFF, packed & 0xFF
    n1, d1 = pairs.sum(axis=1), (pairs > 0).sum(axis=1)
    e1 = (np.where(pairs > 0, single[None, :], 0)).sum(axis=1)
    step(pairs[head, symbol], n1[head], d1[head], n1[head] > 0, e1[head])
    n0, d0 = int(single.sum()), int((single > 0).sum())
    ones = np.ones(len(packed), np.int64)
    step(single[symbol], n0 * ones, d0 * ones, ones * n0 > 0, 0 * ones)
    out[open_] -= np.log10(SYMBOLS - d0) if d0 < SYMBOLS else 0.0
    return out


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their counts summed."""
    keys = np.concatenate([k for k, _ in parts]) if parts else np.zeros(0, np.int64)
    counts = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, np.int64)
    by = np.argsort(keys, kind="stable")
    keys, counts = keys[by], counts[by]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def slices(texts: list[bytes], size: int = 1 << 20, most: int = 1 << 15) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes and at most `most` texts."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size or i + 1 - begin == most:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def restore(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences."""
    return squeeze(np.diff(keys, prepend=0).astype("<i8").tobytes())


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(restore(data), "<i8"))


def gram_bucket(packed: np.ndarray, buckets: int) -> np.ndarray:
    mixed = packed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(33)).astype(np.int64) % buckets


def word_order(words) -> np.ndarray:
    """Distinct words in the order in which a chunk asks for them inside a bucket."""
    distinct = sorted(set(words))
    out = np.empty(len(distinct), object)
    out[:] = distinct
    return out


def word_bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets


def by_bucket(of: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(order by bucket, buckets, span of each bucket in that order)."""
    by = np.argsort(of, kind="stable")
    found, begin = np.unique(of[by], return_index=True)
    return by, found, list(zip(begin.tolist(), [*begin[1:].tolist(), len(of)]))


def _chunk_rows(texts: list[bytes], ids: list, held: list[bool], chunk: int, buckets: int, order: int, id_type):
    """The record batches of one chunk: its documents, its grams and its words by bucket."""

    def rows(kind, bucket, a, b, ids=None, flags=None):
        n = len(a)
        return pa.record_batch(
            [
                pa.array([kind] * n, pa.int32()),
                pa.array([chunk] * n, pa.int64()),
                pa.array(bucket, pa.int32()),
                pa.array(a, pa.binary()),
                pa.array(b, pa.binary()),
                pa.array(ids or [None] * n, pa.list_(id_type)),
                pa.array(flags or [None] * n, pa.list_(pa.bool_())),
            ],
            names=["kind", "chunk", "bucket", "a", "b", "ids", "held"],
        )

    yield rows(0, [0], [squeeze(b"\n".join(texts))], [None], [ids], [held])
    parts = []
    for begin, end in slices(texts):
        for out in (False, True):
            own = [t for t, h in zip(texts[begin:end], held[begin:end]) if h is out]
            if own:
                packed = np.sort(grams(own, order)[0])
                first = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
                n = np.diff(np.concatenate([first, [len(packed)]]))
                parts.append((packed[first], n * (not out)))
    keys, counts = merge(parts)
    by, found, spans = by_bucket(gram_bucket(keys, buckets))
    keys, counts = keys[by], counts[by].astype("<i4")
    yield rows(1, found, [pack_keys(keys[s:e]) for s, e in spans], [squeeze(counts[s:e].tobytes()) for s, e in spans])

    words = Counter()
    for text, out in zip(texts, held):
        if not out:
            words.update(text.split())
    names = word_order(chain.from_iterable(t.split() for t in texts))
    if len(names):
        n = np.fromiter(map(words.__getitem__, names), "<i4", len(names))
        by, found, spans = by_bucket(word_bucket(names, buckets))
        names, n = names[by], n[by]
        yield rows(
            2, found, [squeeze(b" ".join(names[s:e])) for s, e in spans], [squeeze(n[s:e].tobytes()) for s, e in spans]
        )


def _ints(x) -> np.ndarray:
    return np.frombuffer(restore(x.as_py()), "<i4").astype(np.int64)


def _words(x) -> list[bytes]:
    return restore(x.as_py()).split(b" ")


def _answers(kind: int, asked: pa.Table, found: list[bytes]) -> pa.Table:
    """For each row of a bucket what was found for its grams or words, in the order in which it named them.

    Grams go along; words are many more bytes, and a chunk lists its own again in the same order."""
    return pa.table(
        {
            "kind": pa.array([kind] * len(found), pa.int32()),
            "chunk": asked["chunk"],
            "bucket": asked["bucket"],
            "grams": asked["a"] if kind == 1 else pa.nulls(len(found), pa.binary()),
            "found": pa.array(found, pa.binary()),
        }
    )


def gram_scores(texts: list[bytes], keys: np.ndarray, logs: np.ndarray, order: int) -> np.ndarray:
    """What the grams of each text sum up to. Grams are sorted with the number of their text behind
    them, so that looking them up in the sorted `keys` runs through memory in order."""
    packed, sizes = grams(texts, order)
    bits = max(1, (len(texts) - 1).bit_length())
    assert 8 * (order + 1) + bits <= 63
    packed = packed << bits | np.repeat(np.arange(len(texts)), sizes)
    packed.sort()
    text = packed & ((1 << bits) - 1)
    return np.bincount(text, weights=logs[np.searchsorted(keys, packed >> bits)], minlength=len(texts))


def score_texts(
    docs: DataFrame,
    held_out,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts are taken as words (split at ASCII white space) in lower case (A-Z) with one blank between
    them; null counts as empty. Rows for which the column `held_out` is true are scored but not learned
    from (null: learned from). `score` is log10 of the probability of the text and its end. For
    `base_score` the tokens are the words and one end per text, with add-one counts. Rows that repeat an id
    are scored each; other columns are ignored; an empty table gives an empty result.

    Buckets of grams and words follow `spark.sql.shuffle.partitions`: a bucket holds, per chunk,
    each of its grams once, whatever the skew. The only gathered table is that of (last byte, symbol),
    65,536 counts at any size.
    """
    spark = docs.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held")
    )
    kind = source.schema["doc_id"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, ids, held, size = [], [], [], 0
        chunk = TaskContext.get().partitionId() << 24
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for name, text, out in zip(batch.column(0), batch.column(1), batch.column(2)):
                texts.append(canonical(text.as_py()))
                ids.append(name.as_py())
                held.append(out.as_py())
                size += len(texts[-1]) + 1
                if size >= chunk_bytes:
                    yield from _chunk_rows(texts, ids, held, chunk, buckets, order, id_type)
                    texts, ids, held, size, chunk = [], [], [], 0, chunk + 1
                    give_back()
        if texts:
            yield from _chunk_rows(texts, ids, held, chunk, buckets, order, id_type)
        del texts, ids, held
        give_back()

    schema = f"kind int, chunk long, bucket int, a binary, b binary, ids array<{kind}>, held array<boolean>"
    staged = stage(source.mapInArrow(gather, schema), "ppm-chunks")
    wanted = staged.filter("kind = 1").select("chunk", "bucket", "a", "b")

    def total(table: pa.Table) -> pa.Table:
        keys, counts = merge([(unpack_keys(a.as_py()), _ints(b)) for a, b in zip(table["a"], table["b"])])
        return pa.table({"gram": keys, "n": counts})

    trie = stage(wanted.groupBy("bucket").applyInArrow(total, "gram long, n long"), "ppm-trie")
    pairs = trie.groupBy(F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("pair")).agg(F.sum("n").alias("n")).collect()
    low = np.zeros(1 << 16, np.int64)
    for row in pairs:
        low[row.pair] = row.n

    def value(table: pa.Table) -> pa.Table:
        keys, counts = table["gram"].to_numpy(), table["n"].to_numpy()
        return pa.table(
            {"bucket": gram_bucket(keys, buckets).astype(np.int32), "gram": keys, "value": values(keys, counts, low, order)}
        )

    head = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))
    near = F.pmod(F.xxhash64(head), F.lit(2 * buckets))
    valued = trie.groupBy(near).applyInArrow(value, "bucket int, gram long, value double")

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        keys, found = known["gram"].to_numpy(), known["value"].to_numpy()
        by = np.argsort(keys)
        keys, found = keys[by], found[by]
        return _answers(1, asked, [squeeze(found[np.searchsorted(keys, unpack_keys(a.as_py()))].astype("<f4").tobytes()) for a in asked["a"]])

    answers = "kind int, chunk long, bucket int, grams binary, found binary"
    gram_answers = wanted.drop("b").groupBy("bucket").cogroup(valued.groupBy("bucket")).applyInArrow(answer, answers)

    def recount(table: pa.Table) -> pa.Table:
        words: dict[bytes, int] = {}
        rows = [(_words(a), b) for a, b in zip(table["a"], table["b"])]
        for names, b in rows:
            for word, n in zip(names, _ints(b).tolist()):
                words[word] = words.get(word, 0) + n
        out = [squeeze(np.fromiter(map(words.__getitem__, names), "<i8", len(names)).tobytes()) for names, _ in rows]
        known = [n for n in words.values() if n]
        del words, rows
        give_back()
        found = _answers(2, table, out)
        found = found.append_column("n", pa.array([sum(known)] + [0] * (len(out) - 1), pa.int64()))
        return found.append_column("kinds", pa.array([len(known)] + [0] * (len(out) - 1), pa.int64()))

    counted = stage(
        staged.filter("kind = 2")
        .select("chunk", "bucket", "a", "b")
        .groupBy("bucket")
        .applyInArrow(recount, f"{answers}, n long, kinds long"),
        "ppm-words",
    )
    sums = counted.agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds")).head()
    texts = staged.filter("kind = 0").select("chunk", "a", "ids", "held")
    learned = texts.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).head()[0] or 0
    train_tokens = (sums.n or 0) + learned
    spread = float(np.log10(train_tokens + (sums.kinds or 0) + (learned > 0) + 1))

    def score(chunk: pa.Table, found: pa.Table) -> pa.Table:
        bodies = restore(chunk["a"][0].as_py()).split(b"\n")
        order_of = zip(found["kind"].to_pylist(), found["bucket"].to_pylist(), found["grams"], found["found"])
        rows = sorted(order_of, key=lambda r: r[:2])
        keys = np.concatenate([unpack_keys(r[2].as_py()) for r in rows if r[0] == 1])
        by = np.argsort(keys)
        keys = keys[by]
        logs = np.concatenate([np.frombuffer(restore(r[3].as_py()), "<f4") for r in rows if r[0] == 1])[by].astype(float)
        names = word_order(chain.from_iterable(b.split() for b in bodies))
        by, _, _ = by_bucket(word_bucket(names, buckets))
        known = [np.frombuffer(restore(r[3].as_py()), "<i8") for r in rows if r[0] == 2]
        counts = dict(zip(names[by], np.concatenate(known).tolist())) if known else {}
        out = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
        for begin, end in slices(bodies):
            out["score"].append(gram_scores(bodies[begin:end], keys, logs, order))
            seen, tokens = [], []
            for body in bodies[begin:end]:
                words = body.split()
                seen.extend(map(counts.__getitem__, words))
                seen.append(learned)
                tokens.append(len(words) + 1)
            seen, tokens = np.array(seen, np.int64), np.array(tokens, np.int64)
            at = np.cumsum(tokens) - tokens
            out["n_tokens"].append(tokens)
            out["n_known"].append(np.add.reduceat((seen > 0).astype(np.int64), at))
            out["base_score"].append(np.add.reduceat(np.log10(seen + 1.0), at) - tokens * spread)
        joined = {k: np.concatenate(v) for k, v in out.items()}
        n = len(bodies)
        del keys, logs, counts, names, rows, bodies
        give_back()
        return pa.table(
            {
                "doc_id": chunk["ids"].combine_chunks().flatten(),
                "held_out": chunk["held"].combine_chunks().flatten(),
                "n_tokens": joined["n_tokens"],
                "n_known": joined["n_known"],
                "train_tokens": np.full(n, train_tokens, np.int64),
                "base_score": joined["base_score"],
                "score": joined["score"],
            }
        )

    return (
        texts.groupBy("chunk")
        .cogroup(gram_answers.unionByName(counted.select("kind", "chunk", "bucket", "grams", "found")).groupBy("chunk"))
        .applyInArrow(
            score,
            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )
