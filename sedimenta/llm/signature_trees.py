"""N-gram Jaccard join by signature trees.

Documents with equal sets of shingles form a class. Classes hang in a tree: below the root by the rare shingles that
they share, below that by their sizes, in nodes of a few classes that hold the size range and the OR of the token
bitmaps of what is under them.

    rare    Shingles are ordered by the number of classes that hold them. Two linked sets have a shingle in common among
            the rarest of each, size - needed overlap + 1 of them, so only classes that meet there are looked at. A
            passage that many documents share is not among them where the documents have enough of their own.
    nodes   Under one shingle, pairs of nodes are followed downwards as long as the largest overlap that their
            sizes and bitmaps allow suffices for a link.

Pairs that are left are verified on the sets. Only components are asked for, so at first every component, to begin
with every class, is tried with the one that its bitmap resembles most, a few times over. Under the shingles that still
join several components all pairs are looked at, by tasks that hold the sets themselves, skip what links found
before connect, and return only links that connect something.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.bits import bitmap, bits_for, maybe
from sedimenta.llm.components import components
from sedimenta.llm.ppm import give_back
from sedimenta.session import stage

WIDTH = 4
PERCENT = 85
BITMAP_WORDS = 32  # 2,048 bits per class
FANOUT = 16
BLOCK = 512  # classes under one shingle that meet in one task
CHUNK_TOKENS = 1_000_000
ROUNDS = 3
CACHED_WORDS = 300_000

_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found
        return found


_hashes = _WordHashes()


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The distinct hashes of all runs of `width` words, in order; fewer words are one run, none are none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    run = min(n, width)
    step = np.resize(_STEP, run) * (2 * np.arange(1, run + 1, dtype=np.uint64) + np.uint64(1))
    total = np.full(n - run + 1, run, np.uint64)
    for i in range(run):
        total = total + w[i : n - run + 1 + i] * step[i]
    return np.unique(mix(total))


def class_of(tokens: np.ndarray) -> int:
    """The identity of a set, as a signed 64-bit number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def bitmap_of(tokens: np.ndarray, words: int = BITMAP_WORDS) -> np.ndarray:
    at = (tokens >> np.uint64(11)) % np.uint64(64 * words)
    out = np.zeros(64 * words, np.uint8)
    out[at.astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").view("<u8")


def prefix_length(size, percent: int = PERCENT):
    """How many of its rarest shingles a set must show: a linked set holds one of them, among its own rarest ones."""
    return size - -(-size * percent // 100) + 1


def overlap_needed(a, b, percent: int = PERCENT):
    """The smallest overlap with which sets of sizes a and b are linked."""
    return -(-(a + b) * percent // (100 + percent))


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


class Tree:
    """Classes in the order of their sizes, and over them levels of nodes with bitmaps and ranges."""

    def __init__(self, sizes: np.ndarray, bitmaps: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        self.levels = [self.leaves(sizes[self.order], bitmaps[self.order])]
        low, high, least, bits = self.levels[0]
        while len(low) > 1:
            cut = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            least = np.minimum.reduceat(least, cut)
            bits = np.bitwise_or.reduceat(bits, cut, axis=0)
            self.levels.append((low, high, least, bits))

    @staticmethod
    def leaves(sizes: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, ...]:
        """Classes as nodes: (smallest size, largest size, least number of bits, bits)."""
        return sizes, sizes, np.bitwise_count(bits).sum(axis=1).astype(np.int64), bits

    def pairs(self, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
        """Positions of pairs of classes that their sizes and bitmaps let be linked."""
        a = b = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            a, b = self.possible(self.levels[depth], a, b, percent, depth == 0)
            if depth:
                a, b = self._children(a, b, len(self.levels[depth - 1][0]))
        return self.order[a], self.order[b]

    @staticmethod
    def _children(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        k = np.arange(FANOUT)
        left = (a[:, None] * FANOUT + k)[:, :, None] + np.zeros((1, 1, FANOUT), np.int64)
        right = (b[:, None] * FANOUT + k)[:, None, :] + np.zeros((1, FANOUT, 1), np.int64)
        left, right = left.ravel(), right.ravel()
        keep = (left <= right) & (right < n)
        return left[keep], right[keep]

    @staticmethod
    def possible(level, a, b, percent, leaves) -> tuple[np.ndarray, np.ndarray]:
        low, high, least, bits = level
        keep = (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
        if leaves:
            keep &= a != b
        a, b = a[keep], b[keep]
        keep = np.zeros(len(a), bool)
        for s in range(0, len(a), 1 << 16):
            x, y = a[s : s + (1 << 16)], b[s : s + (1 << 16)]
            shared = np.bitwise_count(bits[x] & bits[y]).sum(axis=1).astype(np.int64)
            most = np.minimum(
                high[x] - np.maximum(0, least[x] - shared), high[y] - np.maximum(0, least[y] - shared)
            )
            keep[s : s + (1 << 16)] = most >= overlap_needed(low[x], low[y], percent)
        return a[keep], b[keep]


_CLASSES = pa.schema([("names", pa.binary()), ("spare", pa.binary()), ("counts", pa.binary()), ("marks", pa.binary())])
_CLASS_COLUMNS = "names binary, spare binary, counts binary, marks binary"


def _by_class(names: np.ndarray, spare: np.ndarray, marks: np.ndarray) -> dict[str, bytes]:
    """Entries whose classes stand together, with every class once."""
    start = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    counts = np.diff(np.concatenate([start, [len(names)]]))
    return {
        "names": names[start].astype("<i8").tobytes(),
        "spare": spare[start].astype("<i4").tobytes(),
        "counts": counts.astype("<u4").tobytes(),
        "marks": marks.astype("<u4").tobytes(),
    }


def _entries(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts = np.frombuffer(row["counts"], "<u4")
    names, spare = (np.repeat(np.frombuffer(row[c], t), counts) for c, t in (("names", "<i8"), ("spare", "<i4")))
    return names, spare, np.frombuffer(row["marks"], "<u4")


def spare_of(tokens: np.ndarray, buckets: int, percent: int = PERCENT) -> int:
    """Shingles that a set must show, less those that it has (as bucket and mark): the more of them others have, the
    more it shows."""
    known = (tokens >> np.uint64(32)) * np.uint64(buckets) + tokens % np.uint64(buckets)
    return prefix_length(len(tokens), percent) - len(np.unique(known))


def _classes(source: DataFrame, width: int) -> DataFrame:
    """(doc_id, class, size) per row."""
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes = [], []
            for text in batch.column(1):
                tokens = shingles(text.as_py(), width)
                names.append(class_of(tokens))
                sizes.append(len(tokens))
            columns = [batch.column(0), pa.array(names, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "name", "size"])
        give_back()

    return source.mapInArrow(run, f"doc_id {kind}, name long, size long")


def _sets(source: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """The shingles of a chunk's distinct sets by bucket. They are shuffled as they come, not written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        waiting = 0
        for batch in batches:
            for text in batch.column(0):
                tokens = shingles(text.as_py(), width)
                name = class_of(tokens)
                if len(tokens) and name not in seen:
                    seen[name] = tokens
                    waiting += len(tokens)
                    if waiting >= CHUNK_TOKENS:
                        yield dealt(seen)
                        seen, waiting = {}, 0
        if seen:
            yield dealt(seen)
        seen = {}
        give_back()

    def dealt(seen: dict[int, np.ndarray]) -> pa.RecordBatch:
        lengths = np.array([len(t) for t in seen.values()])
        tokens = np.concatenate(list(seen.values()))
        names = np.repeat(np.array(list(seen), np.int64), lengths)
        spare = np.repeat(np.array([spare_of(t, buckets, percent) for t in seen.values()]), lengths)
        of = (tokens % np.uint64(buckets)).astype(np.int32)
        by = np.argsort(of, kind="stable")
        of, names, spare, marks = of[by], names[by], spare[by], (tokens[by] >> np.uint64(32)).astype("<u4")
        cut = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        rows = [{"bucket": int(of[s]), **_by_class(names[s:e], spare[s:e], marks[s:e])} for s, e in zip(cut, cut[1:])]
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("bucket", pa.int32()), *_CLASSES]))

    return source.select("text").mapInArrow(run, f"bucket int, {_CLASS_COLUMNS}")


def _shared(buckets: int):
    """Out of a bucket of shingles those that several classes hold, with the number of these, dealt by class."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        names, spare, marks = (np.concatenate(c) for c in zip(*map(_entries, table.to_pylist())))
        del table
        by = np.lexsort((names, marks))
        names, spare, marks = names[by], spare[by], marks[by]
        other_mark = np.concatenate([[True], marks[1:] != marks[:-1]])
        fresh = other_mark | np.concatenate([[True], names[1:] != names[:-1]])
        group = np.cumsum(other_mark) - 1
        held = np.bincount(group[fresh])[group]
        common = held > 1
        # The same shingle of copies in several chunks is there once; two shingles of one set may share a mark.
        common &= fresh
        names, spare, marks, held = names[common], spare[common], marks[common], held[common]
        of = (names.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        by = np.lexsort((names, of))
        of, names, spare, marks, held = of[by], names[by], spare[by], marks[by], held[by]
        cut = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)] if len(of) else [0]
        rows = [
            {"owner": int(of[s]), **_by_class(names[s:e], spare[s:e], marks[s:e]), "held": held[s:e].astype("<u4").tobytes()}
            for s, e in zip(cut, cut[1:])
        ]
        del names, spare, marks, held, by, of, group, fresh, common, other_mark
        give_back()
        return pa.Table.from_pylist(
            [{"bucket": bucket, **r} for r in rows],
            schema=pa.schema([("bucket", pa.int32()), ("owner", pa.int32()), *_CLASSES, ("held", pa.binary())]),
        )

    return run


def _rarest(table: pa.Table) -> pa.Table:
    """For some classes the shared shingles among the rarest that a linked set must meet: (key, name)."""
    parts = []
    for row in table.to_pylist():
        names, spare, marks = _entries(row)
        key = marks.astype(np.int64) | row["bucket"] << 32
        parts.append((names, spare, key, np.frombuffer(row["held"], "<u4")))
    names, spare, keys, held = (np.concatenate(c) for c in zip(*parts))
    by = np.lexsort((keys, held, names))
    names, spare, keys = names[by], spare[by], keys[by]
    start = np.concatenate([[True], names[1:] != names[:-1]])
    first = np.flatnonzero(start)
    group = np.cumsum(start) - 1
    quota = spare[first] + np.diff(np.concatenate([first, [len(names)]]))  # shingles of no other class come first
    use = np.arange(len(names)) - first[group] < quota[group]
    out = pa.table({"key": keys[use], "name": names[use]})
    del parts, names, spare, keys, held, by, start, group, use
    give_back()
    return out


def _tokens(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_py(), "<u8")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked."""
    both = pairs.join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(_tokens(x), _tokens(y), percent) for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _bits(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["bitmap"].to_pylist()), "<u8").reshape(table.num_rows, -1)


def _open_pairs(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions a, b of pairs that may be linked, out of the same blocks of one part and not in one component.

    Blocks of up to `FANOUT` classes are one node, whose pairs are formed for all blocks of a size at once."""
    part, i, j, block, label, size = (table[c].to_numpy() for c in ("part", "i", "j", "block", "label", "size"))
    bits = _bits(table)
    by = np.lexsort((j, i, part))
    edge = (np.diff(part[by]) != 0) | (np.diff(i[by]) != 0) | (np.diff(j[by]) != 0)
    begin = np.concatenate([[0], np.flatnonzero(edge) + 1])
    length = np.diff(np.concatenate([begin, [len(by)]]))
    left, right = [], []
    for n in np.unique(length[(length > 1) & (length <= FANOUT)]).tolist():
        members = by[begin[length == n][:, None] + np.arange(n)]
        x, y = np.triu_indices(n, 1)
        left.append(members[:, x].ravel())
        right.append(members[:, y].ravel())
    a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (left, right))
    a, b = Tree.possible(Tree.leaves(size, bits), a, b, percent, True)
    left, right = [a], [b]
    for s, n in zip(begin[length > FANOUT].tolist(), length[length > FANOUT].tolist()):
        own = by[s : s + n]
        a, b = Tree(size[own], bits[own]).pairs(percent)
        left.append(own[a])
        right.append(own[b])
    a, b = np.concatenate(left), np.concatenate(right)
    keep = (label[a] != label[b]) & ((i[a] == j[a]) | (block[a] != block[b]))
    return a[keep], b[keep]


def _forest(percent: int):
    """Links among all open pairs of some blocks, verified in place: only those that connect what was not connected yet."""

    def run(table: pa.Table) -> pa.Table:
        a, b = _open_pairs(table, percent)
        name, label = table["name"].to_numpy(), table["label"].to_numpy()
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        sets, found, refused = table["set"], [], set()
        for x, y in zip(a.tolist(), b.tolist()):
            one, two = root(int(label[x])), root(int(label[y]))
            pair = (min(name[x], name[y]), max(name[x], name[y]))  # the same pair may stand under several shingles
            if one == two or pair in refused:
                continue
            if linked(_tokens(sets[x]), _tokens(sets[y]), percent):
                parent[one] = two
                found.append(pair)
            else:
                refused.add(pair)
        return pa.table({"a": pa.array([p[0] for p in found], pa.int64()), "b": pa.array([p[1] for p in found], pa.int64())})

    return run


def _open_rows(percent: int):
    """The rows of some blocks that take part in an open pair."""

    def run(table: pa.Table) -> pa.Table:
        a, b = _open_pairs(table, percent)
        return table.take(pa.array(np.union1d(a, b)))

    return run


def _best_pairs(percent: int):
    """For each component in some blocks the pair that leads out of it with the most alike bitmaps."""

    def run(table: pa.Table) -> pa.Table:
        a, b = _open_pairs(table, percent)
        name, label, bits = table["name"].to_numpy(), table["label"].to_numpy(), _bits(table)
        alike = np.empty(len(a))
        for s in range(0, len(a), 1 << 16):
            x, y = bits[a[s : s + (1 << 16)]], bits[b[s : s + (1 << 16)]]
            alike[s : s + (1 << 16)] = np.bitwise_count(x & y).sum(axis=1) / np.bitwise_count(x | y).sum(axis=1)
        low, high = np.minimum(name[a], name[b]), np.maximum(name[a], name[b])
        own = np.concatenate([label[a], label[b]])
        at = np.tile(np.arange(len(a)), 2)
        by = np.lexsort((high[at], low[at], -alike[at], own))
        first = by[np.flatnonzero(np.concatenate([[True], own[by][1:] != own[by][:-1]]))] if len(by) else by
        at = at[first]
        return pa.table({"label": own[first], "a": low[at], "b": high[at], "alike": alike[at]})

    return run


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, class_id, component_id.

    Two rows are linked when the Jaccard similarity of their sets of word shingles (in lower case, A-Z only) is
    at least `percent` / 100. class_id is the smallest id with the same set, component_id the smallest one that
    links lead to. A row without words has an empty set, links with nothing and is its own class. Null ids
    are passed over: a component of null ids only has the id null. Other columns are ignored.

    Groups are those of a rare shingle, never one source or one common passage: a set shows a shingle once, and
    copies are merged before (by chunk) and inside buckets. Shingles that more than `BLOCK` open sets show are compared
    in blocks, so no task holds a whole group. No table of pairs is kept but one pair per component, and
    candidate texts are found by a bitmap first, so that only few others are moved.
    """
    spark = docs.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stage(_classes(source, width), "classes-of-rows")
    tokens = _sets(source, width, percent, shuffle).groupBy("bucket")
    shared = tokens.applyInArrow(_shared(shuffle), f"bucket int, owner int, {_CLASS_COLUMNS}, held binary")
    shown = stage(shared.groupBy("owner").applyInArrow(_rarest, "key long, name long"), "rare-shingles")
    shown = shown.distinct()

    # Shingles that the same classes show are one: counts and combined hashes tell, without a list of the classes.
    groups = shown.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("name")).alias("x"),
        F.bit_xor(F.xxhash64("name", F.lit(1))).alias("y"),
    )
    chosen = groups.filter("n > 1").groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key")
    listed = stage(shown.join(chosen, "key").select(F.col("key").alias("part"), "name"), "shared-shingles")
    wanted = stage(listed.select("name").distinct(), "candidates")
    rows_of = rows.join(wanted, "name").groupBy("name").agg(F.min("doc_id").alias("doc_id"))
    ids_of = stage(rows_of.select(F.xxhash64("doc_id").alias("id")), "candidate-ids")
    near = bitmap(ids_of, "id", bits_for(ids_of.count()))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(maybe(near, batch.column(0).to_numpy())))
            for at in range(0, some.num_rows, 256):
                own = [shingles(text.as_py(), width) for text in some.column(1).slice(at, 256)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([class_of(t) for t in own], pa.int64()),
                        pa.array([len(t) for t in own], pa.int64()),
                        pa.array([bitmap_of(t).tobytes() for t in own], pa.binary()),
                        pa.array([t.astype("<u8").tobytes() for t in own], pa.binary()),
                    ],
                    names=["name", "size", "bitmap", "set"],
                )
        give_back()

    read = source.select(F.xxhash64("doc_id").alias("id"), "text")
    read = read.mapInArrow(candidates, "name long, size long, bitmap binary, set binary").join(wanted, "name", "left_semi")
    found = stage(read.dropDuplicates(["name"]), "candidate-sets")
    sets = found.select("name", "set")
    slim = stage(listed.join(found.drop("set"), "name"), "members")

    def open_parts(labels: DataFrame | None):
        """What shows shingles that more than one component shows, dealt into pairs of blocks."""
        if labels is None:
            labelled = slim.withColumn("label", F.col("name"))
        else:
            labelled = slim.join(labels.withColumnRenamed("node", "name"), "name", "left")
            labelled = labelled.withColumn("label", F.coalesce("label", "name"))
        mixed = labelled.groupBy("part").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")
        )
        mixed = mixed.filter("low <> high").select("part", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
        dealt = labelled.join(mixed, "part").withColumn("block", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        columns = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
        dealt = dealt.select("part", *columns, "block", "name", "label", "size", "bitmap")
        return dealt.withColumn("bucket", F.pmod(F.xxhash64("part", "i", "j"), F.lit(16 * shuffle)))

    def by_bucket(dealt: DataFrame):
        return dealt.repartition(shuffle, "bucket").groupBy("bucket")  # little data, much work: not to be coalesced

    links = tried = labels = None
    for _ in range(ROUNDS):
        best = by_bucket(open_parts(labels)).applyInArrow(_best_pairs(percent), "label long, a long, b long, alike double")
        best = best.groupBy("label").agg(F.max_by(F.struct("a", "b"), F.struct("alike", "a", "b")).alias("pair"))
        pairs = best.select("pair.a", "pair.b").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stage(pairs, "best-pairs")
        found = stage(_verify(pairs, sets, percent), "links")
        tried = pairs if tried is None else tried.union(pairs)
        if not found.head(1):
            break
        links = found if links is None else links.union(found)
        labels = components(links)
    # Whatever is still open is looked at in full, so nothing depends on the choices above.
    left = open_parts(labels)
    left = stage(by_bucket(left).applyInArrow(_open_rows(percent), left.schema), "open-rows")
    found = stage(by_bucket(left.join(sets, "name")).applyInArrow(_forest(percent), "a long, b long"), "links")
    if labels is None or found.head(1):
        labels = components(found if links is None else links.union(found))

    ids = rows.filter("size > 0").groupBy("name").agg(F.min("doc_id").alias("class_id"))
    grouped = ids.join(labels.toDF("name", "label"), "name", "left").select(
        "name", "class_id", F.coalesce("label", "name").alias("label")
    )
    grouped = stage(grouped, "classes")
    smallest = grouped.groupBy("label").agg(F.min("class_id").alias("component_id"))
    classes = grouped.join(smallest, "label").select("name", "class_id", "component_id")
    out = rows.filter("size > 0").select("doc_id", F.col("size").alias("n_shingles"), "name").join(classes, "name")
    alone = rows.filter("size = 0").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.col("doc_id").alias("class_id"),
        F.col("doc_id").alias("component_id"),
    )
    return out.select("doc_id", "n_shingles", "class_id", "component_id").unionByName(alone)
