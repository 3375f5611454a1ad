"""Phrase collocations by HAT-trie counting.

Every task counts its phrases in a burst trie: children by word id at the top, below them containers, hash tables
from the remaining words to a count. A container that grows too large bursts into one per next word. When the
trie passes its bound, whole subtrees, the largest first, leave it as runs, dealt by prefix (first word and a
class of the second). The runs of a prefix partition are merged by one task of the next stage.

Phrases are counted in three passes, words, pairs, and longer phrases, as a phrase can only be frequent if all of its
parts are. What was frequent goes along as a bitmap, sized by its number up to 32 MiB; it may let a rare phrase
pass, which is counted in vain, and never stops a frequent one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.bits import bitmap, bits_for, maybe
from sedimenta.session import stage

LONGEST = 4
LEAST = 30  # occurrences of a candidate
TOP = 2000
COVERED_PERCENT = 80  # a candidate goes if a longer one around it has this share of its occurrences
BURST = 16_384  # entries of a container
LIMIT = 1_000_000  # entries of a trie, and words with a number
CHUNK_WORDS = 1_000_000  # words that are added at once
RUN_ROWS = 1_000_000  # phrases of one prefix partition, about, that the merge stage is planned for
SECOND_CLASSES = 16

_ID_BITS = 21
_IDS = 1 << _ID_BITS
_MASK = (1 << 3 * _ID_BITS) - 1
_SECOND = 2 * _ID_BITS
_EDGE = b"\xff"  # in no UTF-8 text
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BETWEEN = np.zeros(1, np.int64)  # no phrase goes over the end of a document
_RUN = pa.schema(
    [
        ("part", pa.int32()),
        ("langs", pa.list_(pa.string())),
        ("lang_of", pa.binary()),
        ("words", pa.binary()),
        ("grams", pa.binary()),
        ("counts", pa.binary()),
    ]
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in lower case (A-Z only), with `_EDGE` between pieces; null has none."""
    return (text or "").encode().translate(_FOLD).replace(b"\n", b" \xff ").split()


def mark_of(word: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(word, seed)


def seed_of(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))


def pair_marks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = (first ^ (first >> np.uint64(31))) * _STEP + second
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


class Words(dict):
    """Word -> number in one language; 0 for words that the bitmap tells to be rare."""

    def __init__(self, lang: int, seed: int, frequent: bytes | None, names: list, marks: list):
        super().__init__()
        self.lang, self.seed, self.frequent, self.names, self.marks = lang, seed, frequent, names, marks
        self.shift = 64 - (8 * len(frequent)).bit_length() + 1 if frequent is not None else 0
        self[_EDGE] = 0

    def __missing__(self, word: bytes) -> int:
        mark = mark_of(word, self.seed)
        if self.frequent is not None:
            place = mark >> self.shift
            if not self.frequent[place >> 3] >> (place & 7) & 1:
                self[word] = 0
                return 0
        self[word] = number = len(self.names)
        self.names.append((self.lang, word))
        self.marks.append(mark)
        return number


class HatTrie:
    """Counts of phrases: a first word, and up to three more packed into 63 bits, the second word on top."""

    def __init__(self, burst: int = BURST):
        self.burst = burst
        self.own = np.zeros(1, np.int64)  # phrases that end with their first word
        self.top: dict[int, Counter | dict[int, Counter]] = {}
        self.entries = 0

    def add_words(self, ids: np.ndarray, known: int) -> None:
        if known > len(self.own):
            self.own = np.concatenate([self.own, np.zeros(max(known, 2 * len(self.own)) - len(self.own), np.int64)])
        self.own += np.bincount(ids, minlength=len(self.own))

    def add(self, first: np.ndarray, rest: np.ndarray) -> None:
        for word, tail in _by(first, rest):
            node = self.top.get(word)
            if node is None:
                node = self.top[word] = Counter()
            if isinstance(node, Counter):
                self._count(node, tail)
                if len(node) > self.burst:
                    self.top[word] = self._burst(node)
            else:
                for second, below in _by(tail >> _SECOND, (tail << _ID_BITS) & _MASK):
                    self._count(node.setdefault(second, Counter()), below)

    def _count(self, container: Counter, tail: np.ndarray) -> None:
        before = len(container)
        container.update(tail.tolist())
        self.entries += len(container) - before

    @staticmethod
    def _burst(container: Counter) -> dict[int, Counter]:
        """One container per next word; the words after it move up."""
        out: dict[int, Counter] = {}
        for tail, count in container.items():
            child = out.get(tail >> _SECOND)
            if child is None:
                child = out[tail >> _SECOND] = Counter()
            child[(tail << _ID_BITS) & _MASK] = count
        return out

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Take out whole subtrees, the largest first, until at most `keep` entries are left: (first, rest, count)."""
        size = {w: len(n) if isinstance(n, Counter) else sum(map(len, n.values())) for w, n in self.top.items()}
        parts: list[tuple[int, int, Counter]] = []
        for word in sorted(size, key=size.__getitem__, reverse=True):
            if self.entries <= keep:
                break
            self.entries -= size[word]
            node = self.top.pop(word)
            parts += [(word, -1, node)] if isinstance(node, Counter) else [(word, s, c) for s, c in node.items()]
        if not parts:
            return (np.zeros(0, np.int64),) * 3
        words, seconds, containers = zip(*parts)  # most containers are small, so all are read in one go
        sizes = np.fromiter(map(len, containers), np.int64, len(parts))
        n = int(sizes.sum())
        rest = np.fromiter(chain.from_iterable(containers), np.int64, n)
        second = np.repeat(np.array(seconds, np.int64), sizes)
        rest = np.where(second < 0, rest, rest >> _ID_BITS | second << _SECOND)
        counts = np.fromiter(chain.from_iterable(map(dict.values, containers)), np.int64, n)
        return np.repeat(np.array(words, np.int64), sizes), rest, counts


def _by(keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(keys.astype(np.int32))  # ids have 21 bits
    keys, values = keys[order], values[order]
    cut = (np.flatnonzero(np.diff(keys)) + 1).tolist()
    for s, e in zip([0, *cut], [*cut, len(keys)]):
        if e > s:
            yield int(keys[s]), values[s:e]


class Counting:
    """One task's counting of phrases of `lengths` words, in all languages that it meets."""

    def __init__(self, lengths: tuple[int, ...], parts: int, words_seen: np.ndarray | None, pairs_seen: np.ndarray | None):
        self.lengths, self.parts, self.pairs_seen = lengths, parts, pairs_seen
        self.words_seen = None if words_seen is None else words_seen.tobytes()
        self.pending: list[np.ndarray] = []
        self.waiting = 0
        self._anew()

    def _anew(self) -> None:
        self.langs: dict[str, Words] = {}
        self.names: list[tuple[int, bytes]] = [(0, b"")]
        self.marks: list[int] = [0]
        self.trie = HatTrie()

    def add(self, lang: str, text: str | None) -> Iterator[pa.RecordBatch]:
        known = self.langs.get(lang)
        if known is None:
            known = self.langs[lang] = Words(len(self.langs), seed_of(lang), self.words_seen, self.names, self.marks)
        words = words_of(text)
        self.pending += [np.fromiter(map(known.__getitem__, words), np.int64, len(words)), _BETWEEN]
        self.waiting += len(words) + 1
        if self.waiting >= CHUNK_WORDS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.pending:
            return
        ids = np.concatenate([*self.pending, np.zeros(LONGEST - 1, np.int64)])
        self.pending, self.waiting = [], 0
        for s in range(0, len(ids) - LONGEST + 1, CHUNK_WORDS):  # a text may be longer than a chunk
            starts = min(CHUNK_WORDS, len(ids) - LONGEST + 1 - s)
            self._count(ids[s : s + starts + LONGEST - 1], starts)
            if self.trie.entries > LIMIT:
                yield from self._runs(*self.trie.spill(LIMIT // 2))
        if sum(map(len, self.langs.values())) > LIMIT:
            yield from self.rest()

    def _count(self, ids: np.ndarray, starts: int) -> None:
        """Count the phrases that begin at the first `starts` places."""
        if 1 in self.lengths:
            self.trie.add_words(ids[:starts], len(self.names))
        if max(self.lengths) == 1:
            return
        good = (ids[:-1] > 0) & (ids[1:] > 0)
        if self.pairs_seen is not None:
            at = np.flatnonzero(good)
            marks = np.array(self.marks, np.uint64)
            good[at] = maybe(self.pairs_seen, pair_marks(marks[ids[at]], marks[ids[at + 1]]).view(np.int64))
        firsts, rests = [], []
        on = np.ones(starts, bool)
        rest = np.zeros(starts, np.int64)
        for n in range(2, max(self.lengths) + 1):
            on &= good[n - 2 : n - 2 + starts]
            rest |= ids[n - 1 : n - 1 + starts] << _ID_BITS * (LONGEST - n)
            if n in self.lengths:
                at = np.flatnonzero(on)
                firsts.append(ids[at])
                rests.append(rest[at])
        self.trie.add(np.concatenate(firsts), np.concatenate(rests))

    def rest(self) -> Iterator[pa.RecordBatch]:
        """All that the trie still holds."""
        first = np.flatnonzero(self.trie.own[1:]) + 1
        yield from self._runs(first, np.zeros(len(first), np.int64), self.trie.own[first])
        yield from self._runs(*self.trie.spill(0))
        self._anew()

    def _runs(self, first: np.ndarray, rest: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A run for each prefix partition: its words in the order in which the task met them, and phrases as numbers of these
        from 1, sorted. The merge numbers the words anew, so their order is of no use to it."""
        if not len(first):
            return
        width = max(self.lengths)
        marks = np.array(self.marks, np.uint64)
        grams = np.stack([first, *(rest >> _ID_BITS * (LONGEST - n) & _IDS - 1 for n in range(2, width + 1))])
        second = marks[grams[1]] % np.uint64(SECOND_CLASSES) if width > 1 else np.uint64(0)
        part = (pair_marks(marks[first], second) % np.uint64(self.parts)).astype(np.int32)
        used = np.unique(grams)
        used = used[used > 0]
        rank = np.zeros(len(self.names), np.int64)
        rank[used] = np.arange(1, len(used) + 1)
        grams = rank[grams]
        order = np.lexsort((*grams[::-1], part))
        part, count, grams = part[order], count[order], grams[:, order]
        cut = (np.flatnonzero(np.diff(part)) + 1).tolist()
        langs = list(self.langs)
        rows = []
        for s, e in zip([0, *cut], [*cut, len(part)]):
            words, place = np.unique(grams[:, s:e], return_inverse=True)
            place = place.reshape(width, e - s) + (0 if words[0] == 0 else 1)
            names = [self.names[i] for i in used[words[words > 0] - 1].tolist()]
            own = sorted({lang for lang, _ in names})
            at = {lang: i for i, lang in enumerate(own)}
            rows.append(
                {
                    "part": int(part[s]),
                    "langs": [langs[lang] for lang in own],
                    "lang_of": np.array([at[lang] for lang, _ in names], "<u4").tobytes(),
                    "words": b"\n".join(word for _, word in names),
                    "grams": place.astype("<u4").tobytes(),
                    "counts": count[s:e].astype("<i8").tobytes(),
                }
            )
        for s in range(0, len(rows), 64):
            yield pa.RecordBatch.from_pylist(rows[s : s + 64], schema=_RUN)


def _count_in_tasks(lengths, parts, words_seen, pairs_seen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(lengths, parts, words_seen, pairs_seen)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from counting.add(lang, text.as_py())
        yield from counting.flush()
        yield from counting.rest()

    return run


def _merge_runs(least: int, width: int):
    """The runs of one prefix partition as phrases with their sums, frequent ones only; the rows without a phrase have
    the sum of all of a language."""

    def run(table: pa.Table) -> pa.Table:
        known: dict[tuple[str, bytes], int] = {("", b""): 0}
        grams, counts = [], []
        for row in table.select(["langs", "lang_of", "words", "grams", "counts"]).to_pylist():
            langs = row["langs"]
            of = [langs[i] for i in np.frombuffer(row["lang_of"], "<u4").tolist()]
            number = [0, *(known.setdefault(x, len(known)) for x in zip(of, row["words"].split(b"\n")))]
            grams.append(np.array(number, np.int64)[np.frombuffer(row["grams"], "<u4").reshape(width, -1)])
            counts.append(np.frombuffer(row["counts"], "<i8"))
        grams, counts = np.concatenate(grams, axis=1), np.concatenate(counts)
        names = list(known)
        order = np.lexsort(grams[::-1])
        fresh = (np.diff(grams[:, order]) != 0).any(axis=0)
        start = np.concatenate([[0], np.flatnonzero(fresh) + 1])
        total = np.add.reduceat(counts[order], start)
        often = total >= least
        found = grams[:, order[start[often]]]
        seeds = {lang: seed_of(lang) for lang, _ in known}
        marks = np.array([mark_of(word, seeds[lang]) for lang, word in names], np.uint64)
        mark = pair_marks(marks[found[0]], marks[found[1]]) if width == 2 else marks[found[0]]
        sums: Counter[str] = Counter()
        for i, n in zip(grams[0, order[start]].tolist(), total.tolist()):
            sums[names[i][0]] += n
        columns = found.T.tolist()
        return pa.table(
            {
                "lang": pa.array([*(names[g[0]][0] for g in columns), *sums], pa.string()),
                "phrase": pa.array(
                    [*(b" ".join(names[i][1] for i in g if i).decode() for g in columns), *[None] * len(sums)], pa.string()
                ),
                "size": pa.array([*(found > 0).sum(0).tolist(), *[0] * len(sums)], pa.int32()),
                "f": pa.array([*total[often].tolist(), *sums.values()], pa.int64()),
                "mark": pa.array([*mark.view(np.int64).tolist(), *[0] * len(sums)], pa.int64()),
            }
        )

    return run


def _frequent(texts: DataFrame, lengths: tuple[int, ...], parts: int, least: int, words_seen, pairs_seen) -> DataFrame:
    run = _count_in_tasks(lengths, parts, words_seen, pairs_seen)
    runs = texts.mapInArrow(
        run, "part int, langs array<string>, lang_of binary, words binary, grams binary, counts binary"
    )
    merge = _merge_runs(least, max(lengths))
    merged = runs.groupBy("part").applyInArrow(merge, "lang string, phrase string, size int, f long, mark long")
    return stage(merged, f"phrases-{max(lengths)}")


def _seen(found: DataFrame) -> np.ndarray:
    own = found.filter("phrase IS NOT NULL").select("mark")
    return bitmap(own, "mark", bits_for(own.count()))


def count_phrases(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, least: int = LEAST
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of up to `longest` words (2 to 4) that occur at least `least` times, and
    (lang, n) with the number of words of each language.

    Words are runs of other characters than blank and tab inside of pieces, which end at `.,;:!?` and line ends; A-Z
    count as a-z. Null texts are empty; a null language is `und`. Repeated rows count each time. Other
    columns are ignored; an empty table gives empty results.

    The number of prefix partitions follows the number of words, so that a partition stays of one size.
    """
    if not 2 <= longest <= LONGEST or least < 1:
        raise ValueError(f"phrases have 2 to {LONGEST} words and occur at least once")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = _frequent(texts, (1,), shuffle, least, None, None)
    n = words.filter("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    n = stage(n, "words-per-language")
    parts = max(shuffle, int((n.agg(F.sum("n")).first()[0] or 0) // RUN_ROWS))
    words_seen = _seen(words)
    pairs = _frequent(texts, (2,), parts, least, words_seen, None)
    found = words.unionByName(pairs)
    if longest > 2:
        found = found.unionByName(_frequent(texts, tuple(range(3, longest + 1)), parts, least, words_seen, _seen(pairs)))
    return found.filter("phrase IS NOT NULL").drop("mark"), n


def _whole(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    covered_percent: int = COVERED_PERCENT,
) -> DataFrame:
    """The `top` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    Candidates are the phrases of 2 to `longest` words with a >= `least` occurrences. Each cut into a first part (l
    occurrences) and the rest (r) has the score floor(2000000 * a / (l + r)); the lowest one counts, of equal ones that
    of the shortest first part. A candidate that is part of a longer one with `covered_percent` of its occurrences
    is dropped. Ties in score and a go by the bytes of the phrase. Texts, nulls and repeated rows: see `count_phrases`.
    """
    counted, n = count_phrases(docs, lang_col, text_col, longest, least)
    words = F.split("phrase", " ")
    candidates = counted.filter("size > 1").select("lang", "phrase", "size", words.alias("words"), F.col("f").alias("a"))

    cuts = candidates.select("lang", "phrase", "a", "words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("words", 1, F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size")), " ").alias("second"),
    )
    left = counted.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counted.select("lang", F.col("phrase").alias("second"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "second"])
    cuts = cuts.withColumn("top", F.lit(2_000_000).cast("decimal(7,0)") * _whole(F.col("a")))
    cuts = cuts.withColumn("both", _whole(F.col("l")) + _whole(F.col("r")))
    cuts = cuts.withColumn("score", F.expr("top div both"))
    scored = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))

    size = F.col("size")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda w: F.transform(F.sequence(F.lit(1), size - w + 1), lambda i: F.array_join(F.slice("words", i, w), " ")),
        )
    )
    inside = candidates.filter("size > 2").select("lang", "a", F.explode(spans).alias("phrase"))
    around = inside.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    covered = (100 * _whole(F.col("around"))) >= covered_percent * _whole(F.col("a"))
    left_over = (
        scored.select("lang", "phrase", "cut.*")
        .join(around, ["lang", "phrase"], "left")
        .filter(~F.coalesce(covered, F.lit(False)))
    )

    # First the best of every share of a language, then the best of those: no task sees a whole language.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    share = F.pmod(F.xxhash64("phrase"), F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    parted = left_over.withColumn("share", share)
    first = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
    ranked = first.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    best = ranked.filter(F.col("rank") <= top).join(n, "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
