import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from sedimenta.llm import token_files
from sedimenta.llm.packing import (
    cut,
    fill_window,
    pack,
    pack_documents,
    padding,
    places,
    plan,
    sequences,
    tokenise,
)
from sedimenta.llm.token_files import Coder, new_token_file, read_token_file, scale, write_token_file
from sedimenta.llm.tokens import ByteLevelTokenizer, WordEndTokenizer
from tests.llm.conftest import odd_texts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def strings(n, seed):
    rng = random.Random(seed)
    latin = "abcdeefghijklmnnoprsssttuvwxyz  ABC 012 ''’éßñÄÖŁƠǅ½²ª\t\n\r\xa0\xad.,!?-_=+*#  <|endoftext|>"
    other = latin + "語😀ΣİΆ\x1c\x85"
    return ["".join(rng.choice(latin if i % 3 else other) for _ in range(rng.randint(0, 60))) for i in range(n)]


@pytest.mark.parametrize("kind, path", [(ByteLevelTokenizer, BYTES), (WordEndTokenizer, WORDS)])
def test_ids_equal_those_of_the_library(kind, path):
    own = kind(path)
    texts = [t or "" for t in odd_texts()] + strings(3000, 5)
    assert list(own.ids(texts)) == [own.whole(t) for t in texts]
    assert list(own.ids([None, ""])) == [b"", b""]


@pytest.mark.parametrize("kind, path", [(ByteLevelTokenizer, BYTES), (WordEndTokenizer, WORDS)])
def test_strings_of_special_tokens_are_those_of_an_untouched_library(kind, path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    texts = [f"{a}{t}{b}" for t in ("<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext") for a, b in [("", ""), ("one ", " two"), ("É", "é\n"), ("語 ", " 語")]]
    texts += ["<|endoftext|><|startoftext|><|endoftext|>"] + strings(300, 6)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(kind(path).ids(texts)) == want
    end = library.token_to_id("<|endoftext|>")
    assert end in np.frombuffer(next(kind(path).ids(["one <|endoftext|> two"])), "<u4")


def test_pieces_start_where_the_plain_pattern_finds_them():
    plain = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\s\p{L}\p{N}]+")
    every = [c for c in map(chr, range(0x250)) if WordEndTokenizer.LATIN.fullmatch(c)]
    assert all(WordEndTokenizer.PIECES.findall(c.lower()) == plain.findall(c.lower()) for c in every)
    rng = random.Random(5)
    for _ in range(20_000):
        some = rng.choice(["'stremlvd ", "'s\"« 2½x\n", every])
        text = "".join(rng.choices(some, k=rng.randrange(12))).lower()
        assert WordEndTokenizer.PIECES.findall(text) == plain.findall(text), text


def test_forgotten_pieces_are_found_again():
    small = WordEndTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    small.known.MOST = 3
    rng = random.Random(6)
    for _ in range(200):
        text = " ".join(rng.choices(["one", "twoo", "thrée", "4", "fife's", "zzyzx", "", "sevenfold..."], k=rng.randrange(20)))
        assert list(small.ids([text])) == [small.whole(text)]
        assert len(small.known) <= 3 and len(small.known.before) <= 3


def test_a_special_token_in_a_text_comes_back_from_a_token_file(spark):
    from tokenizers import Tokenizer

    texts = ["one", "two <|endoftext|> three", "four"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = new_token_file(spark)
    write_token_file(token_files.tokenise(df, WORDS, 2, byte_level=False), path)
    library, at, want = Tokenizer.from_file(WORDS), 0, []
    for i, text in enumerate(texts):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        want.append((i, at, ids))
        at += len(ids)
    rows = read_token_file(spark, path).collect()
    assert sorted((r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows) == want


def best_fill(counts, capacity):
    """The least padding of any multiset with the longest length in it."""
    longest = max(counts)
    pool = [n for n, c in counts.items() for _ in range(c)]
    pool.remove(longest)
    sums = {0}
    for n in pool:
        sums |= {s + n for s in sums if s + n + longest <= capacity}
    return min(padding(longest + s, capacity) for s in sums)


def test_a_window_has_the_least_padding():
    rng = random.Random(4)
    for _ in range(300):
        counts = {}
        for _ in range(rng.randint(1, 9)):
            n = rng.randint(1, 31)
            counts[n] = counts.get(n, 0) + rng.randint(1, 3)
        window = fill_window(counts, 32)
        total = sum(n * k for n, k in window.items())
        assert max(counts) in window and all(k <= counts[n] for n, k in window.items())
        assert total <= 32 and padding(total, 32) == best_fill(counts, 32)


def test_a_plan_uses_every_piece_once():
    rng = random.Random(5)
    counts = {n: rng.randint(1, 400) for n in rng.sample(range(1, 2049), 300)}
    windows = plan(dict(counts))
    used = {}
    for window, times in windows:
        assert sum(n * k for n, k in window.items()) <= 2048
        for n, k in window.items():
            used[n] = used.get(n, 0) + k * times
    assert used == counts
    for n, table in places(windows).items():
        assert table[0, 0] == 0 and (np.diff(table[:, 0]) > 0).all()


def check_places(rows, capacity=2048):
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append(r)
    for own in held.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert sorted(held) == list(range(len(held)))


def test_documents_are_packed_whole(odd):
    rows = pack_documents(odd, BYTES).collect()
    check_places(rows)
    own = ByteLevelTokenizer(BYTES)
    want = sorted(own.whole(r.text or "") + b"\1\0\0\0" for r in odd.collect())
    pieces = {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert sum(r.length for r in rows) == sum(map(len, want)) // 4
    for d in odd.filter("doc_id > 4").collect():
        ids = own.whole(d.text or "") + b"\1\0\0\0"
        at = 0
        for r in sorted(pieces[d.doc_id, len(ids) // 4], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == len(ids) // 4


def test_equal_lengths_and_repeated_pieces(spark):
    pieces = spark.range(3000).select(F.lit(7).alias("doc_id"), F.lit(0).alias("start"), F.lit(600).cast("long").alias("length"))
    rows = pack(pieces).collect()
    assert len(rows) == 3000
    check_places(rows)


def test_sequences_hold_the_ids(odd):
    some = odd.filter("doc_id > 4")
    tokens = tokenise(some, BYTES, 1)
    placed = pack(cut(tokens, 64), 64)
    built = {r.sequence_id: r for r in sequences(tokens, placed, 9, 64).collect()}
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4") for r in tokens.collect()}
    for r in placed.collect():
        sequence = np.frombuffer(built[r.sequence_id].ids, "<u4")
        assert (sequence[r.offset : r.offset + r.length] == ids[r.doc_id][r.start : r.start + r.length]).all()
    for r in built.values():
        sequence = np.frombuffer(r.ids, "<u4")
        assert len(sequence) == r.n_tokens + padding(r.n_tokens, 64) and (sequence[r.n_tokens :] == 9).all()


def test_no_rows(nothing, spark):
    assert pack_documents(nothing, BYTES).collect() == []
    path = new_token_file(spark)
    write_token_file(token_files.tokenise(nothing, WORDS, 2, byte_level=False), path)
    assert read_token_file(spark, path).collect() == []


def test_scaled_frequencies():
    for counts in ([1], [5, 0, 3], [10**12, 1, 1], [1] * 5000, list(range(3000))):
        freq = scale(np.array(counts))
        assert freq.sum() == 1 << token_files.SCALE_BITS and ((freq > 0) == (np.array(counts) > 0)).all()
    assert scale(np.zeros(4, np.int64)).sum() == 0


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 700_001])
def test_blocks_come_back_also_from_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.002, n), 49_000).astype(np.uint32)
    coder = Coder.of(scale(np.bincount(ids, minlength=5)), decode=True)
    words, marks = coder.encode(ids)
    assert (coder.decode(words, marks, n) == ids).all()
    step = token_files.CHECKPOINT_STEPS * token_files.LANES
    for k in range(-(-n // step)):
        assert (coder.decode(words, marks, n, k) == ids[k * step :]).all()
    if n > 100_000:
        share = np.bincount(ids) / n
        entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
        assert len(words) * 8 < 1.01 * n * entropy + 64 * token_files.LANES


def test_a_token_file_keeps_order_and_ids(odd, spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 500)
    path = new_token_file(spark)
    write_token_file(token_files.tokenise(odd, WORDS, 2, byte_level=False), path)
    rows = sorted(read_token_file(spark, path).collect(), key=lambda r: r.start)
    own = WordEndTokenizer(WORDS)
    want = sorted(((r.doc_id is not None, r.doc_id or 0), own.whole(r.text or "") + b"\2\0\0\0") for r in odd.collect())
    assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == [w[0] for w in want]
    assert sorted(((r.doc_id is not None, r.doc_id or 0), bytes(r.ids)) for r in rows) == want
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens


def test_a_damaged_block_is_noticed(odd, spark):
    path, broken = new_token_file(spark), new_token_file(spark)
    write_token_file(token_files.tokenise(odd, WORDS, 2, byte_level=False), path)
    blocks = spark.read.parquet(f"{path}/blocks")
    damaged = F.unhex(F.concat(F.lit("00FF00FF"), F.expr("substring(hex(words), 9)")))
    blocks.withColumn("words", damaged).write.parquet(f"{broken}/blocks")
    for part in ("table", "parts"):
        spark.read.parquet(f"{path}/{part}").write.parquet(f"{broken}/{part}")
    with pytest.raises(Exception, match="damaged"):
        read_token_file(spark, broken).collect()


def test_queries(spark):
    from sedimenta.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    own, at, want = WordEndTokenizer(WORDS), 0, []
    for d in sorted(texts):
        ids = own.whole(texts[d]) + b"\2\0\0\0"
        want.append((d, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert sorted(map(tuple, QUERIES["op6_token_file"](spark, sf).collect())) == want
    rows = QUERIES["op4_packing"](spark, sf).collect()
    check_places(rows)
    own = ByteLevelTokenizer(BYTES)
    ids = {d: own.whole(t) + b"\1\0\0\0" for d, t in texts.items()}
    assert sum(r.length for r in rows) == sum(map(len, ids.values())) // 4
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id]) // 4
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][4 * r.start : 4 * (r.start + r.length)])
