import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from sedimenta.llm.bpe import EncodedText, PrefixEncoder, append_texts, decode_ids, encode_texts, load_ranks

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(PATH)


@pytest.fixture(scope="module")
def encoder(ranks):
    return PrefixEncoder(ranks)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def strings(n, seed, most=60):
    rng = random.Random(seed)
    alphabet = "abcdefghijklmnopqrstuvwxyz ABC 012 '’éßñ語😀\t\n\r\x85\xa0.,!?-_=+*#  "
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_every_prefix_has_the_last_token_of_its_encoding(encoder, library):
    for piece in (b"internationalisation", b"aaaaaaaaaaaaaaaa", "ſtraße語😀".encode(), bytes(range(256)), b"-" * 300):
        last = encoder.prefixes(piece)
        for i in range(1, len(piece) + 1):
            whole = library._core_bpe.encode_single_piece(piece[:i])
            assert encoder.walk(last[:i]) == whole and last[i - 1] == whole[-1]


def test_texts_against_the_library(encoder, library):
    for text in [*strings(400, 1, 300), "a" * 5000, " " * 3000 + "x", "-" * 999, "ab" * 999]:
        assert EncodedText(encoder, PATTERN, text).ids() == library.encode_ordinary(text)


def test_appends_and_edits_are_exact_and_local(encoder, library):
    rng = random.Random(2)
    for text in strings(400, 3, 120):
        held = EncodedText(encoder, PATTERN, text)
        for more in strings(3, rng.random(), 6):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.randint(0, 5))
            held.replace(a, b, more)
            text = text[:a] + more + text[b:]
            assert held.text == text and held.ids() == library.encode_ordinary(text)
        held.append(" 'll")
        assert held.ids() == library.encode_ordinary(text + " 'll")
    long = "word " * 2000
    held = EncodedText(encoder, PATTERN, long)
    held.replace(5000, 5001, "s")
    assert held.matched < 6 and held.ids() == library.encode_ordinary(long[:5000] + "s" + long[5001:])


def test_tables(odd, library):
    ids = encode_texts(odd.select("doc_id", "text"), PATH, PATTERN)
    rows = decode_ids(ids, PATH).collect()
    want = sorted(
        (repr(r.doc_id), library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in odd.collect()
    )
    got = sorted((repr(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), bytes(r.bytes)) for r in rows)
    assert got == want


def test_append_table(odd, library):
    more = odd.select("doc_id", "text", F.lit("'s more").alias("more"))
    for r in append_texts(more, PATH, PATTERN).join(more, "doc_id").collect():
        if r.doc_id != 4:  # the repeated id
            assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary((r.text or "") + "'s more")
            assert r.encoded_pieces <= 5


def test_no_rows_and_a_column_called_ids(nothing, odd):
    assert decode_ids(encode_texts(nothing, PATH, PATTERN), PATH).collect() == []
    clash = odd.select("doc_id", "text", F.lit("x").alias("ids"), F.lit(1).alias("bytes"))
    row = decode_ids(encode_texts(clash, PATH, PATTERN), PATH).filter("doc_id = 3").head()
    assert bytes(row.bytes) == b"one"


def test_query(spark):
    from sedimenta.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})
    for r in QUERIES["op1_byte_bpe"](spark, sf).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
