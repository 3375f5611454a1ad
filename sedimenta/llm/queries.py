"""The registered queries over the training-data tables, and their SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.bpe import decode_ids, encode_texts
from sedimenta.llm.collocations import collocations
from sedimenta.llm.content_sort import content_sort
from sedimenta.llm.fingerprints import fingerprint_edits
from sedimenta.llm.html_blocks import extract_text
from sedimenta.llm.language_id import identify
from sedimenta.llm.line_templates import drop_recurring
from sedimenta.llm.packing import pack_documents
from sedimenta.llm.ppm import score_texts
from sedimenta.llm.quality_rules import BASE, apply_policy, ledger
from sedimenta.llm.signature_trees import jaccard_components
from sedimenta.llm.token_files import new_token_file, read_token_file, tokenise, write_token_file
from sedimenta.llm.whitening import whiten
from sedimenta.plans.registry import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def share_code(spark: SparkSession) -> None:
    """Let Python workers of this session import the package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def query(oracle: str | None = None):
    """Register a query under its function name."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            share_code(spark)
            return fn(spark, sf)

        QUERIES[fn.__name__] = run
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


@query(
    r"""
    WITH d AS (
      SELECT doc_id, length(coalesce(text, '')) AS n,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
      FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
    """
)
def op7_content_sort(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the row that stays of its group of equal texts."""
    return content_sort(table(spark, sf, "documents"))


@query(
    r"""
    WITH w AS (
      SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
    windows AS (
      SELECT doc_id, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS g
      FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    again AS (
      SELECT doc_id, i FROM windows WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(3) AS x(k) GROUP BY doc_id),
    sums AS (
      SELECT doc_id, sum(length(word)) AS chars, count(*) FILTER (word = upper(word) AND word <> lower(word)) AS uppers,
             count(*) FILTER (regexp_matches(word, '^\p{L}')) AS alphas, max(length(word)) AS longest FROM words GROUP BY doc_id),
    tops AS (
      SELECT doc_id, max(n) AS n FROM (SELECT doc_id, word, count(*) AS n FROM words GROUP BY ALL) GROUP BY doc_id),
    lines AS (
      SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dups
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    m AS (
      SELECT w.doc_id, len(ws) AS n_words, coalesce(chars, 0)::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dups, 0) AS n_dup_lines,
             coalesce(covered.n, 0) AS n_repeat_words, uppers, alphas, tops.n AS top, lines.n AS n_lines, longest
      FROM w LEFT JOIN sums ON sums.doc_id = w.doc_id LEFT JOIN tops ON tops.doc_id = w.doc_id
      LEFT JOIN lines ON lines.doc_id = w.doc_id LEFT JOIN covered ON covered.doc_id = w.doc_id)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols / n_words > 0.1 OR uppers / n_words > 0.3
             OR top / n_words > 0.2 OR n_dup_lines / n_lines > 0.4 OR alphas / n_words < 0.6) AS kept FROM m
    """
)
def op3_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger of every document with the verdict of the production policy."""
    entries = apply_policy(ledger(table(spark, sf, "documents")), "prose-1", "kept")
    base_failed = F.col("failed").bitwiseAND(F.lit(BASE)) != 0
    return entries.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & F.col("kept")).alias("kept"),
    )


@query()
def op1_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every document encoded and decoded again, as counts and digests."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ids = encode_texts(docs, vocabulary, public_tokenizers.PATTERN)
    return decode_ids(ids, vocabulary).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query()
def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as pieces of packed sequences."""
    return pack_documents(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op6_token_file(spark: SparkSession, sf: str) -> DataFrame:
    """All documents written to a token file and read back."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    path = new_token_file(spark)
    write_token_file(tokenise(table(spark, sf, "documents"), vocabulary, end_id=2, byte_level=False), path)
    return read_token_file(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op9_html_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf, "pages"))


@query()
def op8_ppm(spark: SparkSession, sf: str) -> DataFrame:
    """Every document under a model of the documents whose id does not fall into fold 2 of 7."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return score_texts(table(spark, sf, "documents"), held_out)


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query(
    rf"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE [array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS h FROM s GROUP BY doc_id),
    shared AS (
      SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
      SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
    reach(doc_id, other) AS (SELECT x, y FROM links UNION SELECT r.doc_id, y FROM reach r JOIN links ON r.other = x)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN h IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY h) END AS class_id,
           least(doc_id, coalesce(low, doc_id)) AS component_id
    FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) USING (doc_id)
    """
)
def op10_signature_trees(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the component of documents that links lead to."""
    return jaccard_components(table(spark, sf, "documents"))


@query(
    r"""
    WITH l AS (
      SELECT doc_id, md5(coalesce(text, '')) AS body, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
    m AS (
      SELECT doc_id, body, pos, line, [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END
                                      FOR t IN regexp_extract_all(line, '\S+')] AS toks FROM l),
    d AS (SELECT *, array_to_string([len(toks)::VARCHAR] || toks[1:3], ' ') AS leaf FROM m WHERE len(toks) > 0),
    near AS (SELECT leaf FROM d GROUP BY leaf HAVING count(DISTINCT body) >= 5),
    own AS (SELECT leaf, toks, count(DISTINCT body) AS n FROM d SEMI JOIN near USING (leaf) GROUP BY ALL),
    total AS (SELECT leaf, sum(n)::BIGINT AS total FROM own GROUP BY leaf),
    tokens AS (SELECT leaf, toks, n, unnest(toks) AS token, unnest(range(len(toks))) AS i FROM own),
    fixed AS (SELECT leaf, i, token, sum(n)::BIGINT AS docs FROM tokens WHERE token <> '<*>' GROUP BY ALL HAVING sum(n) >= 5),
    level AS (SELECT 5 * 4 ** unnest(range(20)) AS level),
    held AS (
      SELECT leaf, toks, level, string_agg(f.i || ' ' || f.token, chr(10) ORDER BY f.i) AS t, count(*) AS n_fixed,
             list(f.docs ORDER BY f.i) AS docs
      FROM tokens JOIN fixed f USING (leaf, i, token) JOIN level ON f.docs >= level GROUP BY ALL),
    chance AS (
      SELECT leaf, toks, leaf || chr(10) || t AS t, total,
             list_reduce([x::DOUBLE / total FOR x IN docs], lambda a, b: a * b) * total AS expected
      FROM held JOIN total USING (leaf) WHERE n_fixed >= 0.7 * len(toks)),
    template AS (
      SELECT DISTINCT leaf, toks, t, CASE WHEN expected >= total * 0.25 THEN 5 ELSE greatest(5, ceil(expected * 2 + sqrt(expected) * 8)) END AS least
      FROM chance),
    found AS (SELECT doc_id, body, pos, t, least FROM d JOIN template USING (leaf, toks)),
    gone AS (
      SELECT doc_id, pos FROM found SEMI JOIN (SELECT t FROM found GROUP BY t HAVING count(DISTINCT body) >= max(least)) USING (t) UNION
      SELECT doc_id, pos FROM d SEMI JOIN (SELECT leaf, toks FROM own WHERE n >= 5 AND len([x FOR x IN toks IF x <> '<*>']) > 0) USING (leaf, toks))
    SELECT m.doc_id, coalesce(string_agg(line, chr(10) ORDER BY m.pos) FILTER (gone.pos IS NULL), '') AS text,
           count(*) FILTER (len(toks) > 0) AS n_lines, count(gone.pos) AS n_dropped
    FROM m LEFT JOIN gone ON gone.doc_id = m.doc_id AND gone.pos = m.pos GROUP BY m.doc_id
    """
)
def op2_line_templates(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the lines whose template recurs across documents."""
    return drop_recurring(table(spark, sf, "documents"))


@query()
def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the language that text, declaration and source speak for."""
    return identify(table(spark, sf, "documents"))


@query(
    r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    x AS (
      SELECT doc_id, t, length(t) AS n, coalesce(lead(t) OVER o, first_value(t) OVER o) AS follows
      FROM t WINDOW o AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    e AS (SELECT doc_id, n, follows, t, left(t, n - n // 4) || left(follows, n // 4) AS edited FROM x),
    every AS (
      SELECT doc_id, 0 AS kind, t AS body FROM e UNION ALL SELECT doc_id, 1, edited FROM e UNION ALL SELECT doc_id, 2, follows FROM e),
    w AS (SELECT doc_id, kind, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS ws FROM every),
    h AS (
      SELECT doc_id, kind, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [left(md5(array_to_string(ws, ' ')), 16)]
        ELSE list_sort(list_distinct([left(md5(array_to_string(ws[i:i + 4], ' ')), 16) FOR i IN range(1, len(ws) - 3)])) END AS hs FROM w),
    s AS (
      SELECT doc_id, kind, CASE WHEN len([x FOR x IN hs IF x < '2']) >= 32 THEN '2' WHEN len(hs) <= 32 THEN '~' ELSE hs[32] || '~' END AS below, hs
      FROM h),
    k AS (SELECT doc_id, kind, below, [x FOR x IN hs IF x < below] AS hs FROM s),
    p AS (
      SELECT a.doc_id, a.below || ':' || array_to_string(a.hs, '') AS fingerprint, b.below || ':' || array_to_string(b.hs, '') AS edited_fingerprint,
             [x FOR x IN a.hs IF x < least(a.below, b.below)] AS ae, [x FOR x IN b.hs IF x < least(a.below, b.below)] AS be,
             [x FOR x IN a.hs IF x < least(a.below, c.below)] AS an, [x FOR x IN c.hs IF x < least(a.below, c.below)] AS cn
      FROM k a JOIN k b ON a.doc_id = b.doc_id AND a.kind = 0 AND b.kind = 1 JOIN k c ON a.doc_id = c.doc_id AND c.kind = 2),
    q AS (SELECT *, len(list_intersect(ae, be)) AS e2, len(list_intersect(an, cn)) AS n2 FROM p)
    SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
           CASE WHEN len(ae) + len(be) = 0 THEN 1.0 ELSE e2::DOUBLE / (len(ae) + len(be) - e2) END AS near_edited,
           CASE WHEN len(an) + len(cn) = 0 THEN 1.0 ELSE n2::DOUBLE / (len(an) + len(cn) - n2) END AS near_next,
           CASE WHEN len(ae) = 0 THEN 1.0 ELSE e2::DOUBLE / len(ae) END AS contained_edited,
           CASE WHEN len(an) = 0 THEN 1.0 ELSE n2::DOUBLE / len(an) END AS contained_next
    FROM q JOIN e USING (doc_id)
    """
)
def op11_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's sketch beside those of its edited text and of the next document."""
    return fingerprint_edits(table(spark, sf, "documents"))


@query()
def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """Every usable embedding on the first four components of all distinct ones."""
    return whiten(table(spark, sf, "embeddings"))


@query(
    rf"""
    WITH p AS (
      SELECT coalesce(lang, 'und') AS lang,
             unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LETTERS}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
    g AS (
      SELECT lang, 1 AS size, unnest(ws) AS phrase FROM w UNION ALL
      SELECT lang, 2, unnest([array_to_string(ws[i:i + 1], ' ') FOR i IN range(1, len(ws))]) FROM w UNION ALL
      SELECT lang, 3, unnest([array_to_string(ws[i:i + 2], ' ') FOR i IN range(1, len(ws) - 1)]) FROM w UNION ALL
      SELECT lang, 4, unnest([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]) FROM w),
    n AS (SELECT lang, count(*) AS n FROM g WHERE size = 1 GROUP BY lang),
    f AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
    c AS (SELECT lang, size, phrase, ws, f AS a, unnest(range(1, size)) AS k FROM f WHERE size > 1),
    s AS (
      SELECT c.lang, c.size, c.phrase, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f::HUGEINT + y.f))::BIGINT AS score
      FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:k], ' ')
      JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[k + 1:], ' ')),
    low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    longer AS (
      SELECT lang, f AS a, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN range(1, size - m + 2)]) AS phrase
      FROM (SELECT *, unnest(range(2, size)) AS m FROM f WHERE size > 2)),
    around AS (SELECT lang, phrase, max(a) AS around FROM longer GROUP BY ALL),
    kept AS (
      SELECT low.* FROM low LEFT JOIN around ON around.lang = low.lang AND around.phrase = low.phrase
      WHERE around IS NULL OR 100::HUGEINT * around < 80::HUGEINT * a)
    SELECT kept.lang, row_number() OVER o AS rank, phrase, a, l, r, n, score FROM kept JOIN n ON n.lang = kept.lang
    WINDOW o AS (PARTITION BY kept.lang ORDER BY score DESC, a DESC, encode(phrase)) QUALIFY rank <= 2000
    """
)
def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    """The first phrases of every language by their score."""
    return collocations(table(spark, sf, "documents"))
