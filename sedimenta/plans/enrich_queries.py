"""Enrichment: pending items, batches, classification, search, scoring hooks, merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import vectors as vec
from sedimenta.functions.text import passage_text, prompt, query_text
from sedimenta.operators import enrich, merge
from sedimenta.operators import similarity as sim
from sedimenta.operators.joins import lookup_join
from sedimenta.plans.parliament import PROMPT, THEMES
from sedimenta.plans.registry import query, table
from sedimenta.session import new_path

_PENDING_SQL = """
SELECT documents.* FROM documents ANTI JOIN labels ON documents.doc_id = labels.doc_id
WHERE text IS NOT NULL AND trim(text) <> ''"""


def pending_documents(spark, sf, **kw):
    return enrich.pending(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", "text", **kw)


@query(f"SELECT doc_id, lang, n_chars FROM ({_PENDING_SQL}) ORDER BY doc_id")
def pending_items(spark, sf):
    return pending_documents(spark, sf).select("doc_id", "lang", "n_chars")


@query(f"SELECT doc_id, lang, n_chars FROM ({_PENDING_SQL}) ORDER BY doc_id LIMIT 50")
def pending_limited(spark, sf):
    """The first 50 pending items: the work limit of a trial run."""
    return pending_documents(spark, sf, limit=50).select("doc_id", "lang", "n_chars")


@query(f"SELECT count(*) AS pendentes FROM ({_PENDING_SQL})")
def pending_count(spark, sf):
    return pending_documents(spark, sf, ordered=False).agg(F.count(F.lit(1)).alias("pendentes"))


@query(f"""
SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 50 + 1)::BIGINT AS batch_id
FROM ({_PENDING_SQL})""")
def batch_plan(spark, sf):
    items = pending_documents(spark, sf, ordered=False).select("doc_id")
    return enrich.plan_batches(items, "doc_id", 50)


@query(f"""
WITH p AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) AS n FROM ({_PENDING_SQL}))
SELECT doc_id FROM p WHERE doc_id NOT IN (SELECT doc_id FROM p WHERE n_chars < 500)""")
def batch_resume(spark, sf):
    """What is left after an interrupted run that finished the short items."""
    items = pending_documents(spark, sf, ordered=False).select("doc_id", "n_chars")
    finished = items.where("n_chars < 500").select("doc_id")
    return enrich.unfinished(items.select("doc_id"), finished, "doc_id")


@query("""
SELECT count(*) AS items, ceil(count(*) / 50)::BIGINT AS batches, count(quality) AS ok,
       count(*) - count(quality) AS failed
FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id""")
def batch_counters(spark, sf):
    scored = lookup_join(
        table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), ["doc_id"], "left"
    )
    return enrich.batch_counters(scored, 50, "quality")


_TOP1_SQL = """
SELECT vec_id, 'tema_' || l AS tema, round(s, 4) AS score FROM (
  SELECT e.vec_id, t.vec_id AS l, list_dot_product(e.embedding::DOUBLE[], t.embedding::DOUBLE[]) AS s
  FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id < 10) t)
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, l) = 1"""


def classified(spark, sf):
    """All vectors, classified by the ten vectors that serve as themes, in three blocks."""
    items = table(spark, sf, "embeddings")
    themes = items.where("vec_id < 10").withColumn("nome", F.concat(F.lit("tema_"), "vec_id"))
    labels = sim.collect_labels(themes, "nome", "embedding", "vec_id")
    return sim.classify_top1(items, labels, label_as="tema", score_as="score", block=4)


@query(_TOP1_SQL)
def theme_top1(spark, sf):
    return classified(spark, sf).select("vec_id", "tema", "score")


@query(f"SELECT tema, count(*) AS total FROM ({_TOP1_SQL}) GROUP BY tema ORDER BY total DESC, tema")
def theme_distribution(spark, sf):
    return sim.distribution(classified(spark, sf), "tema")


@query(f"SELECT * FROM ({_TOP1_SQL}) WHERE tema = 'tema_3' ORDER BY score DESC, vec_id LIMIT 10")
def label_top10(spark, sf):
    return sim.label_top(classified(spark, sf).drop("embedding"), "tema", "tema_3", "score", "vec_id").select(
        "vec_id", "tema", "score"
    )


@query("""
SELECT vec_id, label, round(s, 6) AS similaridade FROM (
  SELECT e.vec_id, e.label, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS s
  FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q)
ORDER BY s DESC, vec_id LIMIT 10""")
def semantic_search(spark, sf):
    items = table(spark, sf, "embeddings")
    wanted = items.where("vec_id = 0").first()["embedding"]  # the user's query vector
    found = sim.nearest(items, "embedding", F.lit(wanted), "vec_id", 10)
    return found.select("vec_id", "label", F.round("similaridade", 6).alias("similaridade"))


@query("""
SELECT vec_id, unnest(generate_series(1, len(v)))::INTEGER AS at, unnest([round(x * label / n, 6) FOR x IN v]) AS x
FROM (SELECT vec_id, label, embedding::DOUBLE[] AS v,
        sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * nullif(label, 0) AS n FROM embeddings)""")
def vector_normalize(spark, sf):
    """Vectors of different lengths (label 0 makes a zero vector) brought back to length 1, element by element."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * F.col("label"))
    unit = table(spark, sf, "embeddings").select("vec_id", F.size("embedding").alias("n"), vec.normalize(scaled).alias("u"))
    places = F.explode(F.sequence(F.lit(1), F.col("n"))).alias("at")
    return unit.select("vec_id", "u", places).select("vec_id", "at", F.round(F.get("u", F.col("at") - 1), 6).alias("x"))


@query("""
SELECT vec_id, md5('[' || array_to_string([format('{:.8f}', x) FOR x IN embedding], ',') || ']') AS hash,
       len(embedding) AS n FROM embeddings""")
def vector_text(spark, sf):
    """Vector -> text -> vector -> text."""
    written = vec.to_text(F.col("embedding"))
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.md5(vec.to_text(vec.from_text(written))).alias("hash"),
        F.size(vec.from_text(written)).cast("bigint").alias("n"),
    )


@query("""
SELECT conv_id, turn, md5('Ementa: ' || text || CASE WHEN role = 'assistant' THEN chr(10) || chr(10)
         || 'Texto completo: ' || role ELSE '' END || chr(10) || chr(10)
         || 'Resuma em até 3 frases para um executivo:') AS hash,
       md5('query: ' || text) AS hash_query, 'passage: ' || role AS passage
FROM conversations""")
def prompt_text(spark, sf):
    detail = F.when(F.col("role") == "assistant", F.concat(F.lit("  "), "role", F.lit("\n"))).when(
        F.col("turn") > 2, F.lit(" \n ")
    )
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.md5(prompt(F.concat(F.lit("\n"), "text", F.lit(" ")), detail, **PROMPT)).alias("hash"),
        F.md5(query_text(F.col("text"))).alias("hash_query"),
        passage_text(F.col("role")).alias("passage"),
    )


@query("""
SELECT doc_id, length(text) AS tamanho, split_part(text, ' ', 1) AS primeira FROM documents""")
def enrich_hook(spark, sf):
    """A user's scoring function over Arrow batches, loaded once per worker."""

    def load():
        import pandas as pd

        def score(frame):
            return pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "tamanho": frame["text"].str.len(),
                    "primeira": frame["text"].str.split(" ", n=1).str[0],
                }
            )

        return score

    items = table(spark, sf, "documents").select("doc_id", "text")
    return enrich.enrich_batches(
        items, load, "doc_id long, tamanho long, primeira string", name="enrich_hook"
    )


@query("""
SELECT doc_id, CASE WHEN lang <> 'es' THEN split_part(text, ' ', 1) END AS result, 'reserva' AS provider,
       CASE WHEN lang = 'es' THEN 'idioma sem suporte' END AS error, false AS asked_in_vain FROM documents""")
def enrich_fallback(spark, sf):
    """The first provider is used up, the second fails for one language: those rows stay null. After the first lot no
    task calls the first one again."""

    def main(_):
        raise RuntimeError("429: tokens")

    def reserve(value):
        language, text = value.split("|", 1)
        if language == "es":
            raise ValueError("idioma sem suporte")
        return text.split(" ", 1)[0]

    items = table(spark, sf, "documents").select("doc_id", F.concat("lang", F.lit("|"), "text").alias("text"))
    asked = enrich.ask_in_turn(
        items,
        [("principal", main), ("reserva", reserve)],
        lambda e: "429" in str(e) and "tokens" in str(e),
        "doc_id",
        "text",
        new_path(spark, "answers"),
        size=max(1, -(-items.count() // 4)),
    )
    in_vain = (F.col("lot") > 1) & F.array_contains("asked", "principal")
    return asked.select("doc_id", "result", "provider", "error", in_vain.alias("asked_in_vain"))


_THEME_ROWS = ", ".join(f"({i}, '{n}', '{d}')" for i, (n, d) in enumerate(THEMES.items()))
_WORDS = r"unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))"
_PLACE = "('0x' || substr(md5(word), 1, 8))::BIGINT % 1024"


@query(f"""
WITH t(ordem, nome, text) AS (VALUES {_THEME_ROWS}),
c AS (SELECT k, {_PLACE} AS place, count(*) AS n FROM (SELECT doc_id AS k, {_WORDS} AS word FROM documents) GROUP BY ALL),
idf AS (SELECT place, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS weight FROM c GROUP BY place),
tc AS (SELECT ordem, {_PLACE} AS place, count(*) AS n FROM (SELECT ordem, {_WORDS} AS word FROM t) GROUP BY ALL),
tn AS (SELECT ordem, place, n * weight / sqrt(sum((n * weight) ** 2) OVER (PARTITION BY ordem)) AS w
       FROM tc JOIN idf USING (place)),
du AS (SELECT k, place, n * weight AS w FROM c JOIN idf USING (place)),
dn AS (SELECT k, sqrt(sum(w * w)) AS norm FROM du GROUP BY k),
dots AS (SELECT k, ordem, sum(du.w * tn.w) AS dot FROM du JOIN tn USING (place) GROUP BY ALL),
s AS (SELECT doc_id, t.ordem, nome, round(coalesce(dot / nullif(norm, 0), 0), 4) AS score FROM documents CROSS JOIN t
      LEFT JOIN dots ON dots.k = doc_id AND dots.ordem = t.ordem LEFT JOIN dn ON dn.k = doc_id)
SELECT doc_id, nome AS tema_classificado, score AS score_similaridade FROM s
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ordem) = 1""")
def lexical_top1(spark, sf):
    """Documents against the ten theme descriptions, by hashed and weighted words."""
    themes = spark.createDataFrame(
        [(i, n, d) for i, (n, d) in enumerate(THEMES.items())], "ordem int, nome string, text string"
    )
    return sim.lexical_top1(table(spark, sf, "documents"), themes, "doc_id", "text", "nome", "ordem")


@query("""
SELECT documents.doc_id, quality, toxic FROM documents
LEFT JOIN (SELECT doc_id, quality FROM labels) USING (doc_id)
LEFT JOIN (SELECT doc_id, toxic FROM labels WHERE toxic = 0) USING (doc_id)""")
def merge_partials(spark, sf):
    """Two runs that each computed one of the columns, merged onto the ids."""
    labels = table(spark, sf, "labels")
    return enrich.merge_partials(
        table(spark, sf, "documents").select("doc_id"),
        [labels.select("doc_id", "quality"), labels.where("toxic = 0").select("doc_id", "toxic")],
        "doc_id",
    )


_UPSERT_SQL = """
SELECT coalesce(t.doc_id, u.doc_id) AS doc_id,
       CASE WHEN u.doc_id IS NOT NULL THEN u.quality ELSE t.quality END AS quality, t.toxic
FROM labels t FULL JOIN (SELECT doc_id, (n_chars % 7)::INTEGER AS quality FROM documents WHERE lang = 'en') u
ON t.doc_id = u.doc_id"""


def _upserted(spark, sf, **kw):
    updates = (
        table(spark, sf, "documents")
        .where("lang = 'en'")
        .select("doc_id", (F.col("n_chars") % 7).cast("int").alias("quality"))
    )
    return merge.upsert(table(spark, sf, "labels"), updates, ["doc_id"], **kw)


@query(_UPSERT_SQL)
def upsert(spark, sf):
    return _upserted(spark, sf)


@query(_UPSERT_SQL)
def upsert_large(spark, sf):
    """The same when the updates are too large to broadcast."""
    return _upserted(spark, sf, max_bytes=0)


@query("""
SELECT documents.doc_id, coalesce(quality::VARCHAR, CASE WHEN lang <> 'es' THEN lang || ' ' || n_chars END) AS rotulo,
       quality::VARCHAR AS rotulo_original
FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id""")
def backfill_null(spark, sf):
    """Fill what is null where a detail was found; the state before is kept in its own column."""
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    target = lookup_join(documents, table(spark, sf, "labels"), ["doc_id"], "left").select(
        "doc_id", F.col("quality").cast("string").alias("rotulo")
    )
    found = documents.where("lang <> 'es'").select(
        "doc_id", F.concat("lang", F.lit(" "), "n_chars").alias("rotulo")
    )
    return merge.backfill(merge.audit_copy(target, "rotulo"), found, "doc_id", "rotulo")
