"""Exact vector classification and search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.vectors import cosine
from sedimenta.operators.joins import lookup_join
from sedimenta.session import stage
from sedimenta.sources.landing import column

LABEL_BLOCK = 8192  # labels that one scoring function holds


def label_scorer(vectors: Sequence[Sequence[float]]):
    """Arrow UDF: vector -> (position of the best label, its inner product).

    One matrix product per Arrow batch. The first label wins a tie.
    """
    import numpy as np

    matrix = np.asarray(vectors, dtype="float64").T.copy()

    @F.arrow_udf("struct<best: int, score: double>")
    def score(items):
        import numpy as np
        import pyarrow as pa

        present = items.is_valid().to_numpy(zero_copy_only=False)
        flat = items.drop_null().flatten().to_numpy(zero_copy_only=False)
        products = flat.reshape(-1, matrix.shape[0]).astype("float64") @ matrix
        winner = products.argmax(axis=1)
        best = np.zeros(len(items), dtype="int32")
        value = np.zeros(len(items), dtype="float64")
        best[present] = winner
        value[present] = products[np.arange(len(winner)), winner]
        return pa.StructArray.from_arrays(
            [pa.array(best, mask=~present), pa.array(value, mask=~present)], ["best", "score"]
        )

    return score


def classify_top1(
    items: DataFrame,
    labels: Sequence[tuple[str, Sequence[float]]],
    vector: str = "embedding",
    label_as: str = "tema_classificado",
    score_as: str = "score_similaridade",
    block: int = LABEL_BLOCK,
) -> DataFrame:
    """Most similar label of each item and the score with four decimals; the first label wins a tie.

    The labels (name, unit vector) are configuration and sit in scoring functions of `block` labels
    each; the items are not moved, so the work is one pass over the vector column whatever the
    number of items.
    """
    best = None
    for start in range(0, len(labels), block):
        part = labels[start : start + block]
        names = F.array(*[F.lit(n) for n, _ in part])
        top = label_scorer([v for _, v in part])(column(vector))
        found = F.struct(top["score"].alias("score"), F.get(names, top["best"]).alias("name"))
        better = None if best is None else (best["score"].isNull() | (found["score"] > best["score"]))
        best = found if best is None else F.when(better, found).otherwise(best)
    scored = items.withColumn("__top", best)
    return (
        scored.withColumn(label_as, F.col("__top.name"))
        .withColumn(score_as, F.round(F.col("__top.score"), 4))
        .drop("__top")
    )


def collect_labels(labels: DataFrame, name: str, vector: str, order: str) -> list[tuple]:
    """Label vectors as configuration: (name, vector) in the order that breaks ties."""
    chosen = labels.select(column(name).alias("n"), column(vector).alias("v"), column(order).alias("o"))
    return [(r["n"], r["v"]) for r in chosen.orderBy("o").collect()]


def distribution(df: DataFrame, label: str, total_as: str = "total") -> DataFrame:
    """Rows per label, most frequent first."""
    return df.groupBy(column(label)).agg(F.count(F.lit(1)).alias(total_as)).orderBy(F.desc(total_as), label)


def label_top(df: DataFrame, label: str, value: str, score: str, key: str, k: int = 10) -> DataFrame:
    """The k best rows of one label."""
    return df.where(column(label) == value).orderBy(F.desc(score), key).limit(k)


def nearest(
    df: DataFrame, vector: str, query: Column, key: str, k: int = 10, as_: str = "similaridade"
) -> DataFrame:
    """The k rows with the highest cosine to the query vector: exact, one pass.

    Every task keeps its k best rows, so k rows per task are all that moves.
    """
    scored = df.withColumn(as_, cosine(column(vector), query))
    return scored.where(F.col(as_).isNotNull()).orderBy(F.desc(as_), key).limit(k)


def place_counter(size: int):
    """Arrow UDF: the words of a text -> how often they fall to each of `size` places, by place.

    The place is taken from the MD5 of the word, which is computed once for all its occurrences in an Arrow batch.
    """

    @F.arrow_udf("array<struct<place: bigint, n: bigint>>")
    def count(items):
        import hashlib

        import numpy as np
        import pyarrow as pa

        words = items.flatten().cast(pa.binary()).dictionary_encode()
        marks = (hashlib.md5(w, usedforsecurity=False).digest()[:4] for w in words.dictionary.to_pylist())
        place = np.array([int.from_bytes(m, "big") % size for m in marks], "int64")
        row = np.repeat(np.arange(len(items)), items.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        found, n = np.unique(row * size + place[words.indices.to_numpy(zero_copy_only=False)], return_counts=True)
        ends = np.searchsorted(found, np.arange(len(items) + 1) * size).astype("int32")
        pairs = pa.StructArray.from_arrays([pa.array(found % size), pa.array(n.astype("int64"))], ["place", "n"])
        return pa.ListArray.from_arrays(pa.array(ends), pairs)

    return count


def _places(text: str, size: int) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(column(text), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return place_counter(size)(words)


def word_counts(df: DataFrame, key: str, text: str, size: int = 1024) -> DataFrame:
    """(key, place, n): how often words of a text fall to each of `size` places.

    Words are runs of letters and digits in lower case; the place is taken from the MD5 of the word.
    """
    return _sums(df.select(column(key), _places(text, size).alias("of")), key)


def _sums(rows: DataFrame, key: str) -> DataFrame:
    pairs = rows.select(column(key), F.explode("of").alias("p")).select(column(key), "p.place", "p.n")
    return pairs.groupBy(column(key), "place").agg(F.sum("n").alias("n"))


def lexical_weights(counts: DataFrame, texts: int) -> DataFrame:
    """(place, weight): the fewer texts have a word there, the more it counts. At most one row per place."""
    return counts.groupBy("place").agg(F.ln((F.lit(texts) + 1.0) / (F.count(F.lit(1)) + 1.0)).alias("weight"))


def lexical_scorer(weights: dict[int, float], labels: Sequence[dict[int, float]], size: int):
    """Arrow UDF: places of a text with their counts -> (length of its weighted vector, its inner products with the labels)."""
    import numpy as np

    weight, matrix = np.zeros(size), np.zeros((size, len(labels)))
    weight[list(weights)] = list(weights.values())
    for i, label in enumerate(labels):
        matrix[list(label), i] = list(label.values())

    @F.arrow_udf("struct<norm: double, dots: array<double>>")
    def score(items):
        import numpy as np
        import pyarrow as pa

        pairs = items.flatten()
        place, n = (pairs.field(f).to_numpy(zero_copy_only=False) for f in ("place", "n"))
        row = np.repeat(np.arange(len(items)), items.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        w = n * weight[place]
        norm = np.sqrt(np.bincount(row, w * w, len(items)))
        dots = np.stack([np.bincount(row, w * m[place], len(items)) for m in matrix.T], axis=1)
        ends = np.arange(len(items) + 1, dtype="int32") * dots.shape[1]
        every = pa.ListArray.from_arrays(pa.array(ends), pa.array(dots.ravel()))
        return pa.StructArray.from_arrays([pa.array(norm), every], ["norm", "dots"])

    return score


def lexical_top1(
    items: DataFrame, labels: DataFrame, key: str, text: str, name: str, order: str, size: int = 1024
) -> DataFrame:
    """key, tema_classificado, score_similaridade: the label whose words resemble the item's most.

    A stand-in for a neural encoder: hashed, weighted word counts and their cosine. `labels` (name, text,
    order) are configuration. The words of an item are counted inside its row and written once, as places with counts; rows
    move only where a key is repeated, and their counts are added up. Ties go to the first label, and an item without
    any common word, or without a key, to the first as well.
    """
    rows = stage(items.select(column(key), _places(text, size).alias("of")), "places")
    alone, shared = rows, None
    repeated = rows.groupBy(column(key)).agg(F.count(F.lit(1)).alias("__n")).where((F.col("__n") > 1) | column(key).isNull())
    if repeated.head(1):
        keys = stage(repeated.where(column(key).isNotNull()).select(column(key)), "repeated")
        alone = lookup_join(rows.where(column(key).isNotNull()), keys, [key], "left_anti")
        shared = lookup_join(rows, keys, [key], "left_semi").unionByName(rows.where(column(key).isNull()))
    counts = alone.select(F.explode("of.place").alias("place"))
    if shared is not None:
        sums = stage(_sums(shared, key), "sums")
        counts = counts.unionByName(sums.select("place"))
    weights = {r["place"]: r["weight"] for r in lexical_weights(counts, rows.count()).collect()}  # at most `size` rows

    every = [r["o"] for r in labels.select(column(order).alias("o")).orderBy("o").collect()]
    asked: dict = {o: {} for o in every}
    for r in word_counts(labels, order, text, size).collect():
        if r["place"] in weights:
            asked[r[order]][r["place"]] = r["n"] * weights[r["place"]]
    norms = {o: sum(w * w for w in of.values()) ** 0.5 for o, of in asked.items()}
    units = [{p: w / norms[o] for p, w in asked[o].items()} if norms[o] else {} for o in every]
    score = lexical_scorer(weights, units, size)

    scored = alone.select(column(key), score(F.col("of")).alias("__s"))
    if shared is not None:
        pairs = F.sort_array(F.collect_list(F.struct("place", "n")))
        merged = sums.where(column(key).isNotNull()).groupBy(column(key)).agg(pairs.alias("of"))
        merged = merged.select(column(key), score(F.col("of")).alias("__s"))
        scored = scored.unionByName(shared.select(column(key)).join(merged, key, "left"))
    parts = [F.try_divide(F.get("__s.dots", F.lit(i)), F.col("__s.norm")) for i in range(len(every))]
    scores = [F.round(F.coalesce(p, F.lit(0.0)), 4).alias(f"s{i}") for i, p in enumerate(parts)]
    scored = scored.select(column(key), *scores)
    best = F.greatest(*[F.col(f"s{i}") for i in range(len(every))])
    which = F.coalesce(*[F.when(F.col(f"s{i}") == best, F.lit(o)) for i, o in enumerate(every)])
    found = scored.select(column(key), which.alias(order), best.alias("score_similaridade"))
    names = labels.select(column(order), column(name).alias("tema_classificado"))
    return found.join(F.broadcast(names), order).select(column(key), "tema_classificado", "score_similaridade")
