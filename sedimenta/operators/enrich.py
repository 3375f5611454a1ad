"""Incremental enrichment: what is pending, in which batches, scored by which function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.text import not_blank
from sedimenta.operators.dedupe import keep_first
from sedimenta.operators.joins import lookup_join
from sedimenta.operators.keys import row_ranges, surrogate_key
from sedimenta.session import stage
from sedimenta.sources.landing import column
from sedimenta.sources.tables import read_table

WAVE_SECONDS = 30.0  # work that an interruption may cost, about, where lots take less
WAVE_TASK_ROWS = 10_000  # rows of a task, where a wave has more than a few for each core

def pending(
    items: DataFrame,
    done: DataFrame | None,
    key: str,
    text: str,
    reprocess: bool = False,
    limit: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Items with text that have no result yet; all of them if there are no results.

    The text filter reaches the scan. `ordered=False` saves the final sort when the order
    does not matter to the consumer.
    """
    out = items.where(not_blank(column(text)))
    if done is not None and not reprocess:
        out = lookup_join(out, done.select(column(key)).distinct(), [key], "left_anti")
    if limit is not None:
        return out.orderBy(column(key)).limit(limit)
    return out.orderBy(column(key)) if ordered else out


def plan_batches(df: DataFrame, key: str, size: int = 50, batch: str = "batch_id") -> DataFrame:
    """Number the items by key and cut them into batches of `size`, counted from 1."""
    numbered = surrogate_key(df, "__n", [key])
    return numbered.withColumn(
        batch, F.floor((F.col("__n") - 1) / size).cast("bigint") + 1
    ).drop("__n")


def unfinished(df: DataFrame, finished: DataFrame, key: str) -> DataFrame:
    """Resume point: by item id, as batch numbers change when new items arrive."""
    return lookup_join(df, finished.select(column(key)).distinct(), [key], "left_anti")


def batch_counters(df: DataFrame, size: int, result: str) -> DataFrame:
    """Items, batches, and items with and without a result."""
    ok = F.count(column(result))
    return df.agg(
        F.count(F.lit(1)).alias("items"),
        F.ceil(F.count(F.lit(1)) / size).cast("bigint").alias("batches"),
        ok.alias("ok"),
        (F.count(F.lit(1)) - ok).alias("failed"),
    )


def enrich_batches(
    df: DataFrame,
    load: Callable[[], Callable],
    schema: T.StructType | str,
    chunk: int = 32,
    name: str | None = None,
) -> DataFrame:
    """Score the rows with a user's function, `chunk` rows at a time.

    `load()` returns the function pandas.DataFrame -> pandas.DataFrame; it is called when a
    Python worker first needs it, and its result is kept for later tasks of that worker under
    `name` (give one to have a model loaded once per worker rather than once per task).
    """

    def score(frames: Iterator) -> Iterator:
        import sys
        import types

        if name is None:
            fn = load()
        else:
            kept = sys.modules.setdefault("_sedimenta_loaded", types.ModuleType("_sedimenta_loaded"))
            if not hasattr(kept, name):
                setattr(kept, name, load())
            fn = getattr(kept, name)
        for frame in frames:
            for start in range(0, len(frame), chunk):
                yield fn(frame.iloc[start : start + chunk])

    return df.mapInPandas(score, schema)


def _spread(rows: DataFrame, n: int) -> DataFrame:
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(parallel, n), -(-n // WAVE_TASK_ROWS)))


def in_lots(items: DataFrame, key: str, size: int) -> Iterator[DataFrame]:
    """The items in the order of their key, `size` at a time, spread over the cluster.

    They are computed and put in order once; a lot is a range of the stored table, so it reads its own part only.
    """
    between, n = row_ranges(items, [key])
    for first in range(1, n + 1, size):
        last = min(first + size - 1, n)
        yield _spread(between(first, last), last - first + 1)


def score_in_lots(
    items: DataFrame, key: str, size: int, score: Callable[[DataFrame], DataFrame], path: str
) -> None:
    """Score the items and append the results to the table at `path`, lot after lot in the order of their key.

    When a lot fails, the results of the lots before are in the table, and `unfinished` takes them out of the next run; the
    lot that fails leaves nothing, and those after it are not scored. Lots are scored and committed in waves,
    whole lots by one write: one lot at first, twice as many after a wave of less than half of `WAVE_SECONDS`. So the
    number of jobs does not follow the number of lots, and an interruption costs the wave that it hits. A wave that
    fails leaves nothing and is halved, until the failure is that of one lot, which is raised: the items of the
    good lots among it may be scored more than once.
    """
    between, n = row_ranges(items, [key])
    lots = -(-n // size)
    at, wave, bad = 0, 1, 0  # lots that are stored, lots of the next wave, end of a wave that failed
    while at < lots:
        now = min(wave, lots - at) if at >= bad else max(1, (bad - at) // 2)
        first, last = at * size + 1, min((at + now) * size, n)
        began = time.monotonic()
        try:
            score(_spread(between(first, last), last - first + 1)).write.mode("append").parquet(path)
        except Exception:
            if now == 1:
                raise
            bad = at + now
            continue
        at += now
        took = time.monotonic() - began
        if took < WAVE_SECONDS / 2 and now >= wave:
            wave *= 2
        elif took > WAVE_SECONDS:
            wave = max(1, now // 2)


ANSWERS = "result string, provider string, error string, asked array<string>"


def ask_in_turn(
    items: DataFrame,
    providers: Sequence[tuple[str, Callable[[str], str]]],
    exhausted: Callable[[Exception], bool],
    key: str,
    text: str,
    path: str,
    size: int = 1000,
) -> DataFrame:
    """Answers of a chain of providers: key, result, provider, error, asked (the providers that were called), lot.

    Items go out in lots, and a lot to one provider after the other, each getting what is still open. A provider
    that reports exhaustion is not called again by the task that saw it, and once its refusals are stored, by no
    task at all: it is written to `path`/spent, and later lots, and later runs over the same `path`, pass it
    over. Any other error fails the row, not the run: its result is null and the error is kept. Rows that find all
    providers exhausted get no result either, and are asked again by a later run; all other answers are stored in
    `path`/answers lot by lot, and an item that has one is not sent out again.

    Keys are unique and not null. Take a new `path` once the providers answer again.
    """
    spark = items.sparkSession
    kind = items.schema[key].dataType
    layout = T.StructType([T.StructField(key, kind), *T.StructType.fromDDL(ANSWERS).fields, T.StructField("lot", T.LongType())])
    answers, marks = f"{path}/answers", f"{path}/spent"
    spent = {r.provider for r in read_table(spark, marks, T.StructType.fromDDL("provider string"), optional=True).collect()}
    before = read_table(spark, answers, layout, optional=True)
    todo = unfinished(items.select(column(key), column(text)), before.where("provider IS NOT NULL"), key)
    earlier = before.agg(F.max("lot")).first()[0] or 0

    def asking(label: str, ask: Callable[[str], str]) -> Callable[[Iterator], Iterator]:
        def run(frames: Iterator) -> Iterator:
            refused = False
            for frame in frames:
                rows = []
                for value, asked in zip(frame[text], frame["asked"]):
                    answer, called = (None, None, None, True), [*asked]
                    if not refused:
                        called.append(label)
                        try:
                            answer = (ask(value), label, None, False)
                        except Exception as e:  # noqa: BLE001 - a user's function may raise anything
                            refused = exhausted(e)
                            if not refused:
                                answer = (None, label, str(e), False)
                    rows.append((*answer, called))
                frame["result"], frame["provider"], frame["error"], frame["open"], frame["asked"] = (
                    [list(c) for c in zip(*rows)] if rows else [[]] * 5
                )
                yield frame

        return run

    sent = f"{text} {items.schema[text].dataType.simpleString()}, {ANSWERS}, open boolean"
    shape = T.StructType([T.StructField(key, kind), *T.StructType.fromDDL(sent).fields])
    for n, lot in enumerate(in_lots(todo, key, size), start=earlier + 1):
        left = lot.withColumn("asked", F.array().cast("array<string>"))
        done = []
        for label, ask in providers:
            if label in spent:
                continue
            told = stage(left.mapInPandas(asking(label, ask), shape), "answers")
            done.append(told.where("NOT open"))
            left = told.where("open").select(column(key), column(text), "asked")
            if not left.head(1):
                break
            spent.add(label)
            spark.createDataFrame([(label,)], "provider string").coalesce(1).write.mode("append").parquet(marks)
        nothing = [F.lit(None).cast("string").alias(c) for c in ("result", "provider")]
        rest = left.select(column(key), *nothing, F.lit("all providers are exhausted").alias("error"), "asked")
        parts = [d.select(column(key), "result", "provider", "error", "asked") for d in done]
        whole = reduce(DataFrame.unionByName, parts, rest).withColumn("lot", F.lit(n).cast("bigint"))
        whole.write.mode("append").parquet(answers)
    stored = read_table(spark, answers, layout, optional=True)
    return keep_first(stored.withColumn("__lacks", F.col("provider").isNull()), [key], ["__lacks", "lot"]).drop("__lacks")


def merge_partials(ids: DataFrame, parts: Sequence[DataFrame], key: str) -> DataFrame:
    """One row per id with whatever partial results exist for it; of several results for an id, one counts."""
    out = ids.distinct()
    for part in parts:
        out = lookup_join(out, keep_first(part, [key]), [key], "left")
    return out
