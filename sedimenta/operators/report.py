"""The weekly ranking and its digest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sedimenta.functions.dates import key_of
from sedimenta.functions.text import escape_html
from sedimenta.sources.landing import column


@dataclass(frozen=True)
class Window:
    """Half-open range of days before a reference date: [ref - back, ref - until)."""

    reference: dt.date
    back: int = 23
    until: int = 16

    def of_source(self, date: Column) -> Column:
        """As a range over the source column that the key is made of, so that the scan sees it."""
        first = self.reference - dt.timedelta(days=self.back)
        after = self.reference - dt.timedelta(days=self.until)
        return (date >= F.lit(first)) & (date < F.lit(after))

    def condition(self, key: Column) -> Column:
        """As a range over the stored integer key, which a scan can use to skip data."""
        first = key_of(self.reference - dt.timedelta(days=self.back))
        after = key_of(self.reference - dt.timedelta(days=self.until))
        return (key >= first) & (key < after)


def top_of_window(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    date: str,
    window: Window,
    order: Sequence[Column],
    k: int = 5,
    where: Column | None = None,
) -> DataFrame:
    """Fact rows of a window, joined to its dimensions by surrogate key, best k.

    `dims` maps the key column to the dimension. The window is cut before the joins, so
    these see few rows and Spark picks their kind; each task keeps its k best rows. End `order` with a unique column, so ties are settled.
    """
    out = fact.where(window.condition(column(date)))
    for key, dim in dims.items():
        out = out.join(dim, key)
    if where is not None:
        out = out.where(where)
    return out.orderBy(*order).limit(k)


def ranked(top: DataFrame, order: Sequence[Column], name: str = "posicao") -> DataFrame:
    """Number the rows of a top list (k rows, so one task is enough)."""
    return top.withColumn(name, F.row_number().over(W.orderBy(*order)))


def digest(
    top: DataFrame, rank: str, fields: Sequence[str], card: Column, header: str = "", footer: str = ""
) -> DataFrame:
    """A ranked top list as one row: the list of its rows and one HTML text."""
    rows = F.array_sort(F.collect_list(F.struct(rank, *fields, card.alias("__card"))))
    one = top.agg(rows.alias("rows"))
    return one.select(
        F.size("rows").cast("bigint").alias("itens"),
        F.transform("rows", lambda r: F.struct(r[rank].alias(rank), *[r[f].alias(f) for f in fields])).alias(
            "proposicoes"
        ),
        F.concat(
            F.lit(header),
            F.array_join(F.transform("rows", lambda r: r["__card"]), ""),
            F.lit(footer),
        ).alias("html"),
    )


def html_card(title: Sequence[Column], lines: Sequence[tuple[str, Column]]) -> Column:
    """One entry of the digest; values are escaped."""

    def text(c: Column) -> Column:
        return escape_html(F.coalesce(c.cast("string"), F.lit("")))

    parts = [F.lit('<div class="card"><h2>'), *[text(t) for t in title], F.lit("</h2>")]
    for label, value in lines:
        parts += [F.lit(f"<p><b>{label}</b> "), text(value), F.lit("</p>")]
    return F.concat(*parts, F.lit("</div>"))
