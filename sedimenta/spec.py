"""Table specifications and the vocabulary of "unknown" values."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Vocabulary:
    """What stands in for a missing value, by kind of column."""

    # The sentinels are part of the data model and appear in the results.
    text: str = "NÃO INFORMADO"
    code: str = "N/I"
    text_not_applicable: str = "NÃO SE APLICA"
    code_not_applicable: str = "N/A"
    unknown_id: int = -1
    not_applicable_id: int = -3
    year: int = 9999
    date: dt.date = dt.date(9999, 12, 31)
    amount: int = 0

    def member(self, data_type: T.DataType, unknown: bool, code: bool = False):
        """Value of one column in a dimension's "unknown" or "not applicable" row."""
        if isinstance(data_type, T.StringType):
            if unknown:
                return self.code if code else self.text
            return self.code_not_applicable if code else self.text_not_applicable
        if isinstance(data_type, T.DateType):
            return self.date
        if isinstance(data_type, (T.IntegerType, T.LongType, T.ShortType)):
            return self.unknown_id if unknown else self.not_applicable_id
        return None


VOCABULARY = Vocabulary()


@dataclass(frozen=True)
class TableSpec:
    """How one landed table is conformed.

    kinds         kind of a column by its name: 'long', 'double', 'timestamp', 'bool' or
                  'string'; a mapping or a function. Others keep the type they arrive with
    key           columns that identify a row; None means the whole row
    order         columns that decide which of several rows with one key is kept; the
                  remaining columns follow as tie-breakers, so the choice is repeatable
    valid_id      column that must hold a whole number above zero, if any
    strip_hyphen  columns whose hyphens are removed (composite ids such as 12-3)
    strip_kinds   kinds of which all columns lose their hyphens
    keep_case     text columns that are left as they are
    formats       extra timestamp formats, tried in order after ISO 8601
    """

    name: str
    kinds: Mapping[str, str] | Callable[[str], str]
    key: tuple[str, ...] | None = None
    order: tuple[str, ...] = ()
    valid_id: str | None = None
    strip_hyphen: tuple[str, ...] = ()
    strip_kinds: tuple[str, ...] = ()
    keep_case: tuple[str, ...] = ()
    formats: tuple[str, ...] = ()

    def kind(self, column: str) -> str:
        if callable(self.kinds):
            return self.kinds(column)
        return self.kinds.get(column, "as is")

    def strips(self, column: str) -> bool:
        return column in self.strip_hyphen or self.kind(column) in self.strip_kinds


@dataclass(frozen=True)
class DimSpec:
    """A dimension: target column -> source column, surrogate key and natural key."""

    name: str
    key: str
    natural: str
    columns: Mapping[str, str]
    codes: frozenset[str] = frozenset()
    members: Mapping[str, tuple[object, object]] = field(default_factory=dict)


@dataclass(frozen=True)
class DimRef:
    """How a fact finds a dimension: fact column = natural key -> surrogate key."""

    dim: str
    source: str
    natural: str
    key: str
    optional: bool = False


@dataclass(frozen=True)
class FactSpec:
    """A fact: dimension look-ups, date keys, carried columns and constant measures.

    `layout` is the order of the columns where it differs from that.
    """

    name: str
    dims: tuple[DimRef, ...]
    dates: Mapping[str, str] = field(default_factory=dict)
    columns: Mapping[str, str] = field(default_factory=dict)
    constants: Mapping[str, int] = field(default_factory=dict)
    layout: tuple[str, ...] = ()
