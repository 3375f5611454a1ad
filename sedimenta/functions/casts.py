"""Tolerant casts: a value that does not parse becomes null, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark's own cast also takes the Java spellings `1d`, `1f` and hexadecimal floats.
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?)\s*$"
_DIGITS = "^[0-9]+$"

# The closed set of boolean spellings.
_TRUE = ("1", "true", "True")
_FALSE = ("0", "false", "False")


def strip_hyphen(col: Column) -> Column:
    """`1228863-64` -> `122886364`. Also drops a minus sign, so it is meant for ids only."""
    return F.replace(col, F.lit("-"), F.lit(""))


def to_double(col: Column, data_type: T.DataType | None = None) -> Column:
    if data_type is None or isinstance(data_type, T.StringType):
        return F.when(col.rlike(_NUMBER), col.try_cast("double"))
    return col.try_cast("double")


def to_long(col: Column, data_type: T.DataType | None = None) -> Column:
    """Whole numbers in any notation (`2.0`, `1e3`); fractions become null.

    The direct cast goes first, so ids above 2^53 keep all their digits.
    """
    if isinstance(data_type, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return col.cast("bigint")
    d = to_double(col, data_type)
    whole = F.when(d % 1 == 0, d.try_cast("bigint"))
    if data_type is None or isinstance(data_type, T.StringType):
        return F.coalesce(col.try_cast("bigint"), whole)
    return whole


def to_bool(col: Column, data_type: T.DataType | None = None) -> Column:
    if isinstance(data_type, T.BooleanType):
        return col
    if isinstance(data_type, T.NumericType):
        return F.when(col == 1, F.lit(True)).when(col == 0, F.lit(False))
    return F.when(col.isin(*_TRUE), F.lit(True)).when(col.isin(*_FALSE), F.lit(False))


def to_timestamp(
    col: Column, data_type: T.DataType | None = None, formats: Sequence[str] = ()
) -> Column:
    """UTC timestamp; an offset in the text is applied. Needs the session zone UTC."""
    if data_type is not None and not isinstance(data_type, T.StringType):
        return col.cast("timestamp")
    return F.coalesce(
        F.try_to_timestamp(col), *[F.try_to_timestamp(col, F.lit(f)) for f in formats]
    )


def convert(
    col: Column, kind: str, data_type: T.DataType, formats: Sequence[str] = ()
) -> Column:
    """The cast that belongs to a column kind of a TableSpec."""
    if kind == "long":
        return to_long(col, data_type)
    if kind == "double":
        return to_double(col, data_type)
    if kind == "bool":
        return to_bool(col, data_type)
    if kind == "timestamp":
        return to_timestamp(col, data_type, formats)
    if kind != "string" or isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return col
    return col.cast("string")


def digits_id(col: Column) -> Column:
    """Number if the text is digits only, else null; too many digits is null too."""
    return F.when(col.rlike(_DIGITS), col.try_cast("bigint"))


def uri_tail(col: Column) -> Column:
    """Last path segment of a URI, null if there is none."""
    return F.nullif(F.substring_index(col, "/", -1), F.lit(""))  # no pattern: one would start at every character


def uri_id(col: Column) -> Column:
    """Number at the end of a URI, null if the last segment is anything else."""
    return digits_id(uri_tail(col))


def valid_id(col: Column, data_type: T.DataType | None = None) -> Column:
    """True where `to_long` gives a number above zero."""
    return F.coalesce(to_long(col, data_type) > 0, F.lit(False))


def amount(col: Column, precision: int = 18, scale: int = 2) -> Column:
    """Money as a decimal, zero if missing."""
    return F.coalesce(col.try_cast(f"decimal({precision},{scale})"), F.lit(0)).cast(
        f"decimal({precision},{scale})"
    )
