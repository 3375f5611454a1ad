"""Text expressions. All run inside the JVM; none goes through a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# A byte pair that can start a UTF-8 character, seen as two latin-1 characters. Text without
# one is not UTF-8 that was read as latin-1.
_PAIR = r"[\u00C2-\u00F4][\u0080-\u00BF]"
# Characters that may change under normal form C; all below are in that form already.
_MARKS = r"[^\x00-\u02FF]"


def _beyond_ascii(col: Column) -> Column:
    """True if some character takes more than one byte: a cheap test, no pattern needed."""
    return F.octet_length(col) != F.char_length(col)


def _read_again(col: Column) -> Column:
    # the pattern guards `encode`, which raises on characters it cannot write
    again = F.try_validate_utf8(F.encode(col, "ISO-8859-1").cast("string"))
    return F.when(col.rlike(r"^[\x00-\xFF]*+\z"), F.coalesce(again, col)).otherwise(col)


def _composed(col: Column) -> Column:
    return F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), col, F.lit(False))


def repair_mojibake(col: Column) -> Column:
    """UTF-8 text that was read as latin-1 is read again as UTF-8.

    Text that holds characters outside latin-1, or whose bytes are not UTF-8, is kept.
    """
    return F.when(_beyond_ascii(col) & col.rlike(_PAIR), _read_again(col)).otherwise(col)


def nfc(col: Column) -> Column:
    """Unicode normal form C, by the ICU library that ships with Spark."""
    return F.when(_beyond_ascii(col) & col.rlike(_MARKS), _composed(col)).otherwise(col)


def standardise(col: Column) -> Column:
    """Repaired, composed, upper-case text. Most text needs the last step only."""
    suspect = _beyond_ascii(col) & col.rlike(f"{_PAIR}|{_MARKS}")
    return F.upper(F.when(suspect, _composed(_read_again(col))).otherwise(col))


def blank_to_null(col: Column) -> Column:
    """An empty text is a missing text (blanks are kept)."""
    return F.nullif(col, F.lit(""))


def filled(col: Column, default: str) -> Column:
    """Trimmed upper-case text, or the default if nothing is left."""
    return F.coalesce(F.nullif(F.upper(F.trim(col)), F.lit("")), F.lit(default))


def strip(col: Column) -> Column:
    """Without white space of any kind at both ends (`trim` takes away spaces only)."""
    return F.regexp_replace(col, r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+\z", "")


def not_blank(col: Column) -> Column:
    return col.isNotNull() & (F.trim(col) != "")


def two_way(condition: Column, yes: str = "Sim", no: str = "Não") -> Column:
    """Label of a condition; an undecided condition counts as no."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def three_way(flag: Column, true: str, false: str, unknown: str) -> Column:
    return F.when(flag, F.lit(true)).when(~flag, F.lit(false)).otherwise(F.lit(unknown))


def item_label(kind: Column, number: Column, year: Column) -> Column:
    """`PEC 32/2015`; null if any part is missing."""
    return F.concat(
        kind.cast("string"), F.lit(" "), number.cast("string"), F.lit("/"), year.cast("string")
    )


def first_item_label(*lists: Column) -> Column:
    """Label of the first element of the first list that is not empty."""

    def label(items: Column) -> Column:
        head = F.get(items, F.lit(0))
        return item_label(head["siglaTipo"], head["numero"], head["ano"])

    return F.coalesce(*[label(items) for items in lists])


def prompt(short: Column, long: Column, short_title: str, long_title: str, instruction: str) -> Column:
    """Request text: the short text, the long one if there is any, the instruction."""
    head = F.concat(F.lit(short_title), strip(short))
    detail = strip(long)
    body = F.when(detail != "", F.concat(head, F.lit("\n\n" + long_title), detail)).otherwise(head)
    return F.concat(body, F.lit("\n\n" + instruction))


def query_text(col: Column) -> Column:
    """Role prefix of a text that is to be classified."""
    return F.concat(F.lit("query: "), col)


def passage_text(col: Column) -> Column:
    """Role prefix of a reference text."""
    return F.concat(F.lit("passage: "), col)


def escape_html(col: Column) -> Column:
    out = F.replace(col, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))
