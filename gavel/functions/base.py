"""Small helpers used by every column-function module."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = str | Column


def col(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x: ColumnLike) -> Column:
    """Falsy-coalesce for text: '' counts as missing."""
    return F.nullif(col(x), F.lit(""))


def zero_to_null(x: ColumnLike) -> Column:
    """Falsy-coalesce for numbers: 0 counts as missing."""
    return F.nullif(col(x), F.lit(0))


def first_present(*xs: ColumnLike) -> Column:
    """First argument that is neither null nor ''."""
    return F.coalesce(*[blank_to_null(x) for x in xs])


def capture(text: ColumnLike, pattern: str, group: int = 1) -> Column:
    """Regex group of the first match, null when there is none or it is empty."""
    return F.nullif(F.regexp_extract(col(text), pattern, group), F.lit(""))


def squash(text: ColumnLike) -> Column:
    """Whitespace runs (NBSP included) become one space; ends trimmed."""
    return F.trim(F.regexp_replace(col(text), r"[\s\u00A0]+", " "))


# Fixed value: what counts as whitespace at the ends of a text.
WHITESPACE = " \t\n\x0b\f\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def strip(text: ColumnLike) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.btrim(col(text), F.lit(WHITESPACE))


def let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body` as a variable.

    Inside array lambdas Spark re-evaluates a repeated sub-expression on every use;
    binding it as a lambda variable avoids that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lines_of(text: ColumnLike) -> Column:
    """Trimmed non-blank lines as an array."""
    parts = F.transform(F.split(col(text), "\n"), strip)
    return F.filter(parts, lambda x: F.length(x) > 0)


def indexes(arr: Column) -> Column:
    """0-based index array of `arr`; empty for an empty array."""
    return F.when(F.size(arr) > 0, F.sequence(F.lit(0), F.size(arr) - 1)).otherwise(F.array().cast("array<int>"))


def islands(arr: Column, starts: Column) -> Column:
    """Cut `arr` at the 0-based `starts`; elements before the first start are left out."""
    def cut(a, at):
        def piece(s, k):
            end = F.coalesce(F.try_element_at(at, k + 2), F.size(a))
            return F.slice(a, s + 1, end - s)

        return F.transform(at, piece)

    return let(arr, lambda a: let(starts, lambda at: cut(a, at)))
