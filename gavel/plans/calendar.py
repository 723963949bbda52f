"""Calendar documents: lines from positioned text, then sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import ColumnLike, indexes, let, lines_of
from ..operators.clusters import anchored_starts

# Headings of a calendar document.
MONTH_HEADER = (
    r"(?i)\b(JANUARY|FEBRUARY|MARCH|APRIL|MAY|JUNE|JULY|AUGUST|SEPTEMBER|OCTOBER|NOVEMBER|DECEMBER)"
    r"(?:\s+(?:continued|cont\.))?\s*-\s*(\d{4})"
)
SESSION_HEADER = (
    r"(?i)\b(\d+)\s+(CITY COUNCIL|COMMUNITY REDEVELOPMENT AGENCY|CRA)\s+(REGULAR|WORKSHOP|EVENING|SPECIAL CALL)\s+SESSION"
)
SUB_HEADING = r"(?i)\b(Workshops|Staff Reports & Unfinished Business|Written Staff Reports)\s+\((\d+)\)"


def lines_from_positions(pieces: DataFrame, doc: str, page: str, x: str, y: str, text: str, tolerance: float = 0.2) -> DataFrame:
    """Lines of each page: pieces whose y stays within the tolerance of the line's first.

    A page is the natural bound of the group.
    """
    grouped = pieces.groupBy(doc, page).agg(
        F.array_sort(F.collect_list(F.struct(F.col(y).cast("double").alias("y"), F.col(x).cast("double").alias("x"), F.col(text).alias("t")))).alias("p")
    )
    ys = F.array_sort(F.array_distinct(F.transform("p", lambda q: q["y"])))
    starts = anchored_starts(ys, tolerance, inclusive=False)
    lines = grouped.select(doc, page, "p", F.posexplode(starts).alias("line_no", "line_y"))
    on_line = F.filter("p", lambda q: (q["y"] >= F.col("line_y")) & (q["y"] - F.col("line_y") < tolerance))
    by_x = F.array_sort(F.transform(on_line, lambda q: F.struct(q["x"].alias("x"), q["t"].alias("t"))))
    return lines.select(doc, page, "line_no", F.array_join(F.transform(by_x, lambda q: q["t"]), " ").alias("line"))


def _marks(lines: Column, pattern: str, groups: tuple[int, ...]) -> Column:
    """Lines that match, as (i, v1, v2, …) with the wanted groups."""
    row = lambda s, i: F.struct(i.alias("i"), *[F.regexp_extract(s, pattern, g).alias(f"v{g}") for g in groups])
    return F.filter(F.transform(lines, row), lambda m: m[f"v{groups[0]}"] != "")


def calendar_entries(docs: DataFrame, keep: list[str], text: ColumnLike) -> DataFrame:
    """Text lines with the month, day, body, session and sub-heading they stand under."""

    def read(lines, months, sessions, subs):
        last = lambda marks, i: F.try_element_at(F.filter(marks, lambda m: m["i"] <= i), F.lit(-1))

        def entry(i):
            line, session, month = F.get(lines, i), last(sessions, i), last(months, i)
            return F.struct(
                i.alias("line_no"),
                F.upper(month["v1"]).alias("month"),
                month["v2"].try_cast("int").alias("year"),
                session["v1"].try_cast("int").alias("day"),
                F.upper(session["v2"]).alias("body"),
                F.upper(session["v3"]).alias("session"),
                last(subs, i)["v1"].alias("heading"),
                F.regexp_extract(line, r"(?i)File No\.\s+([A-Z0-9-]+)", 1).alias("file_number"),
                line.alias("text"),
            )

        plain = F.filter(
            indexes(lines),
            lambda i: ~(
                F.get(lines, i).rlike(MONTH_HEADER)
                | F.get(lines, i).rlike(SESSION_HEADER)
                | F.get(lines, i).rlike(SUB_HEADING)
            ),
        )
        return F.filter(F.transform(plain, entry), lambda e: e["month"].isNotNull())

    entries = let(
        lines_of(text),
        lambda ls: let(
            _marks(ls, MONTH_HEADER, (1, 2)),
            lambda ms: let(
                _marks(ls, SESSION_HEADER, (1, 2, 3)),
                lambda ss: let(_marks(ls, SUB_HEADING, (1,)), lambda hs: read(ls, ms, ss, hs)),
            ),
        ),
    )
    return docs.select(*keep, F.explode(entries).alias("e")).select(*keep, "e.*")
