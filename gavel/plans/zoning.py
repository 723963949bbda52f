"""Staff reports of land-use items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import ColumnLike, indexes, islands, let, lines_of, strip
from ..functions.text import is_land_use, land_use_type

CODE = r"^([A-Z]{1,4}(?:-\d+)?)"
# Words that end the findings, and page-foot residue.
FINDINGS_END = r"RECOMMENDATION|PREPARED BY|CONTACT|DEVELOPMENT COORDINATION"
FOOT = r"(?i)(\s*LOCATION MAP:)?\s*REZONING STAFF REPORT\s*REZ-\d{2}-\s*\d+\s*$"
WAIVER_START = r"PREVIOUSLY APPROVED WAIVERS|NEW WAIVER|WAIVER\(S\) REQUESTED"


def report_rank(title: ColumnLike) -> Column:
    """Newest dated title first, then undated ones by length."""
    t = F.col(title) if isinstance(title, str) else title
    part = lambda i: F.regexp_extract(t, r"(\d{2})\.(\d{2})\.(\d{2,4})", i)
    year = F.when(F.length(part(3)) == 2, F.concat(F.lit("20"), part(3))).otherwise(part(3))
    date = F.try_to_timestamp(F.concat_ws("-", year, part(1), part(2)), F.lit("yyyy-MM-dd")).cast("date")
    return F.struct(date.isNotNull().alias("dated"), date.alias("date"), F.length(t).alias("length"))


def latest_reports(items: DataFrame, docs: DataFrame, keys: list[str]) -> DataFrame:
    """The newest final staff report of each land-use item.

    items: keys, file_number, title; docs: keys, doc_title, doc_pos, url.
    """
    land = items.where(is_land_use("file_number", "title")).withColumn("land_use_type", land_use_type("file_number"))
    finals = docs.where(F.upper("doc_title").contains("STAFF REPORT FINAL"))
    best = finals.groupBy(*keys).agg(
        F.max_by(F.struct("doc_title", "url"), F.struct(report_rank("doc_title"), -F.col("doc_pos"))).alias("report")
    )
    return land.join(best, keys).select(*land.columns, "report.doc_title", "report.url")


def zoning(text: ColumnLike) -> Column:
    """Struct(current, requested, future_land_use); later lines override earlier ones."""
    both = lambda x: x.contains("CURRENT ZONING:") & x.contains("REQUESTED ZONING:")
    code = lambda x: F.nullif(F.regexp_extract(x, CODE, 1), F.lit(""))
    after = lambda x, label: strip(F.replace(x, F.lit(label), F.lit("")))
    last = lambda values: F.try_element_at(F.filter(values, lambda v: v.isNotNull()), F.lit(-1))

    def read(lines):
        def found(label, end, alone_too):
            def at(i):
                line, pieces = F.get(lines, i), F.split(F.get(lines, i + 1), r"\)\s+")
                from_pair = F.when(both(line) & (F.size(pieces) >= 2), code(F.element_at(pieces, end)))
                alone = line.startswith(label) & (F.lit(alone_too) | ~both(line))
                return F.coalesce(F.when(alone, code(after(line, label))), from_pair)

            return last(F.transform(indexes(lines), at))

        land = F.transform(lines, lambda x: F.nullif(strip(F.regexp_extract(x, r"FUTURE LAND USE:\s*([^(]+)", 1)), F.lit("")))
        return F.struct(
            found("CURRENT ZONING:", 1, False).alias("current_zoning"),
            found("REQUESTED ZONING:", -1, True).alias("requested_zoning"),
            last(land).alias("future_land_use"),
        )

    return let(lines_of(text), read)


def waivers_and_findings(text: ColumnLike, longest: int = 16) -> Column:
    """Struct(waivers, findings): waiver blocks up to the findings, findings to a stop word."""
    first = lambda xs, test: F.try_element_at(F.filter(indexes(xs), lambda i: test(F.upper(F.get(xs, i)))), F.lit(1))

    def read(lines, stop):
        before = F.slice(lines, 1, F.coalesce(stop, F.size(lines)))

        def blocks(ls):
            starts = F.filter(indexes(ls), lambda i: F.upper(F.get(ls, i)).rlike(WAIVER_START))
            return F.transform(islands(ls, starts), lambda b: F.array_join(b, " "))

        def said(tail):
            kept = F.slice(tail, 1, F.coalesce(first(tail, lambda u: u.rlike(FINDINGS_END)), F.size(tail)))
            return F.array_join(F.concat(F.array(F.get(lines, stop)), kept), " ")

        findings = let(F.slice(lines, stop + 2, longest), said)
        return F.struct(
            let(before, blocks).alias("waivers"),
            F.when(stop.isNotNull(), strip(F.regexp_replace(findings, FOOT, ""))).alias("findings"),
        )

    return let(lines_of(text), lambda ls: let(first(ls, lambda u: u.contains("FINDINGS:")), lambda st: read(ls, st)))


def attach_reports(items: DataFrame, reports: DataFrame, key: str) -> DataFrame:
    """Report fields on their item; the first report per item wins."""
    first = reports.groupBy(key).agg(F.min_by(F.struct(*[c for c in reports.columns if c != key]), "doc_title").alias("staff_report"))
    return items.join(first, key, "left")
