"""Document manifest: keys, hashes, types, stable links, status counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.base import ColumnLike, col, let
from ..functions.text import content_type, object_key, public_url, slug
from ..operators.keyed import carry_forward_column
from ..session import stored


def content_hash(content: ColumnLike) -> Column:
    return F.substring(F.sha2(col(content), 256), 1, 12)


def is_error_page(content: ColumnLike, size: ColumnLike) -> Column:
    """Small body that is HTML where a document was expected."""
    head = F.decode(F.substring(col(content), 1, 200), "ISO-8859-1")
    not_pdf = ~head.startswith("%P")
    return not_pdf & (col(size) < 10_000) & (head.contains("<!DOCTYPE") | head.contains("<html"))


def manifest(docs: DataFrame, base: str) -> DataFrame:
    """docs: date, meeting_id, item_id, title, url, content (bytes or text), size."""
    key = object_key("date", "meeting_id", "item_id", "title")
    status = F.when(is_error_page("content", "size"), "failed").otherwise("uploaded")
    return docs.withColumn("key", key).select(
        "date",
        "meeting_id",
        "item_id",
        "title",
        "url",
        F.md5("url").alias("cache_name"),
        "key",
        public_url(F.lit(base), "key").alias("public_url"),
        content_type("key").alias("content_type"),
        content_hash("content").alias("content_hash"),
        "size",
        status.alias("status"),
    )


def key_collisions(rows: DataFrame) -> DataFrame:
    """Keys that more than one document claims."""
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") > 1)


def status_summary(rows: DataFrame, meeting: str = "meeting_id") -> DataFrame:
    """Items with documents and counts by status per meeting."""
    per_item = rows.groupBy(meeting, "item_id").agg(
        *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in ("uploaded", "skipped", "failed")]
    )
    return per_item.groupBy(meeting).agg(
        F.count(F.lit(1)).alias("items_with_docs"),
        *[F.sum(s).alias(s) for s in ("uploaded", "skipped", "failed")],
    )


def mark_skipped(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Documents whose key is already stored with the same hash are skipped."""
    known = stored.select("key", "content_hash").distinct().withColumn("_known", F.lit(True))
    joined = rows.join(known, ["key", "content_hash"], "left")
    return joined.withColumn("status", F.when(F.col("_known"), "skipped").otherwise(F.col("status"))).select(*rows.columns)


def carry_links(new: DataFrame, old: DataFrame, item: str = "item_id", title: str = "title", link: str = "mirrored_url") -> DataFrame:
    """A new snapshot keeps the stable link of the same item and title."""
    n, o = new.withColumn("_slug", slug(title)), old.withColumn("_slug", slug(title))
    return carry_forward_column(n, o.select(item, "_slug", link), [item, "_slug"], link).drop("_slug")


GRAM = 5


def _pieces(text: Column, sizes) -> Column:
    """Distinct substrings of the given sizes, tagged with their size."""

    def of(t):
        one = lambda n: F.when(
            F.length(t) >= n,
            F.transform(F.sequence(F.lit(1), F.length(t) - (n - 1)), lambda i: F.concat(F.lit(f"{n}:"), F.substr(t, i, F.lit(n)))),
        ).otherwise(F.array().cast("array<string>"))
        return F.array_distinct(F.concat(*[one(n) for n in sizes]))

    return let(text, of)


def _substrings(number: Column) -> Column:
    """Every substring of a short identifier."""
    starts = lambda t: F.sequence(F.lit(1), F.length(t))
    of = lambda t: F.flatten(F.transform(starts(t), lambda i: F.transform(F.sequence(F.lit(1), F.length(t) - i + 1), lambda n: F.substr(t, i, n))))
    return let(number, lambda t: F.when(F.length(t) > 0, F.array_distinct(of(t))).otherwise(F.array().cast("array<string>")))


#: Meetings with at most this many pairs of a link and an item are compared as they are.
FEW_PAIRS = 1000
#: Meetings with more pairs, up to this number of meetings, are broadcast.
FEW_MEETINGS = 100_000


def _squeezed(text: str) -> Column:
    return F.regexp_replace(F.lower(F.col(text)), r"[^a-z0-9]", "")


def link_items(links: DataFrame, items: DataFrame, meeting: str) -> DataFrame:
    """Resolve document links to agenda items of the same meeting in three tiers.

    Tier 1 compares numbers (either holds the other), tier 2 the link text inside
    the item text, tier 3 the same on letters and digits only; the first tier that
    hits wins, then the lowest item number.  Meetings are counted first: where links
    times items are few, a link meets its meeting's items as one array; in the others
    containment is an equi-join on pieces of the texts.
    links: meeting, link_id, number, text; items: meeting, item_id, item_no, text.
    """
    count = lambda df, name: df.groupBy(meeting).agg(F.count(F.lit(1)).alias(name))
    sizes = count(links, "_links").join(count(items, "_items"), meeting)
    large = stored(sizes.where(F.col("_links") * F.col("_items") > FEW_PAIRS).select(meeting), "large-meetings")
    n = large.count()
    if n == 0:
        return _link_few(links, items, meeting)
    named = F.broadcast(large) if n <= FEW_MEETINGS else large
    part = lambda df, how: df.join(named, meeting, how)
    few = _link_few(part(links, "left_anti"), part(items, "left_anti"), meeting)
    return few.unionByName(_link_many(part(links, "left_semi"), part(items, "left_semi"), meeting))


def _link_few(links: DataFrame, items: DataFrame, meeting: str) -> DataFrame:
    """Every link against the array of its meeting's items, which is short: FEW_PAIRS at most if there is a link."""
    i = items.select(meeting, "item_no", "item_id", F.lower("text").alias("it"), _squeezed("text").alias("iq"))
    wanted = i.join(links.select(meeting).distinct(), meeting, "left_semi")  # a meeting without links may have any number of items
    listed = wanted.groupBy(meeting).agg(F.collect_list(F.struct("item_no", "item_id", "it", "iq")).alias("_items"))
    number, lt, lq = F.col("number"), F.col("_lt"), F.col("_lq")

    def hit(x):
        same = (F.length(number) > 0) & (F.length(x["item_id"]) > 0) & (x["item_id"].contains(number) | number.contains(x["item_id"]))
        plain = (F.length(lt) > 0) & x["it"].contains(lt)
        tier = F.when(same, 1).when(plain, 2).when((F.length(lq) > 0) & x["iq"].contains(lq), 3)
        return F.struct(tier.alias("tier"), x["item_no"].alias("item_no"), x["item_id"].alias("item_id"))

    asked = links.withColumn("_lt", F.lower("text")).withColumn("_lq", _squeezed("text")).join(listed, meeting, "left")
    best = F.array_min(F.filter(F.transform("_items", hit), lambda h: h["tier"].isNotNull()))
    return asked.withColumn("b", best).select(*links.columns, "b.item_id", "b.tier")


def _link_many(links: DataFrame, items: DataFrame, meeting: str) -> DataFrame:
    """The same by equi-joins: an identifier meets the substrings of the other one, and a text meets the items that
    hold its rarest five-letter piece, so a meeting is never paired with itself."""
    out_columns = links.columns
    links = links.withColumn("_number", F.coalesce("number", F.lit(""))).withColumn("lt", F.coalesce(F.lower("text"), F.lit("")))
    squeeze = lambda c: F.regexp_replace(F.lower(c), r"[^a-z0-9]", "")
    asked = links.select(meeting, F.col("_number").alias("number"), "lt").distinct().withColumn("lq", squeeze(F.col("lt")))
    i = items.select(meeting, "item_id", "item_no", F.lower("text").alias("it")).withColumn("iq", squeeze(F.col("it")))
    best = F.min(F.struct("tier", "item_no", "item_id")).alias("b")
    by = [meeting, "number", "lt"]

    ids = i.groupBy(meeting, "item_id").agg(F.min("item_no").alias("item_no")).withColumn("tier", F.lit(1))
    numbers = asked.select(meeting, "number").where(F.length("number") > 0).distinct()
    inside = numbers.join(ids.select("*", F.explode(_substrings(F.col("item_id"))).alias("number")), [meeting, "number"])
    around = numbers.select("*", F.explode(_substrings(F.col("number"))).alias("item_id")).join(ids, [meeting, "item_id"])
    tier1 = inside.unionByName(around).groupBy(meeting, "number").agg(best)
    tier1 = asked.join(tier1, [meeting, "number"]).select(*by, "b")

    texts = asked.select(meeting, "lt", "lq").where(F.length("lt") > 0).distinct()
    # text without letters or digits can only match as it stands
    probe = F.when(F.length("lq") > 0, F.col("lq")).otherwise(F.col("lt"))
    size = F.least(F.length(probe), F.lit(GRAM))
    mine = texts.withColumn("_probe", probe).withColumn("_size", size)
    mine = mine.select(
        meeting, "lt", "lq",
        F.explode(F.filter(_pieces(F.col("_probe"), range(1, GRAM + 1)), lambda p: p.startswith(F.concat(F.col("_size").cast("string"), F.lit(":"))))).alias("piece"),
    )
    distinct_items = i.groupBy(meeting, "it", "iq").agg(F.min(F.struct("item_no", "item_id")).alias("_i")).select(
        meeting, "it", "iq", "_i.item_no", "_i.item_id"
    )
    plain = F.filter(_pieces(F.col("it"), range(1, GRAM + 1)), lambda p: ~F.substring(p, 3, GRAM).rlike("[a-z0-9]"))
    theirs = distinct_items.withColumn("piece", F.explode(F.array_union(_pieces(F.col("iq"), range(1, GRAM + 1)), plain)))
    theirs = theirs.join(mine.select(meeting, "piece").distinct(), [meeting, "piece"], "left_semi")
    seen = theirs.groupBy(meeting, "piece").agg(F.count(F.lit(1)).alias("n"))
    rarest = mine.join(seen, [meeting, "piece"]).groupBy(meeting, "lt", "lq").agg(F.min_by("piece", F.struct("n", "piece")).alias("piece"), F.count(F.lit(1)).alias("found"))
    every = mine.groupBy(meeting, "lt").agg(F.count(F.lit(1)).alias("wanted"))
    # a text of which some piece occurs nowhere is contained nowhere
    rarest = rarest.join(every, [meeting, "lt"]).where(F.col("found") == F.col("wanted")).drop("found", "wanted")
    hits = rarest.join(theirs, [meeting, "piece"])
    tier = F.when(F.col("it").contains(F.col("lt")), 2).when((F.length("lq") > 0) & F.col("iq").contains(F.col("lq")), 3)
    tier23 = hits.withColumn("tier", tier).where(F.col("tier").isNotNull()).groupBy(meeting, "lt").agg(best)
    tier23 = asked.join(tier23, [meeting, "lt"]).select(*by, "b")

    answer = tier1.unionByName(tier23).groupBy(*by).agg(F.min("b").alias("b"))
    out = links.join(answer.withColumnRenamed("number", "_number"), [meeting, "_number", "lt"], "left")
    return out.select(*out_columns, "b.item_id", "b.tier")
