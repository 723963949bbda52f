"""Dictionaries of people, organisations and acronyms from agendas and transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.base import ColumnLike, col, let
from ..functions.text import normalize_name, speaker_case
from ..operators.sequence import Position, Sequence

# Wording around a person's name.
PERSON_PATTERNS = (
    r"\b(?:Mr\.|Ms\.|Mrs\.|Dr\.|Detective|Officer|Chief|Director|Coordinator|Chair|Vice Chair|Councilman|Councilwoman|Mayor)"
    r"\s+([A-Z][a-z]+\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)\b",
    r"\bMemorandum from\s+([A-Z][a-z]+\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)?)\b",
    r"\binitiated by\s+([A-Z][a-z]+(?:-[A-Z][a-z]+)?)\b",
    r"\bChair,\s+([A-Z][a-z]+\s+[A-Z][a-z]+)\b",
)
# Words that never belong to a person's name.
NOT_PERSON_WORDS = (
    "file no the city clerk department resolution county ordinance section chapter code "
    "business contract equal opportunity mobility solid waste fire rescue police water special event "
    "permit community engagement quality assurance cost monitoring environmental program management change "
    "order office florida statutes district officer ave blvd st street road properties "
    "services inc llc corporation company industrial zoning mixed use system technologies solutions"
).split()
# Shapes of an organisation's name ({place} is the city the records come from).
ORGANIZATION_PATTERNS = (
    r"\b({place} (?:Police|Fire|Water|Parks and Recreation|Convention|Housing) Department)\b",
    r"\b(Department of (?:Housing|Transportation|Solid Waste|Financial Services|Law|Homeland Security|Interior"
    r"|Environmental Protection|Justice|Health|Veterans Affairs|Defense)(?:\s+and\s+[A-Z][a-zA-Z\s]+)?)\b",
    r"\b(Community Redevelopment Agency(?:\s+of\s+the\s+City\s+of\s+{place})?)\b",
    r"\b(City Council(?:\s+of\s+the\s+City\s+of\s+{place})?)\b",
    r"\b(Law Firm of [A-Z][a-z,\s&.]+(?:P\.A\.|LLC|Inc\.)?)\b",
    r"\b([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,4}\s+(?:Church|School|Center|Hospital|Foundation|Association|Institute|Academy|College|University))\b",
)


def _word_count(x: Column) -> Column:
    return F.size(F.split(x, r"\s+"))


def people_in(text: ColumnLike, extra_stop: tuple[str, ...] = ()) -> Column:
    """Distinct rule-based person names of a text."""
    found = F.concat(*[F.regexp_extract_all(col(text), F.lit("(?U)" + p), F.lit(1)) for p in PERSON_PATTERNS])
    stop = F.split(F.lit(" ".join((*NOT_PERSON_WORDS, *extra_stop))), " ")  # folded to a constant array
    named = F.transform(found, F.trim)
    fit = lambda n: _word_count(n).between(2, 4) & ~F.arrays_overlap(F.split(F.lower(n), r"\s+"), stop)
    return F.array_distinct(F.filter(named, fit))


def organizations_in(text: ColumnLike, place: str) -> Column:
    """Distinct rule-based organisation names of a text."""
    found = F.concat(
        *[F.regexp_extract_all(col(text), F.lit("(?U)" + p.replace("{place}", place)), F.lit(1)) for p in ORGANIZATION_PATTERNS]
    )
    return F.array_distinct(F.filter(F.transform(found, F.trim), lambda n: _word_count(n).between(2, 10)))


def name_rows(texts: DataFrame, doc: str, text: str, names: Column) -> DataFrame:
    return texts.select(doc, F.explode(names).alias("name")).distinct()


def agree(rule_names: DataFrame, model_names: DataFrame, on: list[str]) -> DataFrame:
    """Rules and predictions side by side: both 1.0, rules only 0.9, model only 0.5."""
    r = rule_names.select(*on).distinct().withColumn("_r", F.lit(True))
    m = model_names.select(*on).distinct().withColumn("_m", F.lit(True))
    both = r.join(m, on, "full_outer")
    score = (
        F.when(F.col("_r").isNotNull() & F.col("_m").isNotNull(), 1.0)
        .when(F.col("_r").isNotNull(), 0.9)
        .otherwise(0.5)
    )
    return both.withColumn("confidence", score).drop("_r", "_m")


def entity_stats(found: DataFrame, doc: str, keys: list[str]) -> DataFrame:
    """Frequency, confidence and score per entity; a document counts once per entity."""
    per_doc = found.groupBy(*keys, doc).agg(F.max("confidence").alias("confidence"))
    stats = per_doc.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frequency"),
        F.avg("confidence").alias("_conf"),
        F.count(F.lit(1)).alias("agendas"),
    )
    return stats.select(
        *keys,
        "frequency",
        F.bround("_conf", 2).alias("confidence"),
        F.bround(F.col("frequency") * F.col("_conf"), 2).alias("score"),
        "agendas",
    )


def speaker_stats(segments: DataFrame, speaker: str, doc: str, named_only: bool = True) -> DataFrame:
    """Speaker frequency and spread; pre-counted per file, so no distinct shuffle of rows."""
    rows = segments.where(rules.is_named_speaker(speaker)) if named_only else segments
    per_file = rows.groupBy(speaker_case(speaker).alias("name"), doc).agg(F.count(F.lit(1)).alias("_n"))
    stats = per_file.groupBy("name").agg(F.sum("_n").alias("frequency"), F.count(F.lit(1)).alias("transcripts"))
    return stats.withColumn("score", (F.col("frequency") * F.col("transcripts")).cast("double"))


def merge_speakers(entities: DataFrame, speakers: DataFrame) -> DataFrame:
    """Full outer merge on the lower-cased name; a matched name takes the speaker's casing."""
    e = entities.groupBy(F.lower("name").alias("_key")).agg(
        F.min_by(F.struct("name", "frequency", "confidence", "score", "agendas"), F.struct(-F.col("score"), F.col("name"))).alias("e")
    )
    s = speakers.groupBy(F.lower("name").alias("_key")).agg(
        F.min_by(F.struct("name", "frequency", "score", "transcripts"), F.struct(-F.col("score"), F.col("name"))).alias("s")
    )
    j = e.join(s, "_key", "full_outer")
    zero = F.lit(0)
    return j.select(
        F.coalesce("s.name", "e.name").alias("name"),
        (F.coalesce("e.frequency", zero) + F.coalesce("s.frequency", zero)).alias("frequency"),
        F.when(F.col("s").isNotNull(), 1.0).otherwise(F.col("e.confidence")).alias("confidence"),
        (F.coalesce("e.score", F.lit(0.0)) + F.coalesce("s.score", F.lit(0.0))).alias("score"),
        F.coalesce("e.agendas", zero).alias("agendas"),
        F.coalesce("s.transcripts", zero).alias("transcripts"),
    )


def merge_people(people: DataFrame) -> DataFrame:
    """Variants of one normalised name merged; the variant of lowest rank gives the name."""
    norm = F.lower(normalize_name("name"))
    merged = people.groupBy(norm.alias("normalized")).agg(
        F.min_by("name", F.struct("rank", "name")).alias("name"),
        F.sum("frequency").alias("frequency"),
        F.sum("score").alias("score"),
        F.sum("agendas").alias("agendas"),
        F.sum("transcripts").alias("transcripts"),
        F.count(F.lit(1)).alias("variants"),
        F.max("confidence").alias("_conf"),
    )
    return merged.withColumn("confidence", F.when(F.col("variants") > 1, 1.0).otherwise(F.col("_conf"))).drop("_conf")


def clean_people(people: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(people, businesses, dropped) by name kind."""
    kinds = people.withColumn("kind", rules.name_kind("name"))
    pick = lambda k: kinds.where(F.col("kind") == k).drop("kind")
    return pick("person"), pick("business"), pick("non_person")


def ranked(entities: DataFrame, score: str = "score", name: str = "name") -> DataFrame:
    """Explicit rank by score descending, then name; balanced over the score range.

    Names that share a score are spread by a number that follows their sort order
    (the first three characters), so a long tail of equal scores is cut as well.
    """
    prepared = entities.withColumn("_neg", -F.col(score))
    head = F.lit(0).cast("bigint")
    for i in range(1, 4):
        head = head * 1_114_112 + F.ascii(F.substring(F.col(name), i, 1))
    prepared = prepared.withColumn("_head", head)
    seq = Sequence([], ["_neg", name], ["_neg", "_head"])
    return seq.apply(prepared, rank=Position()).drop("_neg", "_head")


def top(entities: DataFrame, n: int = 20) -> DataFrame:
    return entities.orderBy(F.desc("score"), "name").limit(n)


def acronyms(texts: DataFrame, doc: str, columns: list[str], stop: DataFrame, min_support: int = 2) -> DataFrame:
    """Upper-case tokens of 2–5 letters seen in enough documents, stop words left out."""
    every = F.concat_ws(" ", *columns)
    found = texts.select(doc, F.explode(F.array_distinct(F.regexp_extract_all(every, F.lit(r"(?U)\b([A-Z]{2,5})\b"), F.lit(1)))).alias("token"))
    kept = found.join(stop.select(F.upper("word").alias("token")).distinct(), "token", "left_anti")
    # a token occurs once per document row; documents given in several rows are folded first
    per_doc = kept.groupBy("token", doc).agg(F.lit(1).alias("_one"))
    return per_doc.groupBy("token").agg(F.count(F.lit(1)).alias("meetings")).where(F.col("meetings") >= min_support)


def merge_config(known: DataFrame, found: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(union of both lists, entries that are new)."""
    k, f = known.select(column).distinct(), found.select(column).distinct()
    return k.union(f).distinct(), f.join(k, column, "left_anti")


def surname_index(people: DataFrame) -> DataFrame:
    """Lower-cased surname, hyphen part or first name → its casing."""
    words = F.split("name", r"\s+")
    last = F.element_at(words, -1)
    parts = people.where(F.size(words) >= 2).select(
        F.explode(F.concat(F.split(last, "-"), F.array(F.element_at(words, 1)))).alias("proper")
    )
    return parts.where(F.length("proper") > 0).groupBy(F.lower("proper").alias("word")).agg(F.min("proper").alias("proper"))


def standalone_surnames(names: DataFrame, column: str = "name") -> DataFrame:
    """Full names plus their last word where it is longer than two letters."""
    last = F.element_at(F.split(column, r"\s+"), -1)
    extra = names.where(F.col(column).contains(" ") & (F.length(last) > 2)).select(last.alias(column))
    return names.select(column).union(extra).distinct()


def word_chunks(text: ColumnLike, size: int = 250) -> Column:
    """Non-overlapping chunks of words, the input unit of an outside model."""

    def cut(words):
        places = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / size).cast("int"))
        return F.when(
            F.size(words) > 0, F.transform(places, lambda i: F.array_join(F.slice(words, i * size + 1, size), " "))
        ).otherwise(F.array().cast("array<string>"))

    return let(F.filter(F.split(col(text), r"\s+"), lambda w: F.length(w) > 0), cut)


def build_dictionary(
    agendas: DataFrame, segments: DataFrame, doc: str, text: str, place: str, predictions: DataFrame | None = None,
    area: tuple[str, ...] = (),
) -> dict[str, DataFrame]:
    """The whole dictionary build: extract, score, merge speakers, clean, rank.

    `place` is the city that organisations are named after; neither its words nor those of `area` (its county, say)
    belong to a person's name."""
    stop = tuple(w for name in (place, *area) for w in name.lower().split())
    found = {
        "people": name_rows(agendas, doc, text, people_in(text, stop)),
        "organizations": name_rows(agendas, doc, text, organizations_in(text, place)),
    }
    stats = {}
    for kind, rows in found.items():
        guesses = (
            predictions.where(F.col("label") == kind).select(doc, F.col("text").alias("name"))
            if predictions is not None
            else rows.limit(0)
        )
        stats[kind] = entity_stats(agree(rows, guesses, [doc, "name"]), doc, ["name"])
    people = merge_speakers(stats["people"], speaker_stats(segments, "speaker", doc))
    persons, businesses, dropped = clean_people(people)
    merged = merge_people(ranked(persons))
    more = businesses.select("name", "frequency", "confidence", "score", "agendas")
    return {
        "people": ranked(merged),
        "organizations": ranked(stats["organizations"].unionByName(more)),
        "dropped": dropped,
    }
