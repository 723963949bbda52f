"""Classification by ordered rules kept as data.

A rule says: in this classifier, at this priority, when `field` matches
`pattern`, answer `label`.  `classify` turns the rules into one CASE expression,
so a whole classifier is a single native column.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import ColumnLike, blank_to_null, col
from .dates import long_date


@dataclass(frozen=True)
class Rule:
    priority: int
    field: str
    pattern: str
    label: str


def classify(rules: list[Rule], fields: dict[str, ColumnLike]) -> Column:
    """Label of the first matching rule in priority order, else null."""
    picks = [
        F.when(col(fields[r.field]).rlike("(?i)" + r.pattern), F.lit(r.label))
        for r in sorted(rules, key=lambda r: r.priority)
        if r.field in fields
    ]
    return F.coalesce(*picks) if picks else F.lit(None).cast("string")


def any_of(text: ColumnLike, patterns: list[str] | tuple[str, ...]) -> Column:
    """True when any pattern occurs; one alternation, one pass over the text."""
    return F.coalesce(col(text).rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(False))


# --- C1: from the mix of file-number prefixes ------------------------------

# Prefixes heard in evening sessions and the share that decides.
EVENING_PREFIXES = ("REZ", "TA", "VAC", "AB")
MAJORITY = 0.6


def file_number_prefix(file_no: ColumnLike) -> Column:
    return F.nullif(F.regexp_extract(col(file_no), r"^([A-Z]+)", 1), F.lit(""))


def type_from_prefix_counts(cra: ColumnLike, evening: ColumnLike, total: ColumnLike) -> Column:
    n = F.nullif(col(total), F.lit(0))
    return (
        F.when(col(cra) / n > MAJORITY, "cra")
        .when(col(evening) / n > MAJORITY, "evening")
        .otherwise("regular")
    )


# --- C2: transcript with its video listing ---------------------------------

# Display name to slug, slug to label.
VIDEO_TYPE_SLUGS = {
    "city council": "regular",
    "workshop": "workshop",
    "evening": "evening",
    "cra": "cra",
    "special": "special",
}
TYPE_LABELS = {
    "regular": "City Council",
    "evening": "Evening Session",
    "cra": "CRA",
    "workshop": "Workshop",
    "special": "Special Meeting",
}


def lookup(key: ColumnLike, table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[col(key)]


def transcript_type(override: ColumnLike, video_type: ColumnLike, title: ColumnLike, date_time: ColumnLike) -> Column:
    vt, t, dt = blank_to_null(video_type), F.upper(col(title)), F.upper(col(date_time))
    from_video = F.when(vt.isNotNull(), F.coalesce(lookup(F.lower(vt), VIDEO_TYPE_SLUGS), F.lit("regular")))
    from_title = F.when(t.contains("WORKSHOP"), "workshop").when(t.contains("COMMUNITY REDEVELOPMENT"), "cra")
    from_time = F.when(dt.rlike(r"5:0[01]\s*P|[6-9]:\d\d\s*P"), "evening")
    return F.coalesce(blank_to_null(override), from_video, from_title, from_time, F.lit("regular"))


def type_label(slug: ColumnLike) -> Column:
    return F.coalesce(lookup(slug, TYPE_LABELS), col(slug))


def meeting_title(slug: ColumnLike, date: ColumnLike) -> Column:
    return F.concat(type_label(slug), F.lit(" — "), long_date(date))


# --- C3: several signals ---------------------------------------------------

# Patterns per label and field, in order.
SIGNAL_RULES = [
    Rule(10, "title", r"CRA\b", "CRA"),
    Rule(11, "title", r"COMMUNITY\s+REDEVELOPMENT", "CRA"),
    Rule(12, "title", r"REDEVELOPMENT\s+AGENCY", "CRA"),
    Rule(20, "title", r"WORKSHOP", "Workshop"),
    Rule(30, "title", r"EVENING", "Evening"),
    Rule(40, "title", r"SPECIAL", "Special"),
    Rule(50, "title", r"CITY\s+COUNCIL", "City Council"),
    Rule(51, "title", r"COUNCIL", "City Council"),
    Rule(10, "text", r"CRA\s+MEETING", "CRA"),
    Rule(11, "text", r"COMMUNITY\s+REDEVELOPMENT", "CRA"),
    Rule(12, "text", r"REDEVELOPMENT\s+AGENCY", "CRA"),
    Rule(20, "text", r"WORKSHOP", "Workshop"),
    Rule(30, "text", r"EVENING\s+SESSION", "Evening"),
    Rule(31, "text", r"EVENING\s+MEETING", "Evening"),
    Rule(40, "text", r"SPECIAL\s+(?:MEETING|SESSION|DISCUSSION)", "Special"),
    Rule(50, "text", r"CITY\s+COUNCIL", "City Council"),
    Rule(51, "text", r"COUNCIL\s+MEETING", "City Council"),
    Rule(30, "time", r"5:\d{2}\s*P\.?M", "Evening"),
]
GENERIC = "City Council"
SEARCH_TERMS = {
    "CRA": "Community Redevelopment",
    "Workshop": "City Council",
    "Evening": "City Council",
    "Special": "City Council",
    "City Council": "City Council",
}
LEGACY_TERMS = {
    "City Council": ["TCC"],
    "CRA": ["TCC", "CRA"],
    "Workshop": ["TCC", "CHARTER WORKSHOP"],
    "Evening": ["TCC"],
    "Special": ["TCC"],
}


def _signal(field: str, value: ColumnLike) -> Column:
    return classify([r for r in SIGNAL_RULES if r.field == field], {field: value})


def opening_text(segments: ColumnLike, n: int = 5) -> Column:
    """Texts of the first n segments joined by a space."""
    return F.array_join(F.transform(F.slice(col(segments), 1, n), lambda s: F.coalesce(s["text"], F.lit(""))), " ")


def detect_type(title: ColumnLike, text: ColumnLike, time: ColumnLike, metadata_label: ColumnLike | None = None) -> Column:
    """Specific title, specific text, time of day, generic title, metadata, default."""
    by_title, by_text = _signal("title", title), _signal("text", text)
    specific = lambda x: F.nullif(x, F.lit(GENERIC))
    known = col(metadata_label) if metadata_label is not None else F.lit(None).cast("string")
    return F.coalesce(specific(by_title), specific(by_text), _signal("time", time), by_title, known, F.lit(GENERIC))


# --- C4, C5: keyword in a title or a list row ------------------------------

# Keyword order differs between the two listings.
INDEX_KEYWORDS = (
    ("cra", "cra"),
    ("community redevelopment", "cra"),
    ("workshop", "workshop"),
    ("evening", "evening"),
    ("special", "special"),
)
LIST_ROW_KEYWORDS = (
    ("evening", "evening"),
    ("workshop", "workshop"),
    ("special", "special"),
    ("cra", "cra"),
    ("community redevelopment", "cra"),
)


def by_keyword(text: ColumnLike, keywords=INDEX_KEYWORDS, default: str = "regular") -> Column:
    low = F.lower(col(text))
    return F.coalesce(*[F.when(low.contains(k), F.lit(v)) for k, v in keywords], F.lit(default))


# --- C6, C8: label maps ----------------------------------------------------

# Fixed values.
METADATA_LABELS = {
    "regular": "City Council",
    "council regular": "City Council",
    "council special": "Special",
    "cra regular": "CRA",
    "council evening": "Evening",
    "evening": "Evening",
    "workshop": "Workshop",
    "council workshop": "Workshop",
}
COMMAND_TERMS = {
    "cra": "Community Redevelopment",
    "community redevelopment": "Community Redevelopment",
    "workshop": "City Council",
    "evening": "City Council",
    "city council": "City Council",
}


def metadata_type(label: ColumnLike) -> Column:
    return lookup(F.lower(col(label)), METADATA_LABELS)


def search_term(name: ColumnLike) -> Column:
    return F.coalesce(lookup(F.lower(col(name)), COMMAND_TERMS), col(name))


def page_label(transcript_title: ColumnLike, video_title: ColumnLike) -> Column:
    """C7: transcript title in title case, else read off the first video title."""
    v = F.upper(col(video_title))
    return F.coalesce(
        F.initcap(F.lower(blank_to_null(transcript_title))),
        F.when(v.contains("CRA"), "Community Redevelopment Agency Meeting")
        .when(v.contains("EVENING"), "City Council Evening Session")
        .when(v.contains("WORKSHOP"), "City Council Workshop"),
        F.lit("City Council Meeting"),
    )


# --- names that are not people (P19) ---------------------------------------

# Patterns and exact names.
NOT_PERSON_PATTERNS = (
    r"^(city|county|state|federal)\s",
    r"\b(director|supervisor|administrator|clerk|officer|coordinator)\b",
    r"\b(owner|designee|resources|zoning|purchasing)\b",
    r"\b(police officers|school resources|property owner)\b",
    r"\b(inc\.|llc|corp\.|p\.c\.|l\.p\.|p\.a\.)\s*$",
    r"\b(inc|llc|corp|services|enterprises|industries|associates|consultants)\s*$",
    r"^(the|a|an)\s",
    r"\bmayor of\b",
    r"\bcouncilmember\b",
)
NOT_PERSON_NAMES = (
    "city clerk",
    "director of purchasing",
    "property owner(s)",
    "zoning administrator",
    "supervisor of elections",
    "school resources officers",
    "police officers",
    "local hearing officer",
    "zoning administrator or designee",
)
BUSINESS_WORDS = (
    "inc. inc llc corp. corp p.c. l.p. p.a. services enterprises industries associates consultants group partners"
).split()


def is_non_person(name: ColumnLike) -> Column:
    low = F.lower(col(name))
    return low.isin(*NOT_PERSON_NAMES) | any_of(low, NOT_PERSON_PATTERNS)


def is_business(name: ColumnLike) -> Column:
    low = F.lower(col(name))
    padded = F.concat(F.lit(" "), low, F.lit(" "))
    return reduce(lambda a, b: a | b, [low.endswith(w) | padded.contains(f" {w} ") for w in BUSINESS_WORDS])


def name_kind(name: ColumnLike) -> Column:
    """non_person is tested first, so 'business' only catches what it leaves."""
    return F.when(is_non_person(name), "non_person").when(is_business(name), "business").otherwise("person")


# --- directives (P8) -------------------------------------------------------

# Wording of a directive to staff.
DIRECTIVE_PATTERNS = (
    r"\bwritten report\b",
    r"\bverbal report\b",
    r"\bin-person (?:staff )?report\b",
    r"\bstaff to (?:appear|present|report|provide|study|prepare|come before|update)\b",
    r"\bstaff will (?:present|appear|report|provide|be present)\b",
    r"\bstaff to be present\b",
    r"\bpresent a (?:written|verbal|monthly|quarterly|annual|status)? ?report\b",
    r"\bprovide (?:a |an )?(?:written|verbal|monthly|quarterly|annual|status|in-person|updated)? ?report\b",
    r"\bprovide (?:a |an )?update\b",
    r"\bto update (?:city )?council\b",
    r"\b(?:monthly|quarterly|annual) (?:in-person )?(?:update|report|appearance)\b",
    r"\b10-minute (?:update|presentation)\b",
    r"\bto appear before\b",
    r"\bappearance to be held\b",
    r"placed under staff reports.*motion made by council",
)
RECURRING_PATTERN = r"\b(monthly|quarterly|annual|next (?:quarterly|monthly|annual)|10-minute update)\b"
CRA_PATTERN = r"\bCRA\s+(?:staff|to)\b"


def is_directive(text: ColumnLike) -> Column:
    return any_of(text, DIRECTIVE_PATTERNS)


# --- caption noise (P13), speakers (P14), part two (P12) --------------------

GENERIC_SPEAKERS = ("the clerk", "clerk", "speaker", "unknown")


def is_named_speaker(name: ColumnLike) -> Column:
    n = F.trim(col(name))
    return ~F.lower(n).isin(*GENERIC_SPEAKERS) & F.size(F.split(n, r"\s+")).between(2, 4)


def is_second_part(title: ColumnLike) -> Column:
    return F.coalesce(col(title).rlike(r"(?i)\bPart\s+2\b.*\bSee\s+Item\s+\d+\b"), F.lit(False))
