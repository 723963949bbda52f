"""Text columns: identifiers, titles, cleaning, formatting."""

from __future__ import annotations

from functools import reduce
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import ColumnLike, blank_to_null, capture, col, first_present, indexes, islands, let, lines_of, squash, strip

# File-number shapes, in the order they are tried.
FILE_NUMBER_PATTERNS = (
    r"(?i)File\s+No\.?\s+([A-Z]{1,5}(?:\s*\d{1,4})?(?:\s*[-/]\s*[A-Z\d]{1,8})*)",
    r"(?i)\b(TA/CPA\d{1,4}\s*[-/]\s*\d{1,6})\b",
    r"(?i)\b((?:REZ|CPA|PD)\s*[-/]?\d{2,4}\s*[-/]\s*\d{1,6}(?:\s*[-/]\s*[A-Z\d]+)*)\b",
    r"(?i)\b([A-Z]{1,5}(?:\s*\d{1,4})?(?:\s*[-/]\s*[A-Z\d]{1,8})+)\b",
)
FILE_NUMBER_AT_START = r"(?i)^([A-Z]{1,5}\d{2,4}-\d{2,6}(?:-[A-Z])?)"

# The older file-number shapes, in the order they are tried.
LEGACY_FILE_NUMBER_PATTERNS = (
    r"(?i)File\s+No\.\s+([A-Z]{1,5}\s*\d*\s*[-/]?\s*\d{1,4}\s*[-/]?\s*\d{0,6}(?:\s*[-/]\s*[A-Z\d]*)?(?:\s+\([^)]*\))?)",
    r"(?i)^([A-Z]{2,5}\s*\d{0,3}\s*[-/]\s*\d{1,4}\s*[-/]\s*(?:\d{1,6}|[A-Z])(?:\s*[-/]\s*[A-Z])?)",
    r"(?i)(?:File\s+No\.?\s+)?(TA/CPA\d{2,4}[-/]\d{1,6})",
    r"(?i)(?:File\s+No\.?\s+)?([A-Z]{1,5}\d{2,4}[-/]\d{1,6})",
    r"(?i)(?:File\s+No\.?\s+)?((?:REZ|CPA|PD)[-/]?\d{2,4}[-/]\d{1,6})",
)


def file_number(text: ColumnLike) -> Column:
    """Normalised file number of an agenda text; first pattern with a hit wins."""
    hit = F.coalesce(*[capture(text, p) for p in FILE_NUMBER_PATTERNS])
    for pattern, repl in ((r"\s*-\s*", "-"), (r"\s*/\s*", "/"), (r"\s+", " ")):
        hit = F.regexp_replace(hit, pattern, repl)
    update = F.when(col(text).rlike("(?i)Administration Update"), F.lit("Administration Update"))
    return F.coalesce(F.trim(hit), capture(text, FILE_NUMBER_AT_START), update)


def file_number_legacy(text: ColumnLike) -> Column:
    """File number by the older rules, which keep a parenthesised suffix."""
    hit = F.coalesce(*[capture(text, p) for p in LEGACY_FILE_NUMBER_PATTERNS])
    update = F.when(col(text).contains("Administration Update"), F.lit("Administration Update"))
    return F.coalesce(strip(hit), update)


# Fixed value: wording that names the council member behind a motion.
MOTION_MAKER = (
    r"(?i)\((?:original )?motion(?:\s+to\s+\w+(?:\s+said\s+ordinance)?)?(?:\s+\w+)?"
    r"\s+(?:initiated|created)\s+by\s+(?:motion\s+)?([A-Za-z]+)(?:-[A-Za-z]+)?"
)
UNATTRIBUTED_MOTION = r"(?i)placed under staff reports.*motion made by council"


def motion_maker(text: ColumnLike) -> Column:
    """First surname of the motion maker, or the unattributed label, or null."""
    unattributed = F.when(col(text).rlike(UNATTRIBUTED_MOTION), F.lit("Council (unattributed)"))
    return F.coalesce(capture(text, MOTION_MAKER), unattributed)


def land_use_type(file_no: ColumnLike) -> Column:
    f = col(file_no)
    return (
        F.when(f.startswith("REZ-"), "REZONING")
        .when(f.startswith("TA/CPA"), "TEXT_AMENDMENT_COMP_PLAN")
        .when(f.startswith("VAC-"), "VACATION")
        .when(f.startswith("SU-"), "SPECIAL_USE")
        .otherwise("OTHER")
    )


def is_land_use(file_no: ColumnLike, title: ColumnLike) -> Column:
    """Land-use item: by file-number prefix, or a title that opens with the number."""
    f, t = F.coalesce(col(file_no), F.lit("")), F.coalesce(col(title), F.lit(""))
    by_number = f.rlike(r"(?i)^(REZ|VAC|SU|TA/CPA|CPA|PD)-") | f.contains("TA/CPA")
    return by_number | (t.startswith("File No. ") & t.contains(f))


def clean_title(title: ColumnLike) -> Column:
    """Title without its leading 'File No. …' prefix."""
    return F.coalesce(strip(F.regexp_replace(col(title), r"(?i)^File No\.\s*[A-Z0-9-]+\s*\n?", "")), F.lit(""))


def has_content(text: ColumnLike) -> Column:
    return F.coalesce(F.length(strip(text)) > 0, F.lit(False))


# --- background text -------------------------------------------------------

# Section headers that end a background block, and its openers.
SECTION_ENDS = (
    r"fiscal\s+impact|recommendation|analysis|staff\s+recommendation|attachments?|budget|legal|conclusion"
    r"|next\s+steps|justification|alternatives|contact|prepared\s+by|reviewed\s+by"
)
BACKGROUND_OPENERS = (r"background\s*:?", r"background\s*information\s*:?", r"project\s*background\s*:?")
BUSINESS_CASE_OPENER = r"business\s*case\s*:?"


def background_section(text: ColumnLike, business_case: bool = False) -> Column:
    """Background block up to the next known header; first opener giving >20 chars."""
    openers = BACKGROUND_OPENERS + ((BUSINESS_CASE_OPENER,) if business_case else ())
    blocks = []
    for opener in openers:
        block = capture(text, rf"(?i){opener}([\s\S]*?)(?=\n\s*(?:{SECTION_ENDS}|\z))")
        folded = fold_paragraphs(strip(block))
        blocks.append(F.when(F.length(folded) > 20, folded))
    return F.coalesce(*blocks)


# Repairs of tokens that a page break split over two lines.
SPLIT_REPAIRS = (
    (r"\$(\d{1,3}(?:,\d{3})*),\s*\n\s*(\d{3}(?:\.\d{2})?)", r"\$$1,$2"),
    (r"(?i)\b(Resolution|Contract|Case|File|R)\s*\n\s*(\d+)", "$1$2"),
    (r"(?i)(\b(?:Contract|Resolution|Case|File|No\.?|Number))\s*\n\s*([A-Z0-9-]+)", "$1 $2"),
    (r"(\d{1,2}/\d{1,2}/)\s*\n\s*(\d{4})", "$1$2"),
)


def repair_splits(text: ColumnLike) -> Column:
    return reduce(lambda t, r: F.regexp_replace(t, r[0], r[1]), SPLIT_REPAIRS, col(text))


def paragraphs(text: ColumnLike) -> Column:
    """Array of paragraphs: a numbered line, or a line after sentence end, opens one."""


    def fold(lines):
        starts = F.filter(
            indexes(lines),
            lambda i: (i == 0)
            | F.get(lines, i).rlike(r"^\d+\.\s+")
            | F.get(lines, i - 1).rlike(r"[.!?]\z"),
        )
        return F.transform(islands(lines, starts), lambda p: F.array_join(p, " "))

    return let(lines_of(repair_splits(text)), fold)


def fold_paragraphs(text: ColumnLike) -> Column:
    """Wrapped lines folded to paragraphs, joined by blank lines."""
    return F.array_join(paragraphs(text), "\n\n")


def background_parts(text: ColumnLike) -> Column:
    """Struct of numbered items (number removed) and plain paragraphs."""
    parts = F.filter(F.transform(F.split(col(text), r"\n\s*\n"), strip), lambda s: F.length(s) > 0)

    def sort_out(sections):
        numbered = F.filter(sections, lambda s: s.rlike(r"^\d+\.\s"))
        return F.struct(
            F.transform(numbered, lambda s: F.regexp_replace(s, r"^\d+\.\s*", "")).alias("items"),
            F.filter(sections, lambda s: ~s.rlike(r"^\d+\.\s")).alias("paragraphs"),
        )

    return let(parts, sort_out)


# --- names, files, slugs ---------------------------------------------------

# Words kept small, tokens kept large, and known extensions.
SMALL_WORDS = (
    "a an and as at but by for if in nor of on or so the to up yet with from"
).split()
LARGE_WORDS = "TPD FSA HPC DOT FDOT DLE FBI DEA ATF HIDTA PDF DOC DOCX XLS XLSX TFR RESO".split()
TITLE_EXTENSIONS = r"(?i)\.(pdf|docx|doc|xlsx|xls|txt)\z"


def title_case(text: ColumnLike) -> Column:
    """Title case with small words, acronyms, separators and extension kept."""
    t = col(text)
    ext = F.regexp_extract(t, TITLE_EXTENSIONS, 0)
    stem = F.regexp_replace(t, TITLE_EXTENSIONS, "")
    # tokens alternate between words and separator runs
    split_up = F.regexp_extract_all(stem, F.lit(r"(\s+|-+|_+|[^\s_-]+)"), F.lit(1))
    is_word = lambda x: ~x.rlike(r"^(\s+|-+|_+)$")

    def cased(x, i, first):
        upper, lower = F.upper(x), F.lower(x)
        capital = F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, F.lit(2), F.length(x))))
        return (
            F.when(~is_word(x), x)
            .when(upper.isin(LARGE_WORDS) | x.rlike(r"^\d{2,4}$"), upper)
            .when((i > first) & lower.isin(SMALL_WORDS), lower)
            .otherwise(capital)
        )

    def all_cased(tokens):
        first = F.array_position(F.transform(tokens, lambda x: F.when(is_word(x), 1).otherwise(0)), 1) - 1
        return let(first, lambda f: F.array_join(F.transform(tokens, lambda x, i: cased(x, i, f)), ""))

    return F.concat(let(split_up, all_cased), ext)


def file_extension(name: ColumnLike) -> Column:
    """Lower-case extension with its dot, '' if none."""
    return F.lower(F.regexp_extract(col(name), r"[^/]+?(\.[^./]*)\z", 1))


# File-name clean-up steps in order.
FILENAME_STEPS = (
    (r"\s+", "-"),
    (r"[()]", ""),
    (r"[^a-z0-9._-]", ""),
    (r"\.pdf\.pdf\z", ".pdf"),
    (r"\.docx?\.pdf\z", ".pdf"),
    (r"-+", "-"),
    (r"^-|-\z", ""),
)


def sanitize_filename(name: ColumnLike) -> Column:
    cleaned = reduce(lambda t, r: F.regexp_replace(t, r[0], r[1]), FILENAME_STEPS, F.lower(col(name)))
    cleaned = F.substring(cleaned, 1, 200)
    ext = file_extension(cleaned)
    safe = F.when(ext == "", F.concat(cleaned, F.lit(".pdf"))).otherwise(cleaned)
    return F.when(F.coalesce(col(name), F.lit("")) == "", F.lit("document.pdf")).otherwise(safe)


def object_key(date: ColumnLike, meeting_id: ColumnLike, item_id: ColumnLike, name: ColumnLike) -> Column:
    return F.concat_ws(
        "/",
        col(date).cast("string"),
        F.concat(F.lit("meeting-"), col(meeting_id).cast("string")),
        col(item_id).cast("string"),
        sanitize_filename(name),
    )


def public_url(base: ColumnLike, key: ColumnLike, bucket: str | None = None) -> Column:
    return F.concat_ws("/", col(base), F.lit(bucket), col(key)) if bucket else F.concat_ws("/", col(base), col(key))


# Content types by extension.
CONTENT_TYPES = {
    ".pdf": "application/pdf",
    ".doc": "application/msword",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".xls": "application/vnd.ms-excel",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".ppt": "application/vnd.ms-powerpoint",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    ".txt": "text/plain",
    ".csv": "text/csv",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".png": "image/png",
    ".gif": "image/gif",
}


def content_type(name: ColumnLike) -> Column:
    ext = file_extension(name)
    known = F.create_map(*[F.lit(x) for kv in CONTENT_TYPES.items() for x in kv])
    return F.coalesce(known[ext], F.lit("application/octet-stream"))


def slug(text: ColumnLike) -> Column:
    """Key used to carry stable links from one snapshot to the next."""
    return F.regexp_replace(F.regexp_replace(F.lower(col(text)), r"\s+", "-"), r"[^a-z0-9-]", "")


# --- cleaning --------------------------------------------------------------

# Characters with an ASCII equivalent.
ASCII_CLASSES = (
    (r"[‐‑–—―−]", "-"),
    (r"[“”„‟″‶]", '"'),
    (r"[‘’‚‛′‵]", "'"),
    (r"[  -‏ -  　]", " "),
    (r"[•‣⁃⁌⁍∙◘◦☙❥❧]", "*"),
    (r"…", "..."),
    (r"©", "(c)"),
    (r"®", "(R)"),
    (r"™", "(TM)"),
    (r"[^\x00-\x7F]", "-"),
)


def to_ascii(text: ColumnLike) -> Column:
    return reduce(lambda t, r: F.regexp_replace(t, r[0], r[1]), ASCII_CLASSES, col(text))


# --- matching --------------------------------------------------------------

# Words that carry no content when texts are matched.
STOP_WORDS = (
    "THE AND FOR ARE BUT NOT YOU ALL CAN HAD HER WAS ONE OUR OUT HAS HIS HOW ITS LET "
    "MAY NEW NOW OLD SEE WAY WHO DID GET GOT HIM HIT OWN SAY SHE TOO USE THAT WITH "
    "HAVE THIS WILL YOUR FROM THEY BEEN SAID EACH WHICH THEIR THEM THEN THAN SOME WERE "
    "THERE WHERE WHAT WHEN MAKE LIKE JUST OVER SUCH TAKE INTO VERY ALSO BACK GOOD WELL "
    "HERE COME CAME KNOW MUCH ABOUT WOULD COULD SHOULD GOING THINK THANK MORNING EVENING"
).split()


#: A word for matching, and one that carries content: three characters or more, not digits alone, not a stop word.
WORD = "[A-Z0-9]+"
_STOP = "|".join(f"{k}(?:{'|'.join(w[1:] for w in ws)})" for k, ws in groupby(sorted(STOP_WORDS), lambda w: w[0]))
CONTENT_WORD = rf"(?<![A-Z0-9])(?!(?:[0-9]+|{_STOP})(?![A-Z0-9]))[A-Z0-9]{{3,}}"


#: Characters, ß apart, whose upper case is several characters, ASCII letters among them (ﬁ: FI).
LONG_UPPER = "[ŉǰẖ-ẚﬀ-ﬆ]"


def without_long_upper(text: ColumnLike) -> Column:
    """Characters whose upper case would be several are blanks, as where upper case goes one by one and they are no letters."""
    return F.regexp_replace(col(text), LONG_UPPER, " ")


def normalize_for_match(text: ColumnLike) -> Column:
    return F.trim(F.regexp_replace(F.upper(col(text)), "[^A-Z0-9]+", " "))


def match_words(text: ColumnLike) -> Column:
    return F.regexp_extract_all(F.upper(col(text)), F.lit(WORD), F.lit(0))


def content_words(text: ColumnLike) -> Column:
    """Words of three or more characters, with a letter, not on the stop list; order kept."""
    return F.regexp_extract_all(F.upper(col(text)), F.lit(CONTENT_WORD), F.lit(0))


def ngrams(words: Column, n: int) -> Column:
    """Space-joined n-grams in order, duplicates kept; empty when there are too few words.

    Words hold no space, so a pattern that looks ahead from every word finds them in the joined text."""
    gram = " ".join(["[^ ]+"] * n)
    found = F.regexp_extract_all(F.array_join(words, " "), F.lit(f"(?<![^ ])(?=({gram}))"), F.lit(1))
    return F.coalesce(found, F.array().cast("array<string>"))


def overlap_share(a: Column, b: Column) -> Column:
    """|A∩B| / |A| over word sets, 0 when A is empty."""
    size = F.size(F.array_distinct(a))
    return F.when(size > 0, F.size(F.array_intersect(a, b)) / size).otherwise(F.lit(0.0))


def share_in(xs: Column, ys: Column) -> Column:
    """Share of the elements of xs, duplicates counted, that are in ys; by hashing where xs has no duplicates."""
    distinct = F.size(F.array_distinct(xs)) == F.size(xs)
    one_by_one = F.size(F.filter(xs, lambda x: F.array_contains(ys, x)))
    return F.when(distinct, F.size(F.array_intersect(xs, ys))).otherwise(one_by_one) / F.size(xs)


def ngram_score(a: Column, b: Column, n: int) -> Column:
    """Share of a's n-grams found in b; share of a's words when either side is short."""
    by_gram = let(F.array_distinct(ngrams(b, n)), lambda seen: let(ngrams(a, n), lambda grams: share_in(grams, seen)))
    by_word = let(F.array_distinct(b), lambda words: share_in(a, words))
    return F.when(F.size(a) == 0, F.lit(0.0)).when((F.size(a) < n) | (F.size(b) < n), by_word).otherwise(by_gram)


def ascii_share(text: ColumnLike) -> Column:
    n = F.length(col(text))
    return F.when(n > 0, F.length(F.regexp_replace(col(text), r"[^\x00-\x7F]+", "")) / n).otherwise(F.lit(0.0))


def substring_position(needle: ColumnLike, haystack: ColumnLike) -> Column:
    """Relative position of the needle, trimming words from both ends until it is found."""

    def search(a, b):
        words = F.filter(F.split(a, " "), lambda w: F.length(w) > 0)
        n = F.size(words)
        last_trim = F.least(F.floor(n / 2) - 1, F.floor((n - 3) / 2)).cast("int")
        shorter = let(words, lambda ws: F.transform(
            F.sequence(F.lit(1), last_trim), lambda k: F.array_join(F.slice(ws, k + 1, F.size(ws) - k * 2), " ")
        ))
        tries = F.when(last_trim >= 1, F.concat(F.array(a), shorter)).otherwise(F.array(a))
        hits = F.filter(F.transform(tries, lambda s: F.instr(b, s)), lambda p: p > 0)
        return F.when((F.length(a) > 0) & (F.length(b) > 0), (F.try_element_at(hits, F.lit(1)) - 1) / F.length(b))

    return let(normalize_for_match(needle), lambda a: let(normalize_for_match(haystack), lambda b: search(a, b)))


def best_window(a: Column, b: Column) -> Column:
    """Struct(position, overlap) of the window of b that shares most words with a."""
    shape = lambda p, o: F.struct(p.cast("double").alias("position"), o.cast("double").alias("overlap"))

    def slide(x, y):
        nx, ny, distinct = F.size(x), F.size(y), F.size(F.array_distinct(x))
        shared = F.transform(
            F.sequence(F.lit(0), F.greatest(ny - nx, F.lit(0))),
            # the negated start makes the first window win among equals
            lambda i: F.struct(F.size(F.array_intersect(x, F.slice(y, i + 1, nx))).alias("n"), (-i).alias("neg")),
        )
        slid = let(
            F.array_max(shared),
            lambda m: shape(F.when(m["n"] > 0, (-m["neg"]) / (ny - nx)).otherwise(F.lit(0.0)), m["n"] / distinct),
        )
        return (
            F.when((nx == 0) | (ny == 0), shape(F.lit(0.5), F.lit(0.0)))
            .when(ny <= nx, shape(F.lit(0.0), overlap_share(x, y)))
            .otherwise(slid)
        )

    return let(a, lambda x: let(b, lambda y: slide(x, y)))


# --- people ----------------------------------------------------------------


def hyphen_parts_cased(name: ColumnLike) -> Column:
    """Johnson-velez -> Johnson-Velez; parts with mixed case stay."""
    n = col(name)
    part = lambda p: F.when((p == F.lower(p)) | (p == F.upper(p)), F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, F.lit(2), F.length(p))))).otherwise(p)
    return F.when(n.contains("-"), F.array_join(F.transform(F.split(n, "-"), part), "-")).otherwise(n)


def hyphen_parts_raised(name: ColumnLike) -> Column:
    """The other hyphen rule: only a lower-case first letter is raised."""
    n = col(name)
    raised = F.transform(F.split(n, "-"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, F.lit(2), F.length(p))))
    return F.when(n.contains("-"), F.array_join(raised, "-")).otherwise(n)


def normalize_name(name: ColumnLike) -> Column:
    """Name without title, middle initial and suffix."""
    n = F.regexp_replace(col(name), r"^(Chief|Councilmember|Mayor|Detective|Dr\.|Mr\.|Ms\.|Mrs\.)\s+", "")
    n = F.regexp_replace(n, r"\s+[A-Z]\.\s+", " ")
    n = F.regexp_replace(n, r",?\s+(P\.E\.|Jr\.|Sr\.|III|II|IV)$", "")
    return squash(n)


def speaker_case(name: ColumnLike) -> Column:
    """Each word capitalised, inner whitespace collapsed."""
    return F.initcap(F.lower(squash(name)))


def first_titled(documents: ColumnLike, *phrases: str) -> Column:
    """The first document of an array whose title holds one of the phrases, in any case; null without one."""
    hit = lambda x: reduce(lambda a, b: a | b, [F.lower(x["title"]).contains(p.lower()) for p in phrases])
    return F.get(F.filter(col(documents), hit), F.lit(0))


# --- presentation ----------------------------------------------------------


def search_hit(text: ColumnLike, query: str) -> Column:
    q = query.lower()
    return (F.lit(len(q) >= 2)) & F.lower(col(text)).contains(q)


def highlight(text: ColumnLike, query: str) -> Column:
    """Every query word marked, whole text kept."""
    import re

    marked = col(text)
    for word in query.split():
        marked = F.regexp_replace(marked, "(?i)(" + re.escape(word) + ")", "<mark>$1</mark>")
    return marked


def snippet(text: ColumnLike, query: str) -> Column:
    """Highlighted text cut to a window round the first mark when it is long."""
    marked = highlight(text, query)
    n = F.length(marked)
    at = F.locate("<mark>", F.lower(marked)) - 1
    start = F.greatest(F.lit(0), at - 50)
    end = F.least(n, at + 150)
    cut = F.concat(
        F.when(start > 0, F.lit("…")).otherwise(F.lit("")),
        F.substring(marked, start + 1, end - start),
        F.when(end < n, F.lit("…")).otherwise(F.lit("")),
    )
    return F.when(n > 200, cut).otherwise(marked)


def agenda_type(heading: ColumnLike) -> Column:
    """FINAL or DRAFT from a heading whose letters may be spaced out."""
    h = F.upper(F.regexp_replace(col(heading), r"\s+", ""))
    return F.when(h.contains("FINAL"), "FINAL").otherwise(F.lit("DRAFT"))


# Wording of an addendum.
ADDENDUM_PHRASES = (
    "ADDENDUM TO FINAL AGENDA",
    "ADDENDUM TO DRAFT AGENDA",
    "ADDENDUMTOFINALAGENDA",
    "ADDENDUMTODRAFTAGENDA",
)


def is_addendum(text: ColumnLike) -> Column:
    body = F.upper(squash(text))
    return reduce(lambda a, b: a | b, [body.contains(p) for p in ADDENDUM_PHRASES])


def format_bytes(n: ColumnLike) -> Column:
    b = col(n).cast("double")
    shown = lambda x, unit: F.concat(F.regexp_replace(F.format_string("%.2f", x), r"\.?0+$", ""), F.lit(unit))
    return (
        F.when(b == 0, "0 B")
        .when(b < 1024, shown(b, " B"))
        .when(b < 1024**2, shown(b / 1024, " KB"))
        .when(b < 1024**3, shown(b / 1024**2, " MB"))
        .otherwise(shown(b / 1024**3, " GB"))
    )


def format_currency(value: ColumnLike) -> Column:
    """$1,234.50 with the sign kept in front."""
    v = col(value)
    return F.concat(F.when(v < 0, "-").otherwise(F.lit("")), F.lit("$"), F.format_number(F.abs(v), 2))


def format_duration(seconds: ColumnLike) -> Column:
    s = col(seconds)
    h, m = F.floor(s / 3600), F.floor((s % 3600) / 60)
    return F.when(h > 0, F.format_string("%dh %dm", h, m)).otherwise(F.format_string("%dm %ds", m, (s % 60).cast("bigint")))


def thumbnail_url(video_id: ColumnLike) -> Column:
    return F.concat(F.lit("https://img.youtube.com/vi/"), blank_to_null(video_id), F.lit("/mqdefault.jpg"))


def watch_url(video_id: ColumnLike, seconds: ColumnLike) -> Column:
    return F.concat(F.lit("https://youtu.be/"), col(video_id), F.lit("?t="), col(seconds).cast("string"))


# --- map keys and folios ---------------------------------------------------


def map_record_key(file_no: ColumnLike, item_number: ColumnLike) -> Column:
    """prefix-0000009:item, padded only where the last part is numeric."""
    f = col(file_no)
    prefix, num = capture(f, r"^(.*)-([^-]+)$", 1), capture(f, r"^(.*)-([^-]+)$", 2)
    # lpad truncates, so longer numbers are kept as they are
    wide = F.when(F.length(num) < 7, F.lpad(num, 7, "0")).otherwise(num)
    padded = F.when(num.rlike(r"^\d+$"), F.concat(prefix, F.lit("-"), wide))
    return F.concat_ws(":", F.coalesce(padded, f), col(item_number).cast("string"))


def folio_numbers(section: ColumnLike) -> Column:
    """Distinct folio numbers of a section in the order of their values, plausible range only."""
    found = F.regexp_extract_all(col(section), F.lit(r"\b(\d{5,8}(?:\.\d{4})?)\b"), F.lit(1))
    plausible = F.filter(found, lambda x: (x.cast("double") >= 10_000) & (x.cast("double") < 100_000_000))
    valued = F.transform(F.array_distinct(plausible), lambda x: F.struct(x.cast("double").alias("value"), x.alias("folio")))
    return F.transform(F.array_sort(valued), lambda v: v["folio"])


# Fixed value: the plan-amendment section of a packet.
PLAN_SECTION = (
    r"(?i)(?:Plan Amendment Request|Request for Plan Amendment)[\s\S]{0,3000}?Location:\s*([^\n]+)"
    r"[\s\S]{0,1000}?Folio Numbers?:\s*([^\n]+(?:\n(?!\n)[^\n]+)*)"
)


def packet_location(text: ColumnLike) -> Column:
    """First address of the plan-amendment section."""
    first = strip(F.element_at(F.filter(F.split(capture(text, PLAN_SECTION, 1), "[,;]"), lambda a: F.length(strip(a)) > 0), 1))
    return F.regexp_replace(first, r"(?i)^(\d+)\s+(?:and\s+\d+\s+)(.+)$", "$1 $2")


def packet_folios(text: ColumnLike) -> Column:
    return folio_numbers(capture(text, PLAN_SECTION, 2))


def title_folios(title: ColumnLike) -> Column:
    """Folio numbers named in a title, dots turned into hyphens."""
    section = capture(title, r"(?i)Folio\s+Numbers?\s+([^,.]+(?:[,\s]+(?:and\s+)?[\d\-]+)*)")
    found = F.regexp_extract_all(section, F.lit(r"\b(\d{5,8}[.\-]\d{4})\b"), F.lit(1))
    return F.transform(found, lambda x: F.replace(x, F.lit("."), F.lit("-")))


def neighbourhood_of(text: ColumnLike, names: list[str], within: int = 2000) -> Column:
    """First listed neighbourhood that is named near the top of the text."""
    head = F.lower(F.substring(col(text), 1, within))
    return F.coalesce(*[F.when(head.contains(n.lower()), F.lit(n)) for n in names])


def title_address(title: ColumnLike) -> Column:
    """Address in 'property/generally located at …' wording."""
    hit = capture(title, r"(?i)(?:property|generally)\s+located\s+at\s+([\d]+[^(]+?)(?:\s*\(|\z)")
    return F.regexp_replace(strip(hit), r"\.\z", "")


def default_title(*candidates: ColumnLike) -> Column:
    return F.coalesce(first_present(*candidates), F.lit("Document"))
