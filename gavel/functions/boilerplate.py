"""Removal of standing phrases from agenda titles.

A title is taken apart rather than matched whole: bracketed notes go by the words that they open with, sentences about
letters by their opening and one telling word, and closing clauses (between semicolons) while their words,
without small words and the name of the city, are a standing phrase.  Phrases are plain words; how they are
joined and punctuated in a title does not matter.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import ColumnLike, col, let, squash

# The standing phrases, as plain words.
NOTES = (
    "ordinance being presented", "to be r/f", "updated", "original motion", "continued from", "motion to reschedule",
    "motion adopting", "motion requesting", "amended motion", "next", "first discussion", "first public hearing",
)
LETTERS = ("memorandum from", "email from")
TELLING = ("notifying", "transmitting", "advising", "requesting", "recommending", "for said item", "for said agenda item", "to be r/f")
KEPT_LETTER = "requesting that said public hearing be continued"
SENT_ALONG = ("presentation", "response", "report", "memo", "memorandum")
CLAUSES = (
    "providing effective date", "providing severability", "providing repeal all ordinances conflict", "repealing conflicts",
    "authorizing director purchasing purchase said property supplies materials services", "authorizing execution mayor",
    "authorizing execution mayor attestation clerk",
)
SIGNING = ("authorizing mayor execute", "authorizing execution mayor execute")
SIGNED = ("same", "said agreement", "said contract", "said cooperative agreement", "said contract order form", "said amendment", "said change order")
SMALL_WORDS = ("a", "an", "and", "by", "for", "in", "of", "on", "or", "the", "thereof", "to", "behalf", "city")

#: A sentence ends at a full stop that no initial and no short title owns.
_SENTENCE_END = r"(?<=\.)(?<!\b(?:No|Mr|Ms|Dr|St)\.)(?<!\b[A-Z]\.)\s+"


def _says(text: Column, phrases: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | text.contains(p)
    return out


def _is_letter(sentence: Column) -> Column:
    low = F.lower(sentence)
    opens = F.lit(False)
    for p in LETTERS:
        opens = opens | low.startswith(p)
    return opens & _says(low, TELLING) & ~low.contains(KEPT_LETTER)


def _without_notes(text: Column) -> Column:
    openings = "|".join(re.escape(n) for n in NOTES)
    return F.regexp_replace(text, rf"(?i)\s*(?:-\s*)?\((?:{openings})[^)]*\)", "")


def _without_attachment(sentence: Column) -> Column:
    """A sentence up to the mention of something sent along for the item."""
    low = F.lower(sentence)
    at = F.locate("transmitting ", low)
    tail = F.substring(low, at, F.length(low))
    cut = F.regexp_replace(F.substring(sentence, F.lit(1), at - 1), r"(?i),?\s*(?:and\s*)?$", "")
    return F.when((at > 1) & _says(tail, SENT_ALONG) & tail.contains("for said"), cut).otherwise(sentence)


def _is_standing(clause: Column, place: str) -> Column:
    small = F.array(*[F.lit(w) for w in (*SMALL_WORDS, *place.lower().split())])
    words = F.filter(F.split(F.lower(clause), r"[^a-z]+"), lambda w: w != "")
    phrases = (*CLAUSES, *(f"{s} {o}" for s in SIGNING for o in SIGNED))
    return F.array_join(F.filter(words, lambda w: ~F.array_contains(small, w)), " ").isin(*phrases)


def _without_clauses(text: Column, place: str) -> Column:
    """Text without the standing clauses that it ends with; the first clause stays."""

    def last(clauses: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(clauses))
        return F.array_max(F.filter(places, lambda i: (i == 1) | ~_is_standing(F.element_at(clauses, i.cast("int")), place)))

    return let(F.split(text, ";"), lambda c: F.array_join(F.slice(c, F.lit(1), last(c)), ";"))


def _tidied(text: Column) -> Column:
    """No separators before a full stop or semicolon, none at the end, and a closing mark."""
    closed = F.regexp_replace(text, r"(?:\s*[,:]|\s+-(?=\W)|,?\s+and(?=\s*\.))+\s*(?=[.;])", "")
    ended = F.regexp_replace(closed, r"(?:\s+-|[\s;,])+$", "")
    once = squash(F.regexp_replace(ended, r"[;.]?\s*\.(?:\s*\.)*$", "."))
    return F.when((F.length(once) > 0) & ~once.rlike(r"[.?!]\z"), F.concat(once, F.lit("."))).otherwise(once)


def clean_agenda_text(text: ColumnLike, place: str) -> Column:
    """Agenda text without standing phrases, with its file number marked, ending with a full stop."""
    marked = F.regexp_replace(col(text), r"(?i)\bFile No\. [A-Z\d/-]+", "**$0**")
    sentences = F.split(squash(marked), _SENTENCE_END)
    kept = F.transform(F.filter(sentences, lambda s: ~_is_letter(s)), _without_attachment)
    return _tidied(_without_clauses(_without_notes(F.array_join(kept, " ")), place))
