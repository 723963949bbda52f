"""Casing of ALL-CAPS text from dictionary tables.

A dictionary row is (phrase, proper, kind) with kind one of acronym, skip, lower,
entity, surname, suffix, and may carry a rank: of rows with equal phrase and kind the
lowest rank wins, then the first casing in order.  Which entries a text can use depends
only on the words of that text: its places are followed through a trie of the dictionary, and the
casing step sees the text next to its own few entries.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.base import let
from ..session import stored

#: Prefixes of dictionary phrases up to this number are broadcast; more are joined by a shuffle.
BROADCAST_PHRASES = 500_000

# Nouns after which "it" is the department, words before "us" the country.
IT_DEPARTMENT_NEXT = (
    "department dept staff team director manager systems system infrastructure services service support "
    "budget office division personnel"
).split()
US_COUNTRY_PREV = ("the",)
DIRECTIONS = r"(?:north|south|east|west|[nsew]\.?)\s+"


class Caser:
    """Cases one text with the entries it was given."""

    def __init__(self, entries: dict[str, dict[str, str]], keep_apostrophes: bool = True):
        self.acronyms = entries.get("acronym", {})
        self.skip = entries.get("skip", {})
        self.lower = entries.get("lower", {})
        self.surnames = entries.get("surname", {})
        self.words = entries.get("entity", {})
        phrases = [p for p in self.words if " " in p or "-" in p]
        self.phrases = sorted(phrases, key=lambda p: (-len(p), p))
        suffixes = sorted(entries.get("suffix", {}), key=lambda s: (-len(s), s))
        self.street = (
            re.compile(rf"\b({DIRECTIONS})?([a-z]{{2,}}(?:\s+[a-z]{{2,}})?)\s+({'|'.join(map(re.escape, suffixes))})\b")
            if suffixes
            else None
        )
        self.keep_apostrophes = keep_apostrophes

    def __call__(self, text: str | None) -> str | None:
        if not text or not text.strip():
            return text
        low = text.lower()
        if self.street:
            low = self.street.sub(lambda m: " ".join(w[:1].upper() + w[1:] for w in m.group(0).split()), low)
        low = self._phrases(low)
        tokens = low.split()
        return " ".join(self._token(tokens, i) for i in range(len(tokens)))

    def _phrases(self, low: str) -> str:
        """Longest phrase first over the whole text; a place that a longer phrase has taken stays as it is."""
        taken: list[tuple[int, int, str]] = []
        for phrase in self.phrases:
            # match without case: the street rule may already have raised some letters
            for m in re.finditer(rf"\b{re.escape(phrase)}\b", low, flags=re.IGNORECASE):
                if all(m.end() <= a or m.start() >= b for a, b, _ in taken):
                    taken.append((m.start(), m.end(), self.words[phrase]))
        out, at = [], 0
        for a, b, proper in sorted(taken):
            out += [low[at:a], proper]
            at = b
        return "".join([*out, low[at:]])

    def _token(self, tokens: list[str], i: int) -> str:
        token = tokens[i]
        lead, core, tail = re.fullmatch(r"(\W*)(.*?)(\W*)", token, re.S).groups()
        key = re.sub(r"[^\w-]", "", core).lower()
        if not key:
            return token
        shown = core.lower() if self.keep_apostrophes else key
        opens = i == 0 or any(p in tokens[i - 1] for p in ".!?")
        cased = self._case(tokens, i, core, key, shown, opens)
        return token if cased is None else lead + cased + tail

    def _case(self, tokens, i, core, key, shown, opens) -> str | None:
        sentence = shown[:1].upper() + shown[1:]
        if self._is_pronoun(tokens, i, key):
            return sentence if opens else key
        if key in self.acronyms:
            return key.upper()
        if core[:1].isupper():
            return None
        if "-" in key and len(key) > 2:
            parts = key.split("-")
            if any(len(p) > 1 and (p in self.words or p in self.surnames) for p in parts):
                return "-".join(self.surnames.get(p, p.capitalize()) for p in parts)
        if opens:
            return sentence
        if key == "i":
            return "I"
        if key in self.lower or key in self.skip:
            return shown
        if key in self.words:
            return self.words[key]
        return None if key[0].isdigit() else shown

    @staticmethod
    def _is_pronoun(tokens, i, key) -> bool:
        plain = lambda j: re.sub(r"^\W+|\W+$", "", tokens[j]).lower() if 0 <= j < len(tokens) else ""
        if key == "it":
            return plain(i + 1) not in IT_DEPARTMENT_NEXT
        return key == "us" and plain(i - 1) not in US_COUNTRY_PREV


def _grouped(rows) -> dict[str, dict[str, str]]:
    out: dict[str, dict[str, str]] = {}
    for phrase, proper, kind in rows:
        out.setdefault(kind, {})[phrase] = proper
    return out


def _pieces(low):
    """Words of a lower-case text and what stands between them, in turn."""
    return F.filter(F.split(low, r"\b"), lambda p: p != "")


def phrase_trie(dictionary: DataFrame, phrase: str = "phrase") -> DataFrame:
    """(prefix, words, terminal): every run of whole words that a phrase begins with.

    An edge leads from a prefix to the one that has the next word, and what stands before it, more."""
    pieces = dictionary.select(_pieces(F.lower(phrase)).alias("p")).where(F.get("p", F.lit(0)).rlike(r"^\w"))
    # what follows the last word is not reached by the words of a text
    counts = F.sequence(F.lit(1), F.floor((F.size("p") + 1) / 2).cast("int"))
    runs = pieces.select(F.size("p").alias("n"), "p", F.explode(counts).alias("words"))
    joined = runs.select(F.array_join(F.slice("p", F.lit(1), 2 * F.col("words") - 1), "").alias("prefix"), "words", (F.col("n") == 2 * F.col("words") - 1).alias("terminal"))
    return joined.groupBy("prefix", "words").agg(F.max("terminal").alias("terminal"))


def phrases_in(texts: DataFrame, key: str, text: str, dictionary: DataFrame, small: int = BROADCAST_PHRASES) -> DataFrame:
    """(key, phrase): the dictionary phrases that stand in each text, found word by word.

    A place in a text is followed only while the words from there are a prefix of some phrase, so rows are in
    proportion to first words that the dictionary has, then to pairs that it has, and so on.  While the dictionary has at most
    `small` prefixes, they travel to the texts, and no place is shuffled."""
    trie = stored(phrase_trie(dictionary), "trie")
    size, longest = trie.agg(F.count("*"), F.max("words")).first()
    near = F.broadcast if size <= small else (lambda df: df)
    level = lambda n: near(trie.where(F.col("words") == n).select("prefix", "terminal"))

    def places(p):
        at = F.filter(F.sequence(F.lit(1), F.size(p)), lambda i: F.element_at(p, i.cast("int")).rlike(r"^\w"))
        rest = lambda i: F.slice(p, i + 1, F.lit(2 * (longest or 1) - 2))
        return F.transform(at, lambda i: F.struct(F.element_at(p, i.cast("int")).alias("prefix"), rest(i).alias("rest")))

    low = F.lower(F.col(text))
    whole = texts.where(F.length(text) > 0)
    now = whole.select(key, F.explode(let(_pieces(low), places)).alias("o")).select(key, "o.prefix", "o.rest")
    found, n = [], 1
    while n <= (longest or 0):
        now = now.join(level(n), "prefix")
        if n < longest:
            now = stored(now, "places")
        found.append(now.where("terminal").select(key, F.col("prefix").alias("phrase")))
        longer = now.where(F.size("rest") >= 2)
        if n < longest and longer.isEmpty():
            break
        step = F.concat("prefix", F.element_at("rest", 1), F.element_at("rest", 2))
        now = longer.select(key, step.alias("prefix"), F.slice("rest", F.lit(3), F.greatest(F.size("rest") - 2, F.lit(0))).alias("rest"))
        n += 1

    # parts with marks inside are looked up without them
    marked = F.filter(F.split(low, r"\s+"), lambda w: ~w.rlike(r"^[^\w-]*\w*[^\w-]*$"))
    marked = F.transform(marked, lambda w: F.regexp_replace(w, r"[^\w-]", ""))
    parts = whole.select(key, F.explode(marked).alias("phrase"))
    known = dictionary.select("phrase").distinct()
    found.append(parts.join(near(known), "phrase", "left_semi").select(key, "phrase"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def _with_join(texts: DataFrame, key: str, text: str, out: str, dictionary: DataFrame, keep: bool, predictions: DataFrame | None) -> DataFrame:
    phrases = phrases_in(texts, key, text, dictionary)
    # acronyms, suffixes and the rest are all reached by the words of the text itself
    hits = phrases.join(dictionary.select("phrase", "proper", "kind"), "phrase").select(key, "phrase", "proper", "kind")
    if predictions is not None:
        said = predictions.select(key, F.lower("phrase").alias("phrase"), "proper", "kind", F.lit(1).alias("rank"))
        every = hits.withColumn("rank", F.lit(0)).unionByName(said)
        hits = every.groupBy(key, "phrase", "kind").agg(F.min_by("proper", F.struct("rank", "proper")).alias("proper"))
    own = hits.groupBy(key).agg(F.collect_set(F.struct("phrase", "proper", "kind")).alias("_entries"))
    joined = texts.join(own, key, "left")

    @F.pandas_udf("string")
    def cased(text_col: pd.Series, entries: pd.Series) -> pd.Series:
        def one(t, rows):
            found = [] if rows is None else [(r["phrase"], r["proper"], r["kind"]) for r in rows]
            return Caser(_grouped(found), keep)(t)

        return pd.Series([one(t, e) for t, e in zip(text_col, entries)], index=text_col.index)

    return joined.withColumn(out, cased(F.col(text), F.col("_entries"))).drop("_entries")


def truecase(
    texts: DataFrame,
    key: str,
    text: str,
    dictionary: DataFrame,
    out: str = "cased",
    keep_apostrophes: bool = True,
    predictions: DataFrame | None = None,
) -> DataFrame:
    """Add the cased text.  `key` must be unique per row.

    `predictions` (key, phrase, proper, kind) are entries of single texts, such as the names a model found in
    them; they come after the dictionary where both have the same phrase and kind."""
    rank = F.col("rank") if "rank" in dictionary.columns else F.lit(0)
    first = F.min_by("proper", F.struct("rank", "proper")).alias("proper")
    entries = dictionary.withColumn("rank", rank).where(F.col("phrase").isNotNull())
    entries = entries.groupBy("phrase", "kind").agg(first)
    return _with_join(texts, key, text, out, stored(entries, "dictionary"), keep_apostrophes, predictions)


def dictionary_rows(names: DataFrame, kind: str, column: str = "name") -> DataFrame:
    """Dictionary rows of one kind from a name list; one casing per phrase, the first in order."""
    return names.groupBy(F.lower(column).alias("phrase")).agg(F.min(column).alias("proper")).withColumn("kind", F.lit(kind))
