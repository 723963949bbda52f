"""Where does an official transcript start inside a video?

Captions (from the audio) are matched to transcript segments by shared word
n-grams.  Each match implies an offset; offsets are clustered and the best-backed
cluster decides.  Matching is an equi-join on n-grams restricted, exactly, to the
rarest n-grams of each caption: a caption that shares the required fraction of its
n-grams with a segment must share one of its rarest ones, so frequent n-grams are
never joined and no group is expanded into all pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.similarity import contenders, ratio_from
from ..functions.text import (
    ascii_share,
    best_window,
    content_words,
    ngram_score,
    ngrams,
    substring_position,
)
from ..operators.clusters import anchored_clusters
from ..operators.keyed import best_per_key
from ..session import cut_lineage, stored

N = 3
MIN_SCORE = 0.3
MAX_NOISE = 0.5
MIN_ASCII = 0.85
MIN_WORDS = 4
CLUSTER_SECONDS = 30.0
EARLY_CAPTIONS = 5
EARLY_SEGMENTS = 15


def clean_captions(captions: DataFrame) -> DataFrame:
    """Captions that are speech: likely words, mostly ASCII, four or more content words."""
    return captions.where(
        (F.coalesce(F.col("no_speech_prob"), F.lit(0.0)) <= MAX_NOISE)
        & (ascii_share("text") >= MIN_ASCII)
        & (F.size(content_words("text")) >= MIN_WORDS)
    )


def ngram_matches(
    captions: DataFrame, segments: DataFrame, on: list[str], caption_id: str, segment_id: str,
    caption_words: str, segment_words: str, n: int = N, min_score: float = MIN_SCORE, short_captions: bool = True,
) -> DataFrame:
    """Pairs whose n-gram score reaches the floor: (on, caption_id, segment_id, score).

    Texts that repeat are compared once per distinct word list and expanded at the
    end.  When a side has fewer than n words single words take the place of n-grams;
    `short_captions=False` says that no caption is that short.
    """

    def distinct_texts(df: DataFrame, ident: str, words: str, side: str) -> tuple[DataFrame, DataFrame]:
        rows = df.select(*on, F.col(ident).alias(f"{side}_id"), F.col(words).alias("w")).withColumn(
            f"{side}_text", F.unhex(F.sha2(F.array_join("w", " "), 256))
        )
        return rows.drop("w"), rows.groupBy(*on, f"{side}_text").agg(F.first("w").alias(f"{side}_w"))

    c_members, c_texts = distinct_texts(captions, caption_id, caption_words, "c")
    s_members, s_texts = distinct_texts(segments, segment_id, segment_words, "s")
    s_texts = stored(s_texts, "segment-texts")  # two branches read them

    # units: n = n-grams for long against long, s = words against short segments,
    # a = words of a short caption against anything
    unit = lambda kind, words: F.struct(F.lit(kind).alias("kind"), words.alias("grams"))
    c_w, s_w = F.col("c_w"), F.col("s_w")
    c_units = F.when(F.size(c_w) >= n, F.array(unit("n", ngrams(c_w, n)), unit("s", c_w))).otherwise(F.array(unit("a", c_w)))
    s_long, s_short = [unit("n", F.array_distinct(ngrams(s_w, n)))], [unit("s", F.array_distinct(s_w))]
    if short_captions:
        s_long, s_short = [*s_long, unit("a", F.array_distinct(s_w))], [*s_short, unit("a", F.array_distinct(s_w))]
    s_units = F.when(F.size(s_w) >= n, F.array(*s_long)).otherwise(F.array(*s_short))

    c_grams = c_texts.select(*on, "c_text", F.explode(c_units).alias("u")).select(
        *on, "c_text", "u.kind", F.posexplode("u.grams").alias("pos", "g")
    ).select(*on, "c_text", "kind", "pos", F.xxhash64("kind", "g").alias("gram"))
    s_grams = s_texts.select(*on, "s_text", F.explode(s_units).alias("u")).select(
        *on, "s_text", "u.kind", F.explode("u.grams").alias("g")
    ).select(*on, "s_text", F.xxhash64("kind", "g").alias("gram"))

    # segment grams that some caption has; counted first, joined to the rare ones after
    s_hits = stored(s_grams.join(c_grams.select(*on, "gram").distinct(), [*on, "gram"], "left_semi"), "gram-hits")
    seen = s_hits.groupBy(*on, "gram").agg(F.count(F.lit(1)).alias("df"))
    weighed = c_grams.join(seen, [*on, "gram"], "left").withColumn("df", F.coalesce("df", F.lit(0)))
    # of each caption's grams: the rarest total - ceil(floor * total) + 1 positions
    need = F.greatest(F.lit(1), F.ceil(F.size("g") * F.lit(min_score) - 1e-9)).cast("int")
    rarest = (
        weighed.groupBy(*on, "c_text", "kind")
        .agg(F.array_sort(F.collect_list(F.struct("df", "pos", "gram"))).alias("g"))
        .select(*on, "c_text", F.explode(F.slice("g", F.lit(1), F.size("g") - need + 1)).alias("x"))
        .where(F.col("x.df") > 0)
        .select(*on, "c_text", F.col("x.gram").alias("gram"))
    )
    pairs = rarest.join(s_hits, [*on, "gram"]).select(*on, "c_text", "s_text").distinct()
    scored = (
        pairs.join(c_texts, [*on, "c_text"]).join(s_texts, [*on, "s_text"])
        .withColumn("score", ngram_score(F.col("c_w"), F.col("s_w"), n))
        .where(F.col("score") >= min_score)
        .select(*on, "c_text", "s_text", "score")
    )
    return (
        scored.join(c_members, [*on, "c_text"]).join(s_members, [*on, "s_text"])
        .select(*on, F.col("c_id").alias(caption_id), F.col("s_id").alias(segment_id), "score")
    )


def position_share(caption_text: str, segment_text: str, caption_words: str, segment_words: str) -> Column:
    """Where in the segment the caption is said: by substring, else by best window of content words."""
    window = best_window(F.col(caption_words), F.col(segment_words))["position"]
    return F.coalesce(substring_position(caption_text, segment_text), window)


def implied_offset(start: str, elapsed: str, share: str, duration: str) -> Column:
    """Caption start minus the time at which the segment says it."""
    return F.col(start) - (F.col(elapsed) + F.col(share) * F.col(duration))


def fuzzy_score(a: Column, b: Column) -> Column:
    """0.6 bigram share + 0.4 word share of two word lists."""
    words = F.size(F.filter(a, lambda w: F.array_contains(b, w))) / F.nullif(F.size(a), F.lit(0))
    return F.lit(0.6) * ngram_score(a, b, 2) + F.lit(0.4) * F.coalesce(words, F.lit(0.0))


def early_matches(
    captions: DataFrame, segments: DataFrame, known: DataFrame, on: list[str], caption_id: str, segment_id: str,
    first_captions: int = EARLY_CAPTIONS, first_segments: int = EARLY_SEGMENTS, floor: float = 0.35,
) -> DataFrame:
    """Fuzzy pairs among the first captions and segments that have no n-gram match yet.

    A pair below one shared word scores 0, so candidates meet on a shared word.
    Both sides carry `pos`, their 0-based place, and `w`, their content words.
    """
    c = captions.where(F.col("pos") < first_captions).select(
        *on, caption_id, F.col("text").alias("c_text"), F.col("w").alias("c_w"), "start", F.col("pos").alias("c_pos")
    )
    s = segments.where(F.col("pos") < first_segments).select(
        *on, segment_id, F.col("text").alias("s_text"), F.col("w").alias("s_w"), "elapsed", "duration", F.col("pos").alias("s_pos")
    )
    cw = c.select(*on, caption_id, F.explode(F.array_distinct("c_w")).alias("word"))
    sw = s.select(*on, segment_id, F.explode(F.array_distinct("s_w")).alias("word"))
    pairs = cw.join(sw, [*on, "word"]).select(*on, caption_id, segment_id).distinct()
    fresh = pairs.join(known.select(*on, caption_id, segment_id), [*on, caption_id, segment_id], "left_anti")
    scored = fresh.join(c, [*on, caption_id]).join(s, [*on, segment_id]).withColumn(
        "score", fuzzy_score(F.col("c_w"), F.col("s_w"))
    )
    return scored.where(F.col("score") >= floor)


def choose_offset(pairs: DataFrame, fuzzy: DataFrame, on: list[str], caption_id: str) -> DataFrame:
    """One offset per video: best cluster, upper median when it has three pairs, early override.

    pairs: on, caption_id, c_pos, s_pos, start, score, offset; fuzzy: on, c_pos, start?, offset.
    """
    counts = pairs.groupBy(*on).agg(F.count(F.lit(1)).alias("n_pairs"))
    single = best_per_key(pairs, on, [F.col("score"), -F.col("c_pos"), -F.col("s_pos")]).select(
        *on, F.col("offset").alias("single_offset"), F.col("score").alias("single_score")
    )
    clustered = anchored_clusters(pairs, on, "offset", CLUSTER_SECONDS)
    clusters = clustered.groupBy(*on, "anchor").agg(
        F.count(F.lit(1)).alias("size"),
        F.count_distinct(caption_id).alias("support"),
        F.max("score").alias("best_score"),
        F.max_by("offset", F.struct(F.col("score"), -F.col("offset"))).alias("best_offset"),
        # the upper median: the middle one, or the greater of the middle two
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY offset DESC)").alias("upper_median"),
    )
    offset = F.when(F.col("size") >= 3, F.col("upper_median")).otherwise(F.col("best_offset"))
    clusters = clusters.withColumn("cluster_offset", offset)
    best = best_per_key(
        clusters.select(*on, "support", "best_score", "anchor", "cluster_offset", "size"),
        on,
        [F.col("support"), F.col("best_score"), -F.col("anchor")],
    )
    chosen = counts.join(single, on).join(best, on, "left")
    near = lambda a: F.abs(F.col(a) - F.col("cluster_offset")) <= CLUSTER_SECONDS
    opening = (
        pairs.where((F.col("s_pos") == 0) & (F.col("c_pos") < EARLY_CAPTIONS)).join(best.select(*on, "cluster_offset"), on)
        .where(near("start")).groupBy(*on).agg(F.min_by("start", "c_pos").alias("opening_start"))
    )
    early = (
        fuzzy.join(best.select(*on, "cluster_offset"), on).where(near("offset"))
        .groupBy(*on).agg(F.min_by("offset", F.struct("c_pos", "s_pos")).alias("early_offset"))
    )
    out = chosen.join(opening, on, "left").join(early, on, "left")
    offset = F.when(F.col("n_pairs") > 1, F.coalesce("opening_start", "early_offset", "cluster_offset")).otherwise(F.col("single_offset"))
    return out.select(*on, "n_pairs", "support", offset.alias("offset"), F.coalesce("best_score", "single_score").alias("score"))


def align(captions: DataFrame, segments: DataFrame, video: str) -> DataFrame:
    """Offset per video.

    captions: video, cap_id, start, text, no_speech_prob.
    segments: video, seg_id, sec, text — already restricted to the video's part and
    to the search window, with seg_id the order.  A video without any n-gram match
    gets no row.
    """
    from ..operators.sequence import First, Next, Position, Sequence

    on, c_key, s_key = [video], [video, "cap_id"], [video, "seg_id"]
    # words are found once and stored, as several branches read them; positions come from slim rows, and texts are
    # joined back only where they are needed
    words = content_words("text").alias("w")
    spoken = stored(clean_captions(captions).select(*c_key, "start", "text", words), "captions")
    segments = stored(segments.select(*s_key, "sec", "text", words), "segments")
    c_meta = Sequence(on, ["cap_id"], ["cap_id"]).apply(spoken.select(*c_key), pos=Position()).withColumn("pos", F.col("pos") - 1)
    s_meta = Sequence(on, ["seg_id"], ["seg_id"]).apply(
        segments.select(*s_key, "sec"), pos=Position(), _base=First("sec"), _next=Next("sec")
    ).select(
        *s_key, (F.col("pos") - 1).alias("pos"), (F.col("sec") - F.col("_base")).alias("elapsed"),
        F.coalesce(F.col("_next") - F.col("sec"), F.lit(30)).alias("duration"),
    )
    said = segments.select(*s_key, "text", "w")

    # matches and pairs are read by several branches below and are small next to the texts
    hits = cut_lineage(
        ngram_matches(spoken.select(*c_key, "w"), said.select(*s_key, "w"), on, "cap_id", "seg_id", "w", "w", short_captions=False)
    )
    pairs = (
        hits.join(spoken.withColumnsRenamed({"text": "c_text", "w": "c_w"}), c_key).join(c_meta.withColumnRenamed("pos", "c_pos"), c_key)
        .join(said.withColumnsRenamed({"text": "s_text", "w": "s_w"}), s_key).join(s_meta.withColumnRenamed("pos", "s_pos"), s_key)
        .withColumn("share", position_share("c_text", "s_text", "c_w", "s_w"))
        .withColumn("offset", implied_offset("start", "elapsed", "share", "duration"))
        .drop("c_text", "s_text", "c_w", "s_w")
    )
    opening = c_meta.where(F.col("pos") < EARLY_CAPTIONS).join(spoken, c_key)
    early = s_meta.where(F.col("pos") < EARLY_SEGMENTS).join(said, s_key)
    fuzzy = early_matches(opening, early, hits, on, "cap_id", "seg_id").withColumn("share", position_share("c_text", "s_text", "c_w", "s_w"))
    fuzzy = fuzzy.withColumn("offset", implied_offset("start", "elapsed", "share", "duration"))
    return choose_offset(cut_lineage(pairs), fuzzy, on, "cap_id")


# --- the older search by sequence similarity --------------------------------


def plain(text: str) -> Column:
    """Upper case, listed punctuation to spaces, whitespace collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(F.col(text)), r"""[.,!?;:\-"'()\[\]{}]""", " "), r"\s+", " "))


def caption_windows(captions: DataFrame, video: str, widest: int = 5) -> DataFrame:
    """Every caption with its own plain text and those of the next widest - 1 ones; null where there is none."""
    from ..operators.sequence import Next, Sequence

    df = captions.select(video, "cap_id", "start", plain("text").alias("t1"))
    seq = Sequence([video], ["cap_id"], ["cap_id"]).sized(df)
    for k in range(2, widest + 1):
        df = seq.apply(df, **{f"t{k}": Next(f"t{k - 1}")})
    return df.select(video, "cap_id", "start", F.array(*[f"t{k}" for k in range(1, widest + 1)]).alias("texts"))


def _scored(rows: DataFrame, video: str, names: list[tuple[str, T.DataType]], offers: Callable, is_good: Callable, good: float) -> DataFrame:
    """Rows through `contenders`, in reading order; `names` are the columns of an offer."""
    schema = T.StructType([*(T.StructField(c, rows.schema[c].dataType) for c in (video, "cap_id")), *(T.StructField(*n) for n in names), T.StructField("ratio", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        return contenders(batches, video, "cap_id", offers, is_good, good, arrow)

    return rows.sortWithinPartitions(video, "cap_id").mapInArrow(run, schema)


def find_text(captions: DataFrame, reference: DataFrame, video: str, reference_text: str, good: float = 0.7) -> DataFrame:
    """Start of the caption window most similar to the reference text of its video.

    The first window in reading order that reaches `good` wins, else the best one.  Windows are 1 to 5 captions;
    ratios are computed in reading order, while they may still decide (`functions.similarity`).
    """
    texts = reference.select(video, plain(reference_text).alias("_a"))
    rows = caption_windows(captions, video).join(texts, video)
    bounds: dict = {}

    def offers(row):
        a, window = row["_a"] or "", ""
        for k, text in enumerate(row["texts"], 1):
            if text:
                window = f"{window} {text}" if window else text
            if text is not None:
                yield k, (row["start"], k), lambda floor, b=window: ratio_from(a, b, floor, bounds)

    names = [("start", rows.schema["start"].dataType), ("window_size", T.IntegerType())]
    scored = _scored(rows, video, names, offers, lambda r: r >= good, good)
    order = F.struct("cap_id", "window_size")
    picked = scored.groupBy(video).agg(
        F.min_by(F.struct("start", "ratio"), F.when(F.col("ratio") >= good, order)).alias("_good"),
        F.max_by(F.struct("start", "ratio"), F.struct(F.col("ratio"), -F.col("cap_id"), -F.col("window_size"))).alias("_best"),
    )
    return picked.withColumn("_p", F.coalesce("_good", "_best")).select(video, "_p.start", "_p.ratio")


#: The ratio that a caption has at least with a segment that starts with its first 20 characters.
SAME_START = 0.9


def match_start(captions: DataFrame, segments: DataFrame, video: str, first: int = 30, accept: float = 0.5, good: float = 0.7) -> DataFrame:
    """The caption and early segment that match best, else the first caption's start.

    segments: video, seg_id, pos, sec, text; captions: video, cap_id, start, text.
    """
    c = captions.where(F.length(F.trim("text")) >= 10).select(video, "cap_id", "start", plain("text").alias("_c"))
    s = segments.where((F.col("pos") < first) & (F.length(F.trim("text")) >= 10))
    # at most `first` segments of a video, in order; every caption of the video meets them
    early = s.groupBy(video).agg(F.array_sort(F.collect_list(F.struct("pos", "sec", plain("text").alias("text")))).alias("_s"))
    if SAME_START > good:
        # the first caption that starts a segment is good without its ratio, so later captions cannot win
        starts = F.exists("_s", lambda x: x["text"].startswith(F.substring("_c", 1, 20)))
        until = c.join(early, video).where(starts).groupBy(video).agg(F.min("cap_id").alias("_until"))
        c = c.join(until, video, "left").where(F.col("_until").isNull() | (F.col("cap_id") <= F.col("_until"))).drop("_until")
    rows = c.join(early, video)
    bounds: dict = {}

    def offers(row):
        a = row["_c"] or ""
        for s in row["_s"]:

            def ratio(floor, b=s["text"] or ""):
                if b.startswith(a[:20]):
                    return max(ratio_from(a, b, 0.0, bounds), SAME_START)
                return ratio_from(a, b, floor, bounds)

            yield s["pos"], (row["start"], s["pos"], s["sec"]), ratio

    names = [("start", rows.schema["start"].dataType), ("pos", s.schema["pos"].dataType), ("sec", s.schema["sec"].dataType)]
    scored = _scored(rows, video, names, offers, lambda r: r > good, good)
    order = F.struct("cap_id", "pos")
    row = F.struct("cap_id", "start", "pos", "sec", "ratio")
    picked = scored.groupBy(video).agg(
        F.min_by(row, F.when(F.col("ratio") > good, order)).alias("_good"),
        F.max_by(row, F.struct(F.col("ratio"), -F.col("cap_id"), -F.col("pos"))).alias("_best"),
    ).withColumn("_p", F.coalesce("_good", "_best"))
    fallback = captions.groupBy(video).agg(F.min_by("start", "cap_id").alias("first_start"))
    base = segments.groupBy(video).agg(F.min_by("sec", "pos").alias("base"))
    out = fallback.join(picked, video, "left").join(base, video, "left")
    accepted = F.col("_p.ratio") >= accept
    offset = F.when(accepted, F.col("_p.start") - (F.col("_p.sec") - F.col("base"))).otherwise(F.col("first_start"))
    return out.select(video, offset.alias("offset"), F.col("_p.ratio").alias("ratio"))


def first_caption_start(captions: DataFrame, video: str) -> DataFrame:
    return captions.groupBy(video).agg(F.min_by("start", "cap_id").alias("offset"))
