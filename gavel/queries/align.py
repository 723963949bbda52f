"""Alignment queries: captions from benchmark and conversations, segments from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import best_window, content_words, match_words, substring_position
from ..plans import align
from ..session import stored
from .tables import spread_table, table


def _words(df, ident, text="text"):
    return df.select(F.lit(0).alias("k"), ident, match_words(text).alias("w"))


def caption_matches(spark, d):
    """Every benchmark item against every document: 3-gram score of at least 0.3, all words."""
    c = _words(table(spark, d, "benchmark"), "item_id")
    s = _words(spread_table(spark, d, "documents"), "doc_id")
    out = align.ngram_matches(c, s, ["k"], "item_id", "doc_id", "w", "w")
    return out.select("item_id", "doc_id", F.round("score", 6).alias("score"))


NORM = r"list_filter(string_split(trim(regexp_replace(regexp_replace(upper(replace(text, 'ß', 'ss')), '[^A-Z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda w: length(w) > 0)"

MATCH_SQL = f"""
WITH b AS (SELECT item_id, {NORM} AS w FROM benchmark), dd AS (SELECT doc_id, {NORM} AS w FROM documents),
bg AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) AS g, len(w) - 2 AS n FROM b),
dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) AS g FROM dd WHERE len(w) >= 3)
SELECT item_id, doc_id, round(count(*) / any_value(n), 6) AS score FROM bg JOIN dg USING (g) GROUP BY 1, 2 HAVING count(*) / any_value(n) >= 0.3
UNION ALL
SELECT item_id, doc_id, round(len(list_filter(b.w, lambda x: list_contains(dd.w, x))) / len(b.w), 6) FROM b, dd
WHERE len(dd.w) < 3 AND len(list_filter(b.w, lambda x: list_contains(dd.w, x))) / len(b.w) >= 0.3
"""


def caption_filter(spark, d):
    """Documents that would pass as spoken captions."""
    docs = spread_table(spark, d, "documents").withColumn("no_speech_prob", (F.col("doc_id") % 10) / 10.0)
    return align.clean_captions(docs).select("doc_id")


FILTER_SQL = f"""
WITH c AS (SELECT doc_id, text, list_filter({NORM}, lambda w: length(w) >= 3 AND regexp_matches(w, '[A-Z]') AND NOT list_contains(['{{stop}}'], w)) AS c FROM documents)
SELECT doc_id FROM c WHERE doc_id % 10 <= 5 AND length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) / length(text) >= 0.85 AND len(c) >= 4
"""


def match_positions(spark, d):
    """Where a turn's middle words stand in the turn: by substring and by best window."""
    c = spread_table(spark, d, "conversations").withColumn("w", match_words("text")).where(F.size("w") >= 8)
    half = F.floor(F.size("w") / 2).cast("int")
    needle = F.array_join(F.slice("w", F.floor(F.size("w") / 4).cast("int") + 1, half), " ")
    win = best_window(F.slice("w", F.floor(F.size("w") / 4).cast("int") + 1, half), F.col("w"))
    return c.select(
        "conv_id", "turn", F.round(substring_position(needle, "text"), 6).alias("by_text"),
        F.round(win["position"], 6).alias("by_window"), F.round(win["overlap"], 6).alias("overlap"),
    )


POSITION_SQL = f"""
WITH c AS (SELECT conv_id, turn, {NORM} AS w FROM conversations),
n AS (SELECT *, len(w) AS n, w[len(w) // 4 + 1 : len(w) // 4 + len(w) // 2] AS a FROM c WHERE len(w) >= 8),
t AS (SELECT *, array_to_string(w, ' ') AS t, array_to_string(a, ' ') AS s FROM n),
sc AS (SELECT conv_id, turn, i, len(list_intersect(list_distinct(a), list_distinct(w[i + 1 : i + len(a)]))) AS sh, len(list_distinct(a)) AS da, n - len(a) AS room
       FROM (SELECT *, unnest(range(0, n - len(a) + 1)) AS i FROM t)),
bw AS (SELECT conv_id, turn, arg_max(i, (sh, -i)) AS i, max(sh) AS sh, any_value(da) AS da, any_value(room) AS room FROM sc GROUP BY 1, 2)
SELECT t.conv_id, t.turn, round((strpos(t.t, t.s) - 1) / length(t.t), 6) AS by_text, round(i / room, 6) AS by_window, round(sh / da, 6) AS overlap
FROM t JOIN bw USING (conv_id, turn)
"""


def _captions(spark, d):
    """Sentences of every turn as captions of its conversation."""
    c = spread_table(spark, d, "conversations")
    rows = c.select("conv_id", "turn", F.posexplode(F.split("text", r"[.\n]")).alias("i", "text")).where(F.length(F.trim("text")) > 0)
    cap_id = F.col("turn") * (1 << 32) + F.col("i")
    return rows.select("conv_id", cap_id.alias("cap_id"), (F.col("turn") * 60 + F.col("i") * 5 + 40).cast("double").alias("start"), "text", F.lit(0.0).alias("no_speech_prob"))


def _segments(spark, d):
    return spread_table(spark, d, "conversations").select("conv_id", F.col("turn").alias("seg_id"), F.col("turn").alias("pos"), (F.col("turn") * 60).alias("sec"), "text")


def aligned_offsets(spark, d):
    """Offset of every conversation's captions against its turns."""
    out = align.align(_captions(spark, d), _segments(spark, d), "conv_id")
    return out.select("conv_id", "n_pairs", "support", F.round("offset", 3).alias("offset"), F.round("score", 6).alias("score"))


def early_matches(spark, d):
    """Fuzzy pairs of the first captions and turns that have no n-gram match."""
    from ..operators.sequence import Position, Sequence

    c = Sequence(["conv_id"], ["cap_id"], ["cap_id"]).apply(align.clean_captions(_captions(spark, d)), pos=Position())
    c = stored(c.withColumn("pos", F.col("pos") - 1).withColumn("w", content_words("text")), "captions")
    s = _segments(spark, d).select("conv_id", "seg_id", "pos", "text", F.col("sec").alias("elapsed"), F.lit(60).alias("duration"), content_words("text").alias("w"))
    s = stored(s, "segments")
    known = align.ngram_matches(c, s, ["conv_id"], "cap_id", "seg_id", "w", "w")
    out = align.early_matches(c, s, known, ["conv_id"], "cap_id", "seg_id")
    return out.select("conv_id", "cap_id", "seg_id", F.round("score", 6).alias("score"))


EARLY_SQL = """
WITH RECURSIVE sp AS (SELECT conv_id, turn, unnest(regexp_split_to_array(text, '[.\\n]')) AS text, generate_subscripts(regexp_split_to_array(text, '[.\\n]'), 1) - 1 AS i FROM conversations),
cw AS (SELECT conv_id, turn * 4294967296 + i AS cap_id, text, list_filter({NORM}, lambda w: length(w) >= 3 AND regexp_matches(w, '[A-Z]') AND NOT list_contains(['{stop}'], w)) AS w FROM sp WHERE length(trim(text)) > 0),
cc AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cap_id) - 1 AS pos FROM cw WHERE len(w) >= 4 AND length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) / length(text) >= 0.85),
ss AS (SELECT conv_id, turn AS seg_id, list_filter({NORM}, lambda w: length(w) >= 3 AND regexp_matches(w, '[A-Z]') AND NOT list_contains(['{stop}'], w)) AS w FROM conversations),
pr AS (SELECT cc.conv_id, cap_id, seg_id, cc.w AS a, ss.w AS b,
   list_transform(range(1, len(cc.w) - 1), lambda i: array_to_string(cc.w[i:i+2], ' ')) AS a3, list_transform(range(1, greatest(len(ss.w) - 1, 1)), lambda i: array_to_string(ss.w[i:i+2], ' ')) AS b3,
   list_transform(range(1, len(cc.w)), lambda i: array_to_string(cc.w[i:i+1], ' ')) AS a2, list_transform(range(1, greatest(len(ss.w), 1)), lambda i: array_to_string(ss.w[i:i+1], ' ')) AS b2
   FROM cc JOIN ss ON cc.conv_id = ss.conv_id WHERE cc.pos < 5 AND seg_id < 15),
sr AS (SELECT *, len(list_filter(a, lambda x: list_contains(b, x))) / len(a) AS ws,
   CASE WHEN len(b) < 3 THEN len(list_filter(a, lambda x: list_contains(b, x))) / len(a) ELSE len(list_filter(a3, lambda x: list_contains(b3, x))) / len(a3) END AS s3,
   CASE WHEN len(b) < 2 THEN len(list_filter(a, lambda x: list_contains(b, x))) / len(a) ELSE len(list_filter(a2, lambda x: list_contains(b2, x))) / len(a2) END AS s2 FROM pr)
SELECT conv_id, cap_id, seg_id, round(0.6 * s2 + 0.4 * ws, 6) AS score FROM sr WHERE s3 < 0.3 AND 0.6 * s2 + 0.4 * ws >= 0.35
"""


def similar_text(spark, d):
    """Caption window most similar to the conversation's first turn."""
    ref = spread_table(spark, d, "conversations").where(F.col("turn") == 0).select("conv_id", F.col("text").alias("ref"))
    out = align.find_text(_captions(spark, d), ref, "conv_id", "ref")
    return out.select("conv_id", "start", F.round("ratio", 6).alias("ratio"))


def similar_start(spark, d):
    """Caption and turn that match best, as an offset per conversation."""
    out = align.match_start(_captions(spark, d), _segments(spark, d), "conv_id")
    return out.select("conv_id", F.round("offset", 3).alias("offset"), F.round("ratio", 6).alias("ratio"))


def first_captions(spark, d):
    return align.first_caption_start(_captions(spark, d), "conv_id")


FIRST_SQL = """
WITH sp AS (SELECT conv_id, turn, unnest(regexp_split_to_array(text, '[.\\n]')) AS text, generate_subscripts(regexp_split_to_array(text, '[.\\n]'), 1) - 1 AS i FROM conversations)
SELECT conv_id, arg_min(CAST(turn * 60 + i * 5 + 40 AS DOUBLE), turn * 4294967296 + i) AS "offset" FROM sp WHERE length(trim(text)) > 0 GROUP BY 1
"""


def _stop(sql: str) -> str:
    from ..functions.text import STOP_WORDS

    return sql.replace("{NORM}", NORM).replace("{stop}", "', '".join(STOP_WORDS))


QUERIES = {
    "caption_matches": (caption_matches, MATCH_SQL),
    "caption_filter": (caption_filter, _stop(FILTER_SQL)),
    "match_positions": (match_positions, POSITION_SQL),
    "aligned_offsets": (aligned_offsets, None),
    "early_matches": (early_matches, _stop(EARLY_SQL)),
    "similar_text": (similar_text, None),
    "similar_start": (similar_start, None),
    "first_captions": (first_captions, FIRST_SQL),
}
