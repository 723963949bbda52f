"""Search over a stored index: every document is indexed, in two batches, and one batch is delivered twice."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..plans.textindex import TextIndex
from ..session import checkpoint_dir, removed_at_exit
from .tables import spread_table, table


def _index(spark, d) -> TextIndex:
    folder = removed_at_exit(spark, f"{checkpoint_dir(spark)}/index-{uuid.uuid4().hex}")
    documents = spread_table(spark, d, "documents").select("doc_id", "lang", "text")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    index = TextIndex(spark, folder, buckets=8)
    index.add(documents.where(english).limit(3), "doc_id", "text", "en")  # a broken delivery, replaced below
    return index.add(documents.where(english), "doc_id", "text", "en").add(documents.where(~english), "doc_id", "text", "other")


def _queries(spark, d, first: int, words: int):
    """Some words of every benchmark item as a query."""
    cut = F.array_join(F.slice(F.split("text", r"\s+"), first, words), " ")
    return table(spark, d, "benchmark").groupBy("item_id").agg(F.min("text").alias("text")).select("item_id", cut.alias("q"))


def indexed_search(spark, d):
    """The ten best documents for the first words of every benchmark item."""
    return _index(spark, d).ranked(_queries(spark, d, 1, 8), "item_id", "q", k=10)


def phrase_search(spark, d):
    """Where four words of a benchmark item stand in a row in a document."""
    return _index(spark, d).phrases(_queries(spark, d, 3, 4), "item_id", "q")


def _sql(first: int, last: int) -> str:
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
q AS (SELECT item_id, regexp_extract_all(lower(array_to_string(string_split_regex(min(text), '\\s+')[{first}:{last}], ' ')), '[\\p{{L}}\\p{{N}}]+') AS w
      FROM benchmark GROUP BY item_id)"""


RANKED_SQL = (
    _sql(1, 8)
    + """,
p AS (SELECT doc_id, len(w) AS words, unnest(w) AS term FROM d),
f AS (SELECT doc_id, words, term, count(*) AS tf FROM p GROUP BY ALL),
n AS (SELECT term, count(*) AS df FROM f GROUP BY term),
t AS (SELECT count(*) AS docs, sum(len(w)) / count(*) AS mean FROM d),
a AS (SELECT DISTINCT item_id, unnest(w) AS term FROM q),
s AS (
  SELECT item_id AS query, doc_id AS doc,
         round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * words / mean))), 9) AS score
  FROM a JOIN f USING (term) JOIN n USING (term), t GROUP BY 1, 2)
SELECT query, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc)::INT AS rank, doc, score FROM s
QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) <= 10
"""
)
PHRASE_SQL = (
    _sql(3, 6)
    + """,
x AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
h AS (SELECT q.item_id AS query, x.doc_id AS doc, x.i - 1 AS pos FROM q JOIN x ON x.w[x.i] = q.w[1] WHERE len(q.w) > 0 AND x.w[x.i:x.i + len(q.w) - 1] = q.w)
SELECT query, doc, count(*) AS hits, min(pos) AS first FROM h GROUP BY 1, 2
"""
)

QUERIES = {"indexed_search": (indexed_search, RANKED_SQL), "phrase_search": (phrase_search, PHRASE_SQL)}
