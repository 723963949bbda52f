"""Word and phrase search over stored postings, so that a query never reads the texts.

A batch of texts becomes rows (term, document, positions) in one shuffle: occurrences go to their bucket, grouped
in place and written sorted under its folder.  A bucket is a fixed share of the terms by hash, so later batches add to
the same buckets; a batch that is delivered again replaces its own files.  Texts are read once: the batch's term counts
and its size are taken from the postings, as every document has one under a mark of its own.

    postings/bucket=3/batch=b1   term, doc, words (length of the document), tf, positions
    terms/bucket=3/batch=b1      term, df, cf
    totals/batch=b1              documents, words

A table of queries is turned into terms, whose buckets prune the folders; their postings meet the queries by term, and
everything after that is grouped by query and document.  A very frequent term is spread over tasks when it is
written, as each bucket has several parts by document, and when it is read, as these are several files; the grouping
never brings its postings together.

Words are runs of letters and digits in lower case.  Null and empty texts have none, but count as documents; a
document may occur once in a batch, and in one batch at a time.  Queries without words, or with one that no document
has, find nothing in phrase search; in ranked search, unknown words add nothing and repeated words count once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"
BUCKETS = 64
#: Parts that each bucket of a batch is written in, by document: as many as leave a part this many documents, at least SLOTS.
SLOTS = 4
SLOT_DOCUMENTS = 40_000
#: The term that every document has once, at place -1; it is no word.
EVERY = ""
#: Query terms up to this number are broadcast to the postings; more are joined by a shuffle.
BROADCAST_TERMS = 200_000

# Fixed values of the usual ranking formula.
SATURATION = 1.2
LENGTH_SHARE = 0.75


def words(text: str | Column) -> Column:
    """The words of a text, in order."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


@dataclass(frozen=True)
class TextIndex:
    """An index in the folder `path`; `buckets` is fixed when the first batch is written."""

    spark: SparkSession
    path: str
    buckets: int = BUCKETS

    def bucket(self, term: str | Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int").alias("bucket")

    def add(self, texts: DataFrame, doc: str, text: str, batch: str, slots: int | None = None) -> TextIndex:
        """Index one batch of texts, or replace it if it was delivered before.  Parts grow in number with the batch, not
        in size, so that grouping and sorting one stays in memory."""
        slots = slots or max(SLOTS, -(-texts.count() // SLOT_DOCUMENTS))
        each = texts.select(F.col(doc).alias("doc"), words(text).alias("w")).select("doc", "w", F.size("w").alias("words"))
        with_mark = F.posexplode(F.concat(F.array(F.lit(EVERY)), "w")).alias("at", "term")
        found = each.select("doc", "words", with_mark).select("doc", "words", (F.col("at") - 1).alias("at"), "term")
        slot = F.pmod(F.xxhash64("doc"), F.lit(slots)).cast("int").alias("slot")
        cut = found.select(self.bucket("term"), slot, "*").repartition(self.buckets * slots, "bucket", "slot")
        postings = cut.groupBy("bucket", "slot", "term", "doc", "words").agg(F.array_sort(F.collect_list("at")).alias("positions"))
        postings = postings.drop("slot").withColumn("tf", F.size("positions")).sortWithinPartitions("bucket", "term", "doc")
        self._write(postings, "postings", batch, ["bucket"])
        stored = self.read("postings").where(F.col("batch") == batch)
        counts = stored.where(F.col("term") != EVERY).groupBy("bucket", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
        self._write(counts, "terms", batch, ["bucket"])
        marks = stored.where((F.col("bucket") == self.bucket(F.lit(EVERY))) & (F.col("term") == EVERY))
        sizes = marks.agg(F.count("*").alias("documents"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"))
        self._write(sizes, "totals", batch, [])
        return self

    def _write(self, rows: DataFrame, table: str, batch: str, by: list[str]) -> None:
        self._forget(table, batch)
        rows.withColumn("batch", F.lit(batch)).write.mode("append").partitionBy(*by, "batch").parquet(f"{self.path}/{table}")

    def _forget(self, table: str, batch: str) -> None:
        """Remove what an earlier delivery of the batch wrote, also in buckets that the new one does not reach."""
        context = self.spark.sparkContext
        pattern = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}" + ("/*" if table != "totals" else "") + f"/batch={batch}")
        system = pattern.getFileSystem(context._jsc.hadoopConfiguration())
        for status in system.globStatus(pattern) or []:
            system.delete(status.getPath(), True)

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}")

    def _asked(self, queries: DataFrame, query: str, text: str) -> DataFrame:
        """query, nth, term, bucket, and how many words the query has."""
        each = queries.select(F.col(query).alias("query"), words(text).alias("w")).where(F.size("w") > 0)
        asked = each.select("query", F.size("w").alias("n_words"), F.posexplode("w").alias("nth", "term"))
        return asked.select("*", self.bucket("term"))

    def _postings(self, asked: DataFrame) -> DataFrame:
        """The postings of the terms asked for, with their queries."""
        few = asked.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
        return self.read("postings").join(F.broadcast(asked) if few else asked, ["bucket", "term"])

    def ranked(self, queries: DataFrame, query: str, text: str, k: int = 10, saturation: float = SATURATION, length_share: float = LENGTH_SHARE) -> DataFrame:
        """query, rank, doc, score: the best `k` documents of every query; equal scores (to 9 digits) by document."""
        documents, total = self.read("totals").agg(F.sum("documents"), F.sum("words")).first()
        mean = total / documents if documents and total else 1.0
        asked = self._asked(queries, query, text).select("query", "term", "bucket").distinct()
        known = self.read("terms").join(asked.select("bucket", "term").distinct(), ["bucket", "term"])
        df = known.groupBy("bucket", "term").agg(F.sum("df").alias("df"))
        rarity = F.log(1 + (F.lit(float(documents or 0)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        weighed = asked.join(df, ["bucket", "term"]).select("query", "bucket", "term", rarity.alias("rarity"))
        tf, size = F.col("tf"), F.col("words") / F.lit(mean)
        part = F.col("rarity") * tf * (saturation + 1) / (tf + saturation * (1 - length_share + length_share * size))
        scored = self._postings(weighed).groupBy("query", "doc").agg(F.round(F.sum(part), 9).alias("score"))
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "doc"))  # cut to k before the shuffle
        return scored.withColumn("rank", place).where(F.col("rank") <= k).select("query", "rank", "doc", "score")

    def phrases(self, queries: DataFrame, query: str, text: str) -> DataFrame:
        """query, doc, hits, first: the documents that have the words of a query in a row, how often, and where first (from 0)."""
        hits = self._postings(self._asked(queries, query, text))
        starts = F.filter(F.transform("positions", lambda p: p - F.col("nth")), lambda p: p >= 0)
        met = hits.groupBy("query", "doc", "n_words").agg(F.collect_list(starts.alias("starts")).alias("s"))  # one array per word
        met = met.where(F.size("s") == F.col("n_words"))
        common = F.aggregate(F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(1))), F.element_at("s", 1), F.array_intersect)
        found = met.select("query", "doc", common.alias("at")).where(F.size("at") > 0)
        return found.select("query", "doc", F.size("at").cast("long").alias("hits"), F.array_min("at").cast("long").alias("first"))
