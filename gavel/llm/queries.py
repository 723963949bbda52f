"""One query for each operator of this package, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavel.llm import audit, chat, decontaminate, html, jaccard, licenses, packing, patterns, quality, repeats, toxicity, trie, warc
from gavel.llm.common import read


def op1_host_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.scored(read(spark, d, "documents"), "text", "source", ("doc_id",))


OP1_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w),
dup AS (
  SELECT r, sum(n - 1)::BIGINT AS n_dup_lines
  FROM (SELECT r, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line)
  GROUP BY r),
windows AS (
  SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1),
rep AS (
  SELECT r, count(DISTINCT p)::BIGINT AS n_repeat_words
  FROM (SELECT r, i AS p FROM twice UNION ALL SELECT r, i + 1 FROM twice UNION ALL SELECT r, i + 2 FROM twice)
  GROUP BY r),
base AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN dup USING (r) LEFT JOIN rep USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
hosts AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS bad FROM judged WHERE source IS NOT NULL GROUP BY source),
moments AS (SELECT avg(bad / n) AS m, var_pop(bad / n) AS v FROM hosts),
rejected AS (
  SELECT source FROM hosts, moments
  WHERE CASE WHEN v > 1e-12 THEN (bad + m * greatest(m * (1 - m) / v - 1, 0)) / (n + greatest(m * (1 - m) / v - 1, 0))
             ELSE m END >= 0.8)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(source NOT IN (SELECT source FROM rejected), true) AS kept
FROM judged
"""

def op2_main_text(spark: SparkSession, d: str) -> DataFrame:
    pages = read(spark, d, "pages").select("page_id", "url", html.extracted(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


#: True for pages whose article is one `article` element, as in the given tables.
OP2_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS t FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(t, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM a),
c AS (SELECT page_id, url, replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>') AS t FROM b),
e AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(t, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, length(text) AS n_chars FROM e
"""


def op3_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    found = jaccard.classes(read(spark, d, "documents"))
    return found.select(F.col("row").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("class").alias("component_id"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ 	-
]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' ')))) AS g
  FROM d WHERE len(w) > 0),
u AS (SELECT g, md5(array_to_string(g, chr(10))) AS h, min(doc_id) AS node, len(g) AS n FROM s GROUP BY g),
x AS (SELECT node, n, unnest(g) AS g FROM u),
common AS (
  SELECT a.node AS a, b.node AS b, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.node < b.node
  AND a.n * 100 >= 85 * b.n AND b.n * 100 >= 85 * a.n GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM common UNION SELECT b, a FROM common),
reach AS (SELECT node AS a, node AS b FROM u UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
least AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(len(s.g), 0)::BIGINT AS n_shingles, coalesce(least.component, d.doc_id) AS component_id
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN u ON s.g = u.g LEFT JOIN least ON least.node = u.node
"""


def op4_license_scan(spark: SparkSession, d: str) -> DataFrame:
    found = read(spark, d, "documents").select("doc_id", licenses.license_scan(F.col("text")).alias("s"))
    return found.select("doc_id", *[f"s.{c}" for c in licenses.NAMES if c != "spans"])


def op5_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return repeats.report(read(spark, d, "documents"))


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, i, md5(b[i:i + 199]) AS h FROM (SELECT r, b, unnest(range(1, octet_length(b) - 198)) AS i FROM d)),
m AS (SELECT r, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
s AS (SELECT r, i, sum((i > coalesce(before, -9999) + 200)::INT) OVER (PARTITION BY r ORDER BY i) AS span
      FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM m)),
spans AS (SELECT r, span, min(i) AS a, max(i) + 199 AS z FROM s GROUP BY r, span),
kept AS (
  SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) + 1 AS f, a - 1 AS t FROM spans
  UNION ALL SELECT r, max(z) + 1, NULL FROM spans GROUP BY r),
k AS (SELECT r, string_agg(hex(b[f:coalesce(t, octet_length(b))]), '' ORDER BY f) FILTER (f <= coalesce(t, octet_length(b))) AS x
      FROM kept JOIN d USING (r) GROUP BY r),
n AS (SELECT r, sum(z - a + 1)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       CASE WHEN n_spans IS NULL THEN sha256(b) ELSE sha256(unhex(coalesce(x, ''))) END AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r)
"""


def op6_fm_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.report(read(spark, d, "documents"), read(spark, d, "benchmark"))


OP6_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
p AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
x AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d), sizes WHERE i + n - 1 <= len(w)),
hits AS (SELECT r, i, n, item FROM x JOIN p USING (n, phrase)),
covered AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS q FROM hits) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""


def op7_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.scored(read(spark, d, "documents"), read(spark, d, "labels"))


def op8_prefix_targets(spark: SparkSession, d: str) -> DataFrame:
    """All conversations and conversation -1, whose two texts are made of control strings."""
    rows = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    pair = F.explode(F.array(*[F.struct(F.lit(i).alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))]))
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), pair.alias("p"))
    extra = extra.select("conv_id", F.col("p.turn").cast("long").alias("turn"), "p.role", said.alias("text"))
    return chat.read_back(chat.examples(rows.union(extra)))


OP8_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
e AS (
  SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
         length(regexp_replace(text, '(\[/?|</?)(\\*)(INST\]|s>)', '\1\\\2\3', 'g'))
         + CASE WHEN role = 'assistant' THEN 4
                ELSE 16 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'),
                                                '(\[/?|</?)(\\*)(INST\]|s>)', '\1\\\2\3', 'g')) END AS size
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY k) AS prefix FROM e)
SELECT conv_id, n AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(prefix) FILTER (role = 'assistant' OR k = n)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id, n
"""

def op9_package_archive(spark: SparkSession, d: str) -> DataFrame:
    return warc.archived(read(spark, d, "pages"))


#: The digest is SHA-1 of the text's bytes as 32 base-32 letters of five bits each.
OP9_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, min(page_id) AS m, count(*) AS n FROM p GROUP BY h),
x AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, CASE WHEN n > 1 AND page_id IS DISTINCT FROM m THEN m END AS refers_to
      FROM p JOIN g USING (h)),
bits AS (SELECT *, array_to_string(list_transform(string_split(hex, ''),
           lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111', (instr('0123456789abcdef', c)::BIGINT - 1) * 4 + 1, 4)), '') AS b
         FROM x)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (list_sum(list_transform(range(0, 5), lambda j: (substr(b, (i * 5 + j + 1)::BIGINT, 1) = '1')::INT * (2 ** (4 - j))::INT)) + 1)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM bits
"""


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_bounded_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(read(spark, d, "documents"), tokenizer_path())


def op11_pattern_packing(spark: SparkSession, d: str) -> DataFrame:
    return patterns.packed(read(spark, d, "documents"), tokenizer_path())


def op12_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return trie.conversation_trie(read(spark, d, "conversations"))


OP12_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) - 1 AS pos, x, chars
  FROM (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x,
               length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL)),
s AS (
  SELECT c, n, xor(list_reduce(list_concat([4294967295], list_transform(string_split(c::VARCHAR, ''), lambda q: ascii(q)::BIGINT)),
             lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
               lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)), 4294967295) % 6 AS h
  FROM (SELECT c, count(*) AS n FROM t GROUP BY c)),
k AS (SELECT s.*, least(s.h, coalesce(f.n, 0)) AS taken FROM s LEFT JOIN s f ON f.c = s.c - s.c % 100),
r AS (
  SELECT k.c, t.pos, t.x, t.chars FROM k JOIN t ON t.c = k.c - k.c % 100 WHERE t.pos < k.h
  UNION ALL SELECT k.c, t.pos - k.h + k.taken, t.x, t.chars FROM k JOIN t ON t.c = k.c WHERE t.pos >= k.h),
l AS (SELECT k.c, coalesce(w, []) AS w FROM k LEFT JOIN (SELECT c, list(x ORDER BY pos) AS w FROM r GROUP BY c) q ON q.c = k.c),
m AS (SELECT c, d, len(w) AS size, sha256(array_to_string(w[:d], ',')) AS name FROM (SELECT c, w, unnest(range(0, len(w) + 1)) AS d FROM l)),
v AS (
  SELECT d, name, min(c) AS c, count(*) AS n, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = d), '')) AS ends
  FROM m GROUP BY d, name),
p AS (SELECT m.c AS member, m.d, v.c AS node FROM m JOIN v ON v.d = m.d AND v.name = m.name),
e AS (
  SELECT v.c, v.d, v.n, v.ends, p.node AS parent, (v.n - 1) * coalesce(r.chars, 0) AS saved
  FROM v LEFT JOIN p ON p.member = v.c AND p.d = v.d - 1 LEFT JOIN r ON r.c = v.c AND r.pos = v.d - 1),
b AS (SELECT parent AS c, d - 1 AS d, count(*) AS n_children FROM e WHERE d > 0 GROUP BY 1, 2),
g AS (SELECT e.*, coalesce(b.n_children, 0) AS n_children FROM e LEFT JOIN b ON b.c = e.c AND b.d = e.d),
u AS (
  SELECT p.node AS c, p.d, sum((g.n_children = 0)::INT) AS n_leaves, sum(g.saved) AS saved_tokens
  FROM g JOIN p ON p.member = g.c AND p.d <= g.d GROUP BY 1, 2)
SELECT g.c AS conv_id, g.d AS depth, g.parent AS parent_conv_id, g.n AS n_convs, g.n_children, u.n_leaves::BIGINT AS n_leaves,
       u.saved_tokens::BIGINT AS saved_tokens, g.ends AS ends_sha256
FROM g JOIN u ON u.c = g.c AND u.d = g.d
"""


def op13_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    return audit.audited(read(spark, d, "documents"), read(spark, d, "labels"))


OP13_SQL = r"""
WITH l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
b AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask
  FROM w LEFT JOIN l USING (doc_id)),
m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM b GROUP BY part, mask),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, bit)),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (
  SELECT filter_order, step, (SELECT bit FROM f WHERE f = filter_order[step]) AS bit
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
p AS (SELECT *, coalesce(sum(bit) OVER (PARTITION BY filter_order ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS before FROM s),
x AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
  FROM m, p GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM x
"""


QUERIES = {
    "op3_ngram_jaccard": (op3_ngram_jaccard, OP3_SQL),
    "op5_suffix_dedup": (op5_suffix_dedup, OP5_SQL),
    "op6_fm_decontamination": (op6_fm_decontamination, OP6_SQL),
    "op7_toxicity": (op7_toxicity, None),
    "op2_main_text": (op2_main_text, OP2_SQL),
    "op9_package_archive": (op9_package_archive, OP9_SQL),
    "op10_bounded_packing": (op10_bounded_packing, None),
    "op4_license_scan": (op4_license_scan, None),
    "op8_prefix_targets": (op8_prefix_targets, OP8_SQL),
    "op1_host_quality": (op1_host_quality, OP1_SQL),
    "op11_pattern_packing": (op11_pattern_packing, None),
    "op12_prefix_trie": (op12_prefix_trie, OP12_SQL),
    "op13_filter_audit": (op13_filter_audit, OP13_SQL),
}
