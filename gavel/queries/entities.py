"""Entity, acronym and casing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators.keyed import distinct_union
from ..plans import entities, truecase
from .tables import spread_table, table

PLACE = "Springfield"


def _memos(spark, d):
    """Agenda texts made from orders: one memo per order, document = customer."""
    o = table(spark, d, "orders")
    first = F.when(F.col("o_orderstatus") == "F", "Anna").when(F.col("o_orderstatus") == "O", "Berta").otherwise("Clara")
    last = F.when(F.col("o_custkey") % 3 == 0, "Smith").when(F.col("o_custkey") % 3 == 1, "Jones").otherwise("Permit")
    text = F.concat(
        F.lit("Memorandum from "), first, F.lit(" "), last, F.lit(" to the Springfield Fire Department. Grace "),
        F.initcap(F.regexp_extract("o_orderpriority", r"-(\w+)", 1)), F.lit(" Hospital; initiated by Miranda"),
    )
    return o.select(F.col("o_custkey").alias("doc"), "o_orderkey", text.alias("text"))


MEMO_SQL = """
nm AS (SELECT o_custkey AS doc, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Anna' WHEN 'O' THEN 'Berta' ELSE 'Clara' END || ' ' || CASE o_custkey % 3 WHEN 0 THEN 'Smith' WHEN 1 THEN 'Jones' ELSE 'Permit' END AS name,
  'Grace ' || upper(regexp_extract(o_orderpriority, '-(\\w+)', 1)[1]) || lower(regexp_extract(o_orderpriority, '-(\\w+)', 1)[2:]) || ' Hospital' AS org FROM orders)
"""


def people_found(spark, d):
    m = _memos(spark, d)
    return entities.name_rows(m, "doc", "text", entities.people_in("text", (PLACE.lower(),)))


def organizations_found(spark, d):
    m = _memos(spark, d)
    return entities.name_rows(m, "doc", "text", entities.organizations_in("text", PLACE))


def entity_agreement(spark, d):
    """Rule names against predictions (every even customer's names, and one more)."""
    rows = people_found(spark, d)
    more = table(spark, d, "customer").select(F.col("c_custkey").alias("doc"), F.lit("Model Guess").alias("name"))
    model = rows.where(F.col("doc") % 2 == 0).unionByName(more.where(F.col("doc") % 7 == 0))
    return entities.agree(rows, model, ["doc", "name"])


AGREE = MEMO_SQL + """,
r AS (SELECT DISTINCT doc, name FROM nm WHERE name NOT LIKE '% Permit'),
ml AS (SELECT doc, name FROM r WHERE doc % 2 = 0 UNION SELECT c_custkey, 'Model Guess' FROM customer WHERE c_custkey % 7 = 0),
ag AS (SELECT coalesce(r.doc, ml.doc) AS doc, coalesce(r.name, ml.name) AS name, CASE WHEN r.doc IS NOT NULL AND ml.doc IS NOT NULL THEN 1.0 WHEN r.doc IS NOT NULL THEN 0.9 ELSE 0.5 END AS confidence
       FROM r FULL JOIN ml ON r.doc = ml.doc AND r.name = ml.name)
"""


def entity_stats(spark, d):
    return entities.entity_stats(entity_agreement(spark, d), "doc", ["name"]).select("name", "frequency", "agendas", "confidence", "score")


STATS_SQL = f"""
WITH {AGREE} SELECT name, count(*) AS frequency, count(DISTINCT doc) AS agendas, CAST(round_even(avg(CAST(confidence AS DOUBLE)), 2) AS DOUBLE) AS confidence,
  CAST(round_even(count(*) * avg(CAST(confidence AS DOUBLE)), 2) AS DOUBLE) AS score FROM ag GROUP BY 1
"""


def speaker_stats(spark, d):
    """Speaker frequency and spread; made two-word speakers per user and event type."""
    e = table(spark, d, "events")
    who = F.when(F.col("event_type") == "error", "THE CLERK").when(F.col("event_type") == "view", "SPEAKER").otherwise(F.concat(F.lit("COUNCIL  "), F.upper("event_type")))
    return entities.speaker_stats(e.select(who.alias("speaker"), "user_id"), "speaker", "user_id")


SPEAKER_SQL = """
WITH s AS (SELECT 'Council ' || upper(event_type[1]) || event_type[2:] AS name, user_id, count(*) AS n FROM events WHERE event_type NOT IN ('error', 'view') GROUP BY ALL)
SELECT name, CAST(sum(n) AS BIGINT) AS frequency, count(*) AS transcripts, CAST(sum(n) * count(*) AS DOUBLE) AS score FROM s GROUP BY 1
"""


def merged_speakers(spark, d):
    """Word pairs of documents merged with speakers, case-insensitively."""
    docs = spread_table(spark, d, "documents")
    pairs = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"([A-Z][a-z]+ [a-z]+)"), F.lit(1)))).alias("name"))
    ents = entities.entity_stats(pairs.withColumn("confidence", F.lit(0.9)), "doc_id", ["name"])
    speakers = table(spark, d, "conversations").select("conv_id", F.upper(F.regexp_extract("text", r"^([A-Z][a-z]+ [a-z]+)", 1)).alias("speaker")).where(F.col("speaker") != "")
    stats = entities.speaker_stats(speakers, "speaker", "conv_id")
    out = entities.merge_speakers(ents, stats)
    return out.select("name", "frequency", F.round("confidence", 2).alias("confidence"), F.round("score", 2).alias("score"), "agendas", "transcripts")


MERGED_SQL = r"""
WITH p AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '([A-Z][a-z]+ [a-z]+)', 1)) AS name FROM documents),
e0 AS (SELECT name, count(*) AS frequency, round_even(count(*) * 0.9, 2) AS score FROM p GROUP BY 1),
e AS (SELECT lower(name) AS k, arg_min(name, (-score, name)) AS name, arg_min(frequency, (-score, name)) AS frequency, arg_min(score, (-score, name)) AS score FROM e0 GROUP BY 1),
s0 AS (SELECT lower(regexp_extract(text, '^([A-Z][a-z]+ [a-z]+)', 1)) AS k, conv_id, count(*) AS n FROM conversations WHERE regexp_extract(text, '^([A-Z][a-z]+ [a-z]+)', 1) <> '' GROUP BY ALL),
s AS (SELECT k, sum(n) AS frequency, count(*) AS transcripts, array_to_string(list_transform(string_split(k, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS name FROM s0 GROUP BY 1)
SELECT coalesce(s.name, e.name) AS name, CAST(coalesce(e.frequency, 0) + coalesce(s.frequency, 0) AS BIGINT) AS frequency,
  CASE WHEN s.k IS NOT NULL THEN 1.0::DOUBLE ELSE 0.9::DOUBLE END AS confidence, CAST(round(coalesce(e.score, 0) + coalesce(s.frequency * s.transcripts, 0), 2) AS DOUBLE) AS score,
  coalesce(e.frequency, 0) AS agendas, coalesce(s.transcripts, 0) AS transcripts
FROM e FULL JOIN s ON e.k = s.k
"""


def _variants(spark, d):
    """Name variants of customers: title, plain and suffix form of one person per nation and segment."""
    c = table(spark, d, "customer")
    base = F.concat(F.lit("Ann "), F.initcap(F.lower("c_mktsegment")))
    form = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("Chief "), base)).when(F.col("c_custkey") % 3 == 1, base).otherwise(F.concat(base, F.lit(", Jr.")))
    rows = c.groupBy(form.alias("name"), (F.col("c_custkey") % 3).alias("v")).agg(F.count(F.lit(1)).alias("frequency"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("score"))
    return rows.select("name", "frequency", "score", F.col("frequency").alias("agendas"), F.lit(0).cast("bigint").alias("transcripts"), F.lit(0.9).alias("confidence"), F.col("v").alias("rank"))


def merged_people(spark, d):
    out = entities.merge_people(_variants(spark, d))
    return out.select("name", "normalized", "frequency", F.round("score", 2).alias("score"), "agendas", "variants", "confidence")


MERGE_PEOPLE_SQL = """
WITH c AS (SELECT *, 'Ann ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS base FROM customer),
v AS (SELECT base, c_custkey % 3 AS r, CASE c_custkey % 3 WHEN 0 THEN 'Chief ' || base WHEN 1 THEN base ELSE base || ', Jr.' END AS name, count(*) AS f, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS sc FROM c GROUP BY ALL)
SELECT arg_min(name, r) AS name, lower(base) AS normalized, CAST(sum(f) AS BIGINT) AS frequency, round(CAST(sum(sc) AS DOUBLE), 2) AS score, CAST(sum(f) AS BIGINT) AS agendas, count(*) AS variants,
  CASE WHEN count(*) > 1 THEN 1.0::DOUBLE ELSE 0.9::DOUBLE END AS confidence FROM v GROUP BY base
"""


def name_kinds(spark, d):
    """Person, business or neither, on made names."""
    c = table(spark, d, "customer")
    seg = F.initcap(F.lower("c_mktsegment"))
    n = F.col("c_custkey") % 6
    name = (
        F.when(n == 0, F.concat(F.lit("City "), seg)).when(n == 1, F.concat(seg, F.lit(" Services"))).when(n == 2, F.concat(seg, F.lit(" Group")))
        .when(n == 3, "Zoning Administrator").when(n == 4, F.concat(seg, F.lit(" inc. Holdings"))).otherwise(F.concat(F.lit("Ann "), seg))
    )
    return c.select("c_custkey", rules.name_kind(name).alias("kind"))


def acronyms(spark, d):
    """Upper-case tokens in two or more documents, common words left out."""
    docs = spread_table(spark, d, "documents")
    stop = table(spark, d, "nation").select(F.lit("the").alias("word")).union(table(spark, d, "region").select(F.lower("r_name")))
    return entities.acronyms(docs, "doc_id", ["text"], stop)


ACRONYM_SQL = r"""
WITH t AS (SELECT DISTINCT doc_id, unnest(list_filter(regexp_split_to_array(text, '[^\p{L}\p{M}\p{N}_]+'), lambda x: regexp_full_match(x, '[A-Z]{2,5}'))) AS token FROM documents)
SELECT token, count(*) AS meetings FROM t WHERE token <> 'THE' AND token NOT IN (SELECT r_name FROM region) GROUP BY 1 HAVING count(*) >= 2
"""


def config_merge(spark, d):
    """Known list united with what was found, new entries marked."""
    found = acronyms(spark, d).select("token")
    known = spread_table(spark, d, "documents").select(F.upper("lang").alias("token"))
    union, new = entities.merge_config(known, found, "token")
    return union.join(new.withColumn("is_new", F.lit(1)), "token", "left").select("token", F.coalesce("is_new", F.lit(0)).alias("is_new"))


CONFIG_SQL = r"""
WITH t AS (SELECT DISTINCT doc_id, unnest(list_filter(regexp_split_to_array(text, '[^\p{L}\p{M}\p{N}_]+'), lambda x: regexp_full_match(x, '[A-Z]{2,5}'))) AS token FROM documents),
f AS (SELECT token FROM t WHERE token <> 'THE' AND token NOT IN (SELECT r_name FROM region) GROUP BY 1 HAVING count(*) >= 2),
k AS (SELECT DISTINCT upper(lang) AS token FROM documents)
SELECT token, CASE WHEN token IN (SELECT token FROM k) THEN 0 ELSE 1 END AS is_new FROM (SELECT token FROM k UNION SELECT token FROM f)
"""


def standard_union(spark, d):
    """Distinct names over several lists, counted per category."""
    n = table(spark, d, "nation").select(F.lit("nation").alias("category"), F.col("n_name").alias("name"))
    r = table(spark, d, "region").select(F.lit("region").alias("category"), F.col("r_name").alias("name"))
    p = table(spark, d, "part").select(F.lit("part").alias("category"), F.col("p_name").alias("name"))
    b = table(spark, d, "part").select(F.lit("part").alias("category"), F.col("p_brand").alias("name"))
    return distinct_union(n, r, p, b).groupBy("category").agg(F.count(F.lit(1)).alias("names"))


def ranked_entities(spark, d):
    """Every word pair of the documents with its rank by score, then name."""
    docs = spread_table(spark, d, "documents")
    pairs = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"([A-Z][a-z]+ [a-z]+)"), F.lit(1)))).alias("name"))
    stats = pairs.groupBy("name").agg(F.count(F.lit(1)).cast("double").alias("score"))
    return entities.ranked(stats).select("name", "score", F.col("rank").cast("bigint").alias("rank"))


RANKED_SQL = r"""
WITH p AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '([A-Z][a-z]+ [a-z]+)', 1)) AS name FROM documents),
s AS (SELECT name, CAST(count(*) AS DOUBLE) AS score FROM p GROUP BY 1)
SELECT name, score, row_number() OVER (ORDER BY score DESC, name) AS rank FROM s
"""


def top_entities(spark, d):
    docs = spread_table(spark, d, "documents")
    pairs = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"([A-Z][a-z]+ [a-z]+)"), F.lit(1)))).alias("name"))
    return entities.top(pairs.groupBy("name").agg(F.count(F.lit(1)).alias("score")))


TOP_SQL = r"""
WITH p AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '([A-Z][a-z]+ [a-z]+)', 1)) AS name FROM documents)
SELECT name, count(*) AS score FROM p GROUP BY 1 ORDER BY score DESC, name LIMIT 20
"""


def surname_index(spark, d):
    """Surname index and standalone surnames of supplier and customer names made of two words."""
    c = table(spark, d, "customer").select(F.concat(F.initcap(F.lower("c_mktsegment")), F.lit(" Lee-"), F.initcap(F.lower("c_mktsegment"))).alias("name"))
    s = table(spark, d, "part").select(F.initcap("p_name").alias("name"))
    people = c.union(s).distinct()
    index = entities.surname_index(people).select("word", "proper")
    alone = entities.standalone_surnames(people).select(F.concat(F.lit("alone:"), "name").alias("word"), F.col("name").alias("proper"))
    return index.union(alone)


SURNAME_SQL = """
WITH seg AS (SELECT DISTINCT upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS s FROM customer),
n AS (SELECT s || ' Lee-' || s AS name FROM seg UNION SELECT array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') FROM part),
w AS (SELECT unnest(list_concat(string_split(string_split(name, ' ')[-1], '-'), [string_split(name, ' ')[1]])) AS proper FROM n WHERE len(string_split(name, ' ')) >= 2),
al AS (SELECT name FROM n UNION SELECT string_split(name, ' ')[-1] FROM n WHERE contains(name, ' ') AND length(string_split(name, ' ')[-1]) > 2)
SELECT lower(proper) AS word, min(proper) AS proper FROM w GROUP BY 1 UNION ALL SELECT 'alone:' || name, name FROM al
"""


def word_chunks(spark, d):
    docs = spread_table(spark, d, "documents")
    rows = docs.select("doc_id", F.posexplode(entities.word_chunks("text")).alias("chunk_no", "chunk"))
    return rows.select("doc_id", F.col("chunk_no").cast("bigint").alias("chunk_no"), F.size(F.split("chunk", " ")).cast("bigint").alias("words"))


CHUNK_SQL = r"""
WITH w AS (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: length(x) > 0)) AS n FROM documents)
SELECT doc_id, CAST(k AS BIGINT) AS chunk_no, CAST(least(250, n - k * 250) AS BIGINT) AS words FROM (SELECT doc_id, n, unnest(range(0, (n + 249) // 250)) AS k FROM w WHERE n > 0)
"""


def _dictionary(spark, d):
    """Casing dictionary from the names that occur in the tables."""
    kinds = [
        truecase.dictionary_rows(table(spark, d, "nation").select(F.col("n_name").alias("name")), "entity"),
        truecase.dictionary_rows(table(spark, d, "part").select(F.initcap("p_name").alias("name")), "entity"),
        truecase.dictionary_rows(spread_table(spark, d, "documents").select(F.upper("lang").alias("name")).distinct(), "acronym"),
    ]
    out = kinds[0]
    for k in kinds[1:]:
        out = out.unionByName(k)
    return out


def _shouted(spark, d):
    """part names in capitals inside a sentence."""
    p = table(spark, d, "part")
    return p.select(
        "p_partkey", F.upper(F.concat(F.lit("we need "), "p_name", F.lit(" now. the EN team buys it, don't wait for us"))).alias("shouted")
    )


def truecased_parts(spark, d):
    """Made capitals sentences cased with the dictionary."""
    return truecase.truecase(_shouted(spark, d), "p_partkey", "shouted", _dictionary(spark, d)).select("p_partkey", "cased")


def truecased_parts_joined(spark, d):
    """The same with the part names as predictions of their own texts, not in the dictionary."""
    p = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("phrase"), F.initcap("p_name").alias("proper"), F.lit("entity").alias("kind"))
    dictionary = _dictionary(spark, d).where("kind = 'acronym'")
    return truecase.truecase(_shouted(spark, d), "p_partkey", "shouted", dictionary, predictions=p).select("p_partkey", "cased")


CASED_SQL = """
SELECT p_partkey, 'We need ' || array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') || ' now. The EN team buys it, don''t wait for us' AS cased FROM part
"""


def truecased_turns(spark, d):
    """Every conversation turn, shouted and cased again."""
    c = spread_table(spark, d, "conversations").select(F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("turn_id"), F.upper("text").alias("shouted"))
    return truecase.truecase(c, "turn_id", "shouted", _dictionary(spark, d)).select("turn_id", "cased")


#: Words alone: no name of the dictionary has two words that stand side by side in a turn.
TURNS_SQL = """
WITH t AS (
  SELECT conv_id || '/' || turn AS turn_id, upper(replace(text, 'ß', 'ss')) AS shouted,
         string_split_regex(trim(lower(upper(replace(text, 'ß', 'ss')))), '\\s+') AS w
  FROM conversations),
k AS (SELECT turn_id, i, w[i] AS token, coalesce(regexp_matches(w[i - 1], '[.!?]'), false) OR i = 1 AS opens, regexp_extract(w[i], '^[^\\p{L}\\p{N}_]*', 0) AS lead
      FROM (SELECT turn_id, w, unnest(range(1, len(w) + 1)) AS i FROM t)),
c AS (SELECT *, regexp_extract(substr(token, length(lead) + 1), '^(.*?)[^\\p{L}\\p{N}_]*$', 1) AS core FROM k),
n AS (SELECT DISTINCT lower(lang) AS term FROM documents),
e AS (SELECT lower(n_name) AS term, min(n_name) AS proper FROM nation GROUP BY 1),
o AS (
  SELECT turn_id, i, CASE WHEN core = '' THEN token ELSE lead || CASE
      WHEN core IN (SELECT term FROM n) THEN upper(core)
      WHEN opens THEN upper(core[1]) || core[2:] WHEN core = 'i' THEN 'I' ELSE coalesce(e.proper, core) END
      || substr(token, length(lead) + length(core) + 1) END AS cased
  FROM c LEFT JOIN e ON e.term = core)
SELECT t.turn_id, CASE WHEN trim(t.shouted) = '' OR t.shouted IS NULL THEN t.shouted ELSE s.cased END AS cased
FROM t LEFT JOIN (SELECT turn_id, string_agg(cased, ' ' ORDER BY i) AS cased FROM o GROUP BY turn_id) s USING (turn_id)
"""


def dictionary_build(spark, d):
    """The whole dictionary build on made memos and speakers."""
    m = _memos(spark, d)
    seg = table(spark, d, "events").select(F.col("user_id").alias("doc"), F.when(F.col("event_type") == "view", "ANNA SMITH").otherwise(F.concat(F.lit("COUNCIL "), F.upper("event_type"))).alias("speaker"))
    built = entities.build_dictionary(m, seg, "doc", "text", PLACE)
    cols = ["name", "frequency", F.round("score", 2).alias("score"), F.col("rank").cast("bigint").alias("rank")]
    people = built["people"].select(F.lit("people").alias("kind"), *cols)
    return people.unionByName(built["organizations"].select(F.lit("organizations").alias("kind"), *cols))


DICTIONARY_SQL = f"""
WITH {MEMO_SQL},
pe AS (SELECT name, count(DISTINCT doc) AS f, round_even(count(DISTINCT doc) * 0.9, 2) AS sc FROM nm WHERE name NOT LIKE '% Permit' GROUP BY 1),
s0 AS (SELECT CASE WHEN event_type = 'view' THEN 'Anna Smith' ELSE 'Council ' || upper(event_type[1]) || event_type[2:] END AS name, user_id, count(*) AS n FROM events GROUP BY ALL),
sp AS (SELECT name, sum(n) AS f, sum(n) * count(*) AS sc FROM s0 GROUP BY 1),
al AS (SELECT coalesce(sp.name, pe.name) AS name, coalesce(pe.f, 0) + coalesce(sp.f, 0) AS f, round(CAST(coalesce(pe.sc, 0) + coalesce(sp.sc, 0) AS DOUBLE), 2) AS sc FROM pe FULL JOIN sp ON lower(pe.name) = lower(sp.name)),
og AS (SELECT org AS name, count(DISTINCT doc) AS f, round_even(count(DISTINCT doc) * 0.9, 2) AS sc FROM nm GROUP BY 1
       UNION ALL SELECT 'Springfield Fire Department', count(DISTINCT doc), round_even(count(DISTINCT doc) * 0.9, 2) FROM nm)
SELECT 'people' AS kind, name, CAST(f AS BIGINT) AS frequency, CAST(sc AS DOUBLE) AS score, row_number() OVER (ORDER BY sc DESC, name) AS rank FROM al
UNION ALL SELECT 'organizations', name, f, CAST(sc AS DOUBLE), row_number() OVER (ORDER BY sc DESC, name) FROM og
"""

QUERIES = {
    "people_found": (people_found, f"WITH {MEMO_SQL} SELECT DISTINCT doc, name FROM nm WHERE name NOT LIKE '% Permit'"),
    "organizations_found": (
        organizations_found,
        f"WITH {MEMO_SQL} SELECT DISTINCT doc, org AS name FROM nm UNION SELECT doc, 'Springfield Fire Department' FROM nm",
    ),
    "entity_agreement": (entity_agreement, f"WITH {AGREE} SELECT doc, name, CAST(confidence AS DOUBLE) AS confidence FROM ag"),
    "entity_stats": (entity_stats, STATS_SQL),
    "speaker_stats": (speaker_stats, SPEAKER_SQL),
    "merged_speakers": (merged_speakers, MERGED_SQL),
    "merged_people": (merged_people, MERGE_PEOPLE_SQL),
    "name_kinds": (
        name_kinds,
        "SELECT c_custkey, CASE WHEN c_custkey % 6 IN (0, 1, 3) THEN 'non_person' WHEN c_custkey % 6 IN (2, 4) THEN 'business' ELSE 'person' END AS kind FROM customer",
    ),
    "acronyms": (acronyms, ACRONYM_SQL),
    "config_merge": (config_merge, CONFIG_SQL),
    "standard_union": (
        standard_union,
        """SELECT 'nation' AS category, count(DISTINCT n_name) AS names FROM nation UNION ALL SELECT 'region', count(DISTINCT r_name) FROM region
           UNION ALL SELECT 'part', (SELECT count(*) FROM (SELECT p_name FROM part UNION SELECT p_brand FROM part))""",
    ),
    "ranked_entities": (ranked_entities, RANKED_SQL),
    "top_entities": (top_entities, TOP_SQL),
    "surname_index": (surname_index, SURNAME_SQL),
    "word_chunks": (word_chunks, CHUNK_SQL),
    "truecased_parts": (truecased_parts, CASED_SQL),
    "truecased_parts_joined": (truecased_parts_joined, CASED_SQL),
    "truecased_turns": (truecased_turns, TURNS_SQL),
    "dictionary_build": (dictionary_build, DICTIONARY_SQL),
}
