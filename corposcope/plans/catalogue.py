"""Queries over the test tables. Each runs over whole tables; the SQL beside it gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corposcope.functions import text
from corposcope.operators import checks, coverage, entities, evidence, hygiene, ids, notes, overlap, retention, schemas, status, terms, transcripts
from corposcope.plans.presets import ENGLISH
from corposcope.sources import readers, reports

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table; texts, which are long work for each row, are dealt over all cores where their file is small."""
    rows = spark.read.parquet(f"{sf}/{name}.parquet")
    return readers.spread(rows) if name == "documents" else rows


def documents(spark: SparkSession, sf: str, name: str = "documents", key: str = "doc_id") -> DataFrame:
    """A text table as documents: the title is null, as the tables have none."""
    return table(spark, sf, name).select(F.col(key).cast("string").alias("video_id"), F.lit(None).cast("string").alias("title"), "text")


def headed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their first line as title."""
    return table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("video_id"), F.split("text", "\n").getItem(0).alias("title"), "text")


STOP = ", ".join(f"'{w}'" for w in text.STOPWORDS)
FRAGMENTS = r"""
frag AS (
  SELECT id, trim(regexp_replace(regexp_replace(f, '\[?\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?\]?', '', 'g'), '\s+', ' ', 'g')) AS t
  FROM (SELECT id, unnest(regexp_extract_all(text, '[^。！？!?；;\r\n]+')) AS f FROM src)
), toks AS (
  SELECT id, list_filter(regexp_extract_all(lower(t), '[a-z0-9]+(?:\.[0-9]+)?|[\x{4e00}-\x{9fff}]+'), lambda x: regexp_full_match(x, '[a-z][a-z0-9_+.-]*|[\x{4e00}-\x{9fff}]+')) AS w
  FROM frag WHERE t <> ''
)"""
IS_TERM = rf"(x NOT IN ({STOP}) AND CASE WHEN regexp_matches(x, '^[a-z]') THEN length(x) BETWEEN 2 AND 64 ELSE length(x) BETWEEN 2 AND 12 AND length(list_distinct(string_split(x, ''))) > 1 AND length(translate(x, '{text.FUNCTION_CHARS}', '')) > 0 END)"
SOURCE = "src AS (SELECT doc_id::VARCHAR AS id, coalesce(text, '') AS text FROM documents)"
ITEMS = "src AS (SELECT item_id::VARCHAR AS id, coalesce(text, '') AS text FROM benchmark)"
TERM_SQL = f"""
WITH {SOURCE}, {FRAGMENTS}, t AS (SELECT id, unnest(list_filter(w, lambda x: {IS_TERM})) AS term FROM toks),
n AS (SELECT count(DISTINCT id) AS n FROM frag WHERE t <> '')
SELECT term, count(DISTINCT id) AS document_frequency, count(*) AS total_frequency, 0::BIGINT AS title_document_frequency,
       round(count(DISTINCT id) / greatest(any_value(n.n), 1), 4) AS coverage_ratio
FROM t CROSS JOIN n GROUP BY term"""


@query(TERM_SQL)
def term_evidence(spark, sf):
    return terms.term_evidence(documents(spark, sf)).withColumn("title_document_frequency", F.col("title_document_frequency").cast("long"))


@query(TERM_SQL + " ORDER BY document_frequency DESC, title_document_frequency DESC, total_frequency DESC, length(term), term LIMIT 100")
def top_terms(spark, sf):
    return terms.top_terms(documents(spark, sf), 100).withColumn("title_document_frequency", F.col("title_document_frequency").cast("long"))


@query(r"""
WITH t AS (SELECT unnest(regexp_extract_all(lower(text), '[\x{4e00}-\x{9fff}]{2,}|[a-z][a-z0-9_-]{2,}')) AS term FROM documents)
SELECT term, count(*) AS n FROM t
WHERE term NOT IN ('这个', '一个', '我们', '你们', '他们', '就是', '然后', '因为', '所以', '但是', 'the', 'and', 'for') GROUP BY term""")
def raw_token_counts(spark, sf):
    return terms.raw_token_counts(documents(spark, sf))


CLEAN = r"trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))"


def _theme_case(column: str, groups) -> str:
    cases = ", ".join("CASE WHEN " + " OR ".join(f"contains(lower({column}), '{k.lower()}')" for k in ks) + f" THEN '{name}' END" for name, ks in groups.items())
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


RECORDS = rf"""
rec AS (
  SELECT doc_id::VARCHAR AS video_id, length(coalesce(text, '')) AS transcript_chars,
         length(regexp_extract_all(coalesce(text, ''), '[。！？!?]')) AS sentence_breaks,
         {_theme_case("string_split(text, chr(10))[1]", ENGLISH.themes)} AS themes,
         left({CLEAN}, 180) AS opener, right({CLEAN}, 180) AS ending
  FROM documents
)"""


@query(f"WITH {RECORDS} SELECT video_id, transcript_chars, sentence_breaks, array_to_string(themes, ',') AS themes, opener, ending FROM rec")
def corpus_index(spark, sf):
    return coverage.corpus_records(headed(spark, sf), ENGLISH.themes).withColumn("themes", F.array_join("themes", ",")).drop("title")


@query(f"""WITH {RECORDS}
SELECT count(*) AS items, count(*) FILTER (transcript_chars > 0) AS with_transcript, sum(transcript_chars)::BIGINT AS total_chars,
       count(*) FILTER (transcript_chars >= 5000) AS long_form, count(*) FILTER (transcript_chars > 0 AND transcript_chars < 800) AS short_form FROM rec""")
def corpus_coverage(spark, sf):
    return coverage.corpus_totals(coverage.corpus_records(headed(spark, sf), ENGLISH.themes))


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 30")
def top_by_length(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(30)


@query("""
SELECT user_id, (count(*) FILTER (event_type = 'view') + 3 * count(*) FILTER (event_type = 'signup')
       + 4 * count(*) FILTER (event_type = 'purchase') + 2 * count(*) FILTER (event_type = 'click'))::BIGINT AS score
FROM events GROUP BY user_id ORDER BY score DESC, user_id LIMIT 30""")
def top_by_score(spark, sf):
    n = lambda kind: F.count_if(F.col("event_type") == kind)
    per = table(spark, sf, "events").groupBy("user_id").agg(coverage.weighted_score(n("view"), n("signup"), n("purchase"), n("click")).cast("long").alias("score"))
    return per.orderBy(F.desc("score"), "user_id").limit(30)


@query("""SELECT user_id, event_id, n FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n <= 3""")
def recent_events(spark, sf):
    return coverage.recent(table(spark, sf, "events"), ["user_id"], [F.desc("ts"), "event_id"], 3).select("user_id", "event_id", F.col("n").cast("long").alias("n"))


@query("""SELECT o_custkey, o_orderkey, n FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders) WHERE n <= 2""")
def recent_orders(spark, sf):
    return coverage.recent(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"], 2).select("o_custkey", "o_orderkey", F.col("n").cast("long").alias("n"))


PHRASES = rf"""
WITH {ITEMS}, {FRAGMENTS},
runs AS (SELECT id, w[i:i + k - 1] AS r, k FROM toks, range(1, length(w) + 1) a(i), range(2, 7) b(k) WHERE i + k - 1 <= length(w)),
ph AS (
  SELECT id, k, CASE WHEN length(list_filter(r, lambda x: regexp_matches(x, '^[a-z]'))) = 0 THEN array_to_string(r, '') ELSE array_to_string(r, ' ') END AS phrase
  FROM runs WHERE length(list_filter(r, lambda x: {IS_TERM})) >= 2
), ok AS (SELECT * FROM ph WHERE length(replace(phrase, ' ', '')) BETWEEN 4 AND 32 AND length(list_distinct(string_split(phrase, ''))) > 2),
g AS (SELECT phrase, count(DISTINCT id) AS df, count(*) AS tf, max(k) AS k, array_to_string(list_sort(list(DISTINCT id)), ',') AS ids FROM ok GROUP BY phrase HAVING count(DISTINCT id) >= 2),
n AS (SELECT count(DISTINCT id) AS n FROM frag WHERE t <> ''),
kept AS (SELECT * FROM g p WHERE NOT EXISTS (SELECT 1 FROM g q WHERE q.ids = p.ids AND q.phrase <> p.phrase AND contains(q.phrase, p.phrase)
  AND (-q.df, -q.k, -q.tf, q.phrase) < (-p.df, -p.k, -p.tf, p.phrase))),
c AS (SELECT *, round(df / greatest((SELECT n FROM n), 1), 4) AS cov FROM kept)
SELECT phrase, df AS document_frequency, tf AS total_frequency, k::BIGINT AS n_tokens, cov AS coverage_ratio,
       CASE WHEN df >= 3 AND cov >= 0.5 THEN 'high' WHEN cov >= 0.25 THEN 'medium' ELSE 'low' END AS confidence_level,
       round(CASE WHEN df >= 3 AND cov >= 0.5 THEN greatest(0.45::DOUBLE * least(df / 5, 1.0::DOUBLE) + 0.55::DOUBLE * cov, 0.75)
                  WHEN cov >= 0.25 THEN least(greatest(0.45::DOUBLE * least(df / 5, 1.0::DOUBLE) + 0.55::DOUBLE * cov, 0.4), 0.74)
                  ELSE least(0.45::DOUBLE * least(df / 5, 1.0::DOUBLE) + 0.55::DOUBLE * cov, 0.39) END, 3)::DOUBLE AS confidence_score
FROM c"""


@query(PHRASES)
def repeated_phrases(spark, sf):
    return terms.repeated_phrases(documents(spark, sf, "benchmark", "item_id"))


@query(PHRASES.replace(ITEMS, SOURCE))
def document_phrases(spark, sf):
    return terms.repeated_phrases(documents(spark, sf))


@query(f"""
WITH {SOURCE}, {FRAGMENTS}, t AS (SELECT id, unnest(list_filter(w, lambda x: {IS_TERM})) AS term FROM toks),
p AS (SELECT term, array_to_string(list_sort(list(DISTINCT id)), ',') AS ids, count(DISTINCT id) AS df, min(id) AS first_id, count(*) AS tf FROM t GROUP BY term HAVING count(DISTINCT id) >= 2)
SELECT first_id, df AS document_frequency, sum(tf)::BIGINT AS total_frequency, count(*) AS n_terms,
       array_to_string(list(term ORDER BY tf DESC, length(term) DESC, term), ',') AS terms FROM p GROUP BY ids, df, first_id""")
def topic_groups(spark, sf):
    return terms.topic_groups(documents(spark, sf)).drop("docs").withColumn("terms", F.array_join("terms", ","))


PICK = "list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform(terms, lambda t: [t])), lambda a, x: CASE WHEN length(a) >= 6 OR length(list_filter(a, lambda y: contains(y, x[1]) OR contains(x[1], y))) > 0 THEN a ELSE list_concat(a, x) END)"
TOPICS = f"""
WITH {SOURCE}, {FRAGMENTS}, t AS (SELECT id, unnest(list_filter(w, lambda x: {IS_TERM})) AS term FROM toks),
p AS (SELECT term, list_sort(list(DISTINCT id)) AS ids, count(*) AS tf FROM t GROUP BY term HAVING count(DISTINCT id) >= 2),
g AS (SELECT ids, length(ids) AS df, sum(tf)::BIGINT AS tf, list(term ORDER BY tf DESC, length(term) DESC, term) AS terms FROM p GROUP BY ids),
k AS (SELECT *, {PICK} AS picked FROM g)"""


@query(TOPICS + f""", c AS (SELECT *, df / greatest((SELECT count(*) FROM src WHERE text <> ''), 1) AS cov FROM k WHERE length(picked) >= 2 ORDER BY df DESC, tf DESC, array_to_string(ids, chr(1)) LIMIT 12),
r AS (SELECT *, round(cov, 4) AS ratio, 0.35::DOUBLE * least(df / 5, 1.0::DOUBLE) + 0.45::DOUBLE * round(cov, 4) + 0.2::DOUBLE * least(length(picked) / 4, 1.0::DOUBLE) AS raw FROM c),
s AS (SELECT *, CASE WHEN df >= 3 AND ratio >= 0.5 THEN 'high' WHEN ratio >= 0.25 THEN 'medium' ELSE 'low' END AS confidence_level,
        round(CASE WHEN df >= 3 AND ratio >= 0.5 THEN greatest(raw, 0.75) WHEN ratio >= 0.25 THEN least(greatest(raw, 0.4), 0.74) ELSE least(raw, 0.39) END, 3)::DOUBLE AS confidence_score FROM r)
SELECT 'topic-' || left(sha256(array_to_string(picked, chr(10)) || chr(10) || '--' || chr(10) || array_to_string(ids, chr(10))), 12) AS candidate_id, array_to_string(picked[1:3], ' / ') AS provisional_label,
       df::BIGINT AS document_frequency, tf AS total_frequency, ratio AS coverage_ratio, confidence_level, confidence_score, array_to_string(picked, ',') AS distinguishing_terms, array_to_string(ids, ',') AS video_ids FROM s""")
def topic_candidates(spark, sf):
    return terms.topic_candidates(documents(spark, sf)).withColumn("video_ids", F.array_join("video_ids", ","))


@query(TOPICS + " SELECT ids[1] AS first_id, df::BIGINT AS document_frequency, array_to_string(picked, ',') AS picked FROM k")
def distinct_terms(spark, sf):
    return terms.topic_groups(documents(spark, sf)).select("first_id", "document_frequency", F.array_join(terms.distinct_terms(F.col("terms")), ",").alias("picked"))


@query(TOPICS + """, c AS (SELECT ids FROM k WHERE length(picked) >= 2 ORDER BY df DESC, tf DESC, array_to_string(ids, chr(1)) LIMIT 12)
SELECT count(DISTINCT id) AS represented FROM (SELECT unnest(ids) AS id FROM c)""")
def represented_documents(spark, sf):
    return terms.topic_candidates(documents(spark, sf)).select(F.explode("video_ids").alias("id")).agg(F.count_distinct("id").alias("represented"))


@query(rf"""
WITH {SOURCE}, cut AS (
  SELECT id, i, trim(regexp_replace(regexp_replace(f, '\[?\d{{1,2}}:\d{{2}}(?::\d{{2}})?(?:[.,]\d{{1,3}})?\]?', '', 'g'), '\s+', ' ', 'g')) AS t
  FROM (SELECT id, unnest(fs) AS f, generate_subscripts(fs, 1) AS i FROM (SELECT id, regexp_extract_all(text, '[^。！？!?；;\r\n]+') AS fs FROM src))
), frag AS (SELECT id, t, row_number() OVER (PARTITION BY id ORDER BY i) AS n FROM cut WHERE t <> ''),
toks AS (
  SELECT id, id || '#transcript:' || CASE WHEN n < 10000 THEN lpad(n::VARCHAR, 4, '0') ELSE n::VARCHAR END AS fragment, regexp_extract_all(lower(t), '[a-z0-9]+(?:\.[0-9]+)?|[\x{{4e00}}-\x{{9fff}}]+') AS w FROM frag
), t AS (SELECT id, fragment, unnest(list_filter(w, lambda x: regexp_full_match(x, '[a-z][a-z0-9_+.-]*|[\x{{4e00}}-\x{{9fff}}]+') AND {IS_TERM})) AS term FROM toks),
g AS (SELECT term, count(DISTINCT id) AS df, count(*) AS tf, array_to_string(list_sort(list(DISTINCT id)), ',') AS ids, array_to_string(list_sort(list(DISTINCT fragment)), ',') AS fragments FROM t GROUP BY term)
SELECT term, df AS document_frequency, tf AS total_frequency, ids AS representative_video_ids, fragments AS source_fragment_ids FROM g ORDER BY df DESC, tf DESC, length(term), term LIMIT 30""")
def term_sources(spark, sf):
    docs = documents(spark, sf)
    top = terms.top_terms(docs, 30).select("term", "document_frequency", "total_frequency")
    lists = terms.term_sources(docs, top)
    return top.join(lists, "term").withColumn("representative_video_ids", F.array_join("representative_video_ids", ",")).withColumn("source_fragment_ids", F.array_join("source_fragment_ids", ","))


@query(PHRASES.replace(ITEMS, SOURCE).replace(" AS cov FROM kept)", " AS cov FROM kept ORDER BY df DESC, k DESC, tf DESC, phrase LIMIT 40)").replace(
    "AS confidence_score\nFROM c", "AS confidence_score, 'phrase-' || left(sha256(phrase || chr(10) || replace(ids, ',', chr(10))), 12) AS phrase_id, ids AS representative_video_ids\nFROM c"))
def top_phrases(spark, sf):
    return terms.top_phrases(documents(spark, sf)).withColumn("representative_video_ids", F.array_join("representative_video_ids", ",")).drop("source_fragment_ids")


BOTH = "lower(concat_ws(' ', coalesce(string_split(text, chr(10))[1], ''), coalesce(text, '')))"


@query(f"""
WITH d AS (SELECT {_theme_case("string_split(text, chr(10))[1]", ENGLISH.themes)} AS th, {_theme_case(BOTH, ENGLISH.arguments)} AS ar,
                  contains({BOTH}, 'token') AS tok FROM documents),
c AS (SELECT th, ar, list_concat(list_concat(CASE WHEN list_contains(th, 'licence') THEN ['legal:licence'] ELSE [] END, CASE WHEN list_contains(th, 'abuse') THEN ['safety:abuse'] ELSE [] END), CASE WHEN tok THEN ['secret:token'] ELSE [] END) AS co FROM d),
x AS (SELECT 'themes' AS kind, unnest(th) AS label FROM c UNION ALL SELECT 'arguments', unnest(ar) FROM c
      UNION ALL SELECT 'contributions', unnest(CASE WHEN length(co) = 0 THEN ['evidence:general_style'] ELSE co END) FROM c)
SELECT kind, label, count(*) AS n FROM x GROUP BY kind, label""")
def signal_counts(spark, sf):
    return coverage.label_counts(coverage.signals(headed(spark, sf), ENGLISH), ["themes", "arguments", "contributions"])


@query(f"SELECT lang, label, count(*) AS n FROM (SELECT lang, unnest({_theme_case('text', ENGLISH.themes)}) AS label FROM documents) GROUP BY lang, label")
def theme_labels(spark, sf):
    return table(spark, sf, "documents").select("lang", F.explode(text.labels(F.coalesce("text", F.lit("")), ENGLISH.themes)).alias("label")).groupBy("lang", "label").agg(F.count("*").alias("n"))


def _records(spark, sf) -> DataFrame:
    docs = headed(spark, sf)
    flags = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("video_id"), text.has_any(F.coalesce("text", F.lit("")), ENGLISH.boundary_words).alias("boundary"))
    return coverage.corpus_records(docs, ENGLISH.themes).withColumn("score", F.col("sentence_breaks")).join(flags, "video_id")


def _decisions(spark, sf) -> DataFrame:
    rows = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("video_id"), F.when(F.col("quality") == 1, "Accepted").otherwise("not used").alias("status"))
    return coverage.decision_state(coverage.evidence_decisions(rows))


EVIDENCE = rf"""
WITH rec AS (
  SELECT doc_id::VARCHAR AS video_id, length(coalesce(text, '')) AS chars, length(regexp_extract_all(coalesce(text, ''), '[。！？!?]')) AS score,
         regexp_matches(lower(coalesce(text, '')), 'idiot|moron|worthless') AS boundary FROM documents
), st AS (SELECT doc_id::VARCHAR AS video_id, bool_or(quality = 1) AND NOT bool_or(quality <> 1) AS ok, bool_or(quality <> 1) AS no FROM labels GROUP BY doc_id),
m AS (
  (SELECT 'interaction' AS bucket, video_id FROM rec ORDER BY score DESC, chars DESC, video_id LIMIT 10) UNION ALL
  (SELECT 'length', video_id FROM rec ORDER BY chars DESC, score DESC, video_id LIMIT 10) UNION ALL
  (SELECT 'short_form', video_id FROM rec WHERE chars > 0 AND chars < 800 ORDER BY video_id LIMIT 10) UNION ALL
  (SELECT 'boundary', video_id FROM rec WHERE boundary ORDER BY video_id LIMIT 10)
), b AS (
  SELECT n.bucket, count(m.video_id) AS total, count(*) FILTER (m.video_id IS NOT NULL AND coalesce(ok, false)) AS covered,
         count(*) FILTER (m.video_id IS NOT NULL AND NOT coalesce(ok, false) AND coalesce(no, false)) AS rejected,
         count(*) FILTER (m.video_id IS NOT NULL AND NOT coalesce(ok, false) AND NOT coalesce(no, false)) AS missing
  FROM (VALUES ('interaction'), ('length'), ('short_form'), ('boundary')) n(bucket) LEFT JOIN m USING (bucket) LEFT JOIN st USING (video_id) GROUP BY n.bucket
), r AS (SELECT *, CASE WHEN total > 0 THEN round(covered / total, 4) END AS ratio FROM b)"""


@query(EVIDENCE + " SELECT * FROM r")
def evidence_coverage(spark, sf):
    return coverage.coverage_buckets(coverage.bucket_members(_records(spark, sf)), _decisions(spark, sf))


@query(EVIDENCE + " SELECT coalesce(round(avg(ratio), 4), 0.0)::DOUBLE AS score, count(ratio) AS applicable FROM r")
def coverage_score(spark, sf):
    return coverage.coverage_score(evidence_coverage(spark, sf))


@query(EVIDENCE + """, g AS (SELECT m.* FROM m LEFT JOIN st USING (video_id) WHERE NOT coalesce(ok, false))
SELECT video_id, min(CASE WHEN bucket IN ('interaction', 'length') THEN 1 ELSE 2 END) AS priority, array_to_string(list_sort(list(DISTINCT bucket)), ',') AS reasons,
       any_value(rec.score)::BIGINT AS score, any_value(rec.chars)::BIGINT AS transcript_chars
FROM g JOIN rec USING (video_id) GROUP BY video_id ORDER BY priority, score DESC, transcript_chars DESC, video_id LIMIT 20""")
def coverage_gaps(spark, sf):
    records = _records(spark, sf)
    return coverage.coverage_gaps(coverage.bucket_members(records), records, _decisions(spark, sf))


@query(r"""
WITH d AS (
  SELECT length(text) AS c, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents WHERE length(text) > 0 AND length(text) < 800
), s AS (SELECT c, list_filter(list_transform(regexp_extract_all(t, '[^。！？!?]*[。！？!?]|[^。！？!?]+$'), lambda x: trim(x)), lambda x: x <> '') AS p FROM d),
l AS (SELECT CASE WHEN c < 300 THEN 'weak' ELSE 'normal' END AS strength, lower(array_to_string(p[1:3], ' ')) AS a, lower(array_to_string(p[greatest(length(p) - 2, 1):], ' ')) AS z FROM s),
x AS (
  SELECT strength, unnest(list_filter([CASE WHEN contains(a, 'the ') OR contains(a, 'le ') OR contains(a, 'der ') OR contains(a, 'el ') THEN 'hook:article' END, CASE WHEN contains(a, 'license') THEN 'hook:licence' END,
    CASE WHEN contains(z, 'license') OR contains(z, 'reserved') THEN 'ending:licence' END, CASE WHEN contains(z, 'idiot') OR contains(z, 'moron') THEN 'ending:abuse' END], lambda y: y IS NOT NULL)) AS pattern FROM l
) SELECT pattern, strength, count(*) AS n FROM x GROUP BY pattern, strength""")
def short_form(spark, sf):
    return coverage.short_forms(headed(spark, sf), ENGLISH)


PERIODS = """
WITH o AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders),
p AS (SELECT *, CASE WHEN i < round_even(n / 3, 0) THEN 1 WHEN i < round_even(n * 2 / 3, 0) THEN 2 ELSE 3 END AS period FROM o)"""


@query(PERIODS + " SELECT period, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS finished, round(sum(o_totalprice), 2) AS total FROM p GROUP BY period")
def timeline_shift(spark, sf):
    parts = coverage.periods(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"])
    return parts.groupBy("period").agg(F.count("*").alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(PERIODS + """, a AS (SELECT DISTINCT o_custkey FROM p WHERE period = 1), b AS (SELECT DISTINCT o_custkey FROM p WHERE period = 3)
SELECT round(1 - (SELECT count(*) FROM a JOIN b USING (o_custkey)) / (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)), 4) AS drift""")
def timeline_drift(spark, sf):
    parts = coverage.periods(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"]).select("period", F.col("o_custkey").alias("label"))
    return coverage.drift(parts.where("period = 1"), parts.where("period = 3"))


@query("""
WITH st AS (SELECT doc_id, bool_or(quality = 1) AS a, bool_or(quality <> 1) AS r, count(*) > 1 AS rep FROM labels GROUP BY doc_id),
refs AS (SELECT '/events/' || event_id AS pointer, user_id AS doc_id, CASE WHEN event_type = 'purchase' THEN 'transcript' ELSE 'metadata' END AS t FROM events),
k AS (SELECT refs.*, length(d.text) AS c, st.* EXCLUDE (doc_id) FROM refs LEFT JOIN documents d USING (doc_id) LEFT JOIN st USING (doc_id)),
v AS (
  SELECT doc_id, 'orphan' AS category FROM k WHERE c IS NULL UNION ALL
  SELECT doc_id, CASE WHEN coalesce(rep, false) THEN 'ambiguous' WHEN coalesce(r, false) THEN 'rejected' ELSE 'missing' END FROM k WHERE c IS NOT NULL AND NOT coalesce(a AND NOT rep, false) UNION ALL
  SELECT doc_id, 'type' FROM k WHERE c <= 0 AND t = 'transcript'
) SELECT category, count(*) AS n, count(DISTINCT doc_id) AS ids FROM v GROUP BY category""")
def evidence_integrity(spark, sf):
    refs = table(spark, sf, "events").select(F.concat(F.lit("/events/"), F.col("event_id").cast("string")).alias("pointer"), F.col("user_id").cast("string").alias("video_id"), F.when(F.col("event_type") == "purchase", "transcript").otherwise("metadata").alias("required_type"))
    corpus = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("video_id"), F.length("text").alias("transcript_chars"))
    return evidence.violation_counts(evidence.integrity_violations(refs, corpus, _decisions(spark, sf)))


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey")
def orphan_references(spark, sf):
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return evidence.orphans(table(spark, sf, "lineitem").select("l_orderkey"), done, "l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey, l_linenumber, first_value(l_linenumber) OVER w AS first_line, row_number() OVER w > 1 AS is_duplicate
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber)""")
def first_duplicates(spark, sf):
    refs = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("video_id"), F.col("l_linenumber").alias("pointer"))
    return evidence.first_pointers(refs, ["l_orderkey"], ["l_linenumber"]).select("l_orderkey", "l_linenumber", F.col("first_pointer").alias("first_line"), "is_duplicate")


STAGES = ("signup", "view", "click", "purchase")


@query("""
WITH n AS (SELECT count(DISTINCT user_id) AS e FROM events), s AS (SELECT unnest(['signup', 'view', 'click', 'purchase']) AS stage),
c AS (SELECT s.stage, (SELECT count(DISTINCT user_id) FROM events WHERE event_type = s.stage) AS covered FROM s)
SELECT stage, e AS expected, covered, CASE WHEN e = 0 THEN 0.0 ELSE round(covered / e, 6) END AS ratio,
       covered >= least(e, greatest(2, ceil(e * 0.8::DOUBLE))) AS draft, covered >= least(e, greatest(5, ceil(e * 0.95::DOUBLE))) AS ready FROM c, n""")
def stage_coverage(spark, sf):
    ev = table(spark, sf, "events").select("user_id", F.col("event_type").alias("stage"))
    return status.stage_coverage(ev, ev, STAGES, "user_id")


@query("""
WITH sel AS (SELECT o_orderkey::VARCHAR AS v, 'a' || o_orderkey AS a, CASE WHEN o_orderpriority = '1-URGENT' THEN ' ' ELSE 'u' END AS url FROM orders),
e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
dl AS (SELECT user_id::VARCHAR AS id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'Skipped' ELSE 'downloaded' END AS s FROM e WHERE n = 1),
au AS (SELECT 'a' || user_id AS id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'extracted' END AS s FROM e WHERE n = 2),
tr AS (SELECT user_id::VARCHAR AS id, CASE event_type WHEN 'error' THEN 'broken' WHEN 'view' THEN 'skipped' ELSE 'completed' END AS s FROM e WHERE n = 3),
j AS (SELECT v, url, lower(dl.s) AS d, lower(au.s) AS x, lower(tr.s) AS t, o_k % 3 <> 0 AS df, o_k % 4 <> 0 AS af, o_k % 5 <> 0 AS tf
  FROM (SELECT *, v::BIGINT AS o_k FROM sel) s LEFT JOIN dl ON dl.id = s.v LEFT JOIN au ON au.id = s.a LEFT JOIN tr ON tr.id = s.v),
k AS (SELECT *, CASE WHEN trim(url) = '' THEN 'DOWNLOAD_URL_MISSING' WHEN d = 'failed' THEN 'DOWNLOAD_FAILED' WHEN df THEN NULL WHEN d IS NULL THEN 'DOWNLOAD_NOT_RECORDED' WHEN d = 'downloaded' THEN 'DOWNLOAD_ARTIFACT_MISSING' ELSE 'DOWNLOAD_SKIPPED' END AS dc FROM j),
l AS (SELECT *, CASE WHEN x = 'failed' THEN 'AUDIO_FAILED' WHEN af THEN NULL WHEN dc IS NOT NULL AND x IS NULL THEN 'AUDIO_BLOCKED' WHEN x IS NULL THEN 'AUDIO_NOT_PRODUCED' WHEN x = 'extracted' THEN 'AUDIO_ARTIFACT_MISSING' ELSE 'AUDIO_SKIPPED' END AS ac FROM k),
m AS (SELECT *, CASE WHEN tf THEN NULL WHEN t = 'skipped' THEN 'ASR_SKIPPED' WHEN t = 'broken' THEN 'ASR_FAILED' WHEN ac IS NOT NULL THEN 'TRANSCRIPTION_BLOCKED' ELSE 'TRANSCRIPT_MISSING' END AS tc FROM l),
c AS (SELECT 'selected' AS stage, NULL::VARCHAR AS code FROM m UNION ALL SELECT 'downloaded', dc FROM m UNION ALL SELECT 'audio', ac FROM m UNION ALL SELECT 'transcribed', tc FROM m)
SELECT stage, CASE WHEN code IS NULL THEN 'covered' WHEN code LIKE '%BLOCKED' THEN 'blocked' ELSE 'failed' END AS status, code, count(*) AS n FROM c GROUP BY ALL""")
def stage_states(spark, sf):
    key = F.col("o_orderkey")
    selected = table(spark, sf, "orders").select(key.cast("string").alias("video_id"), F.concat(F.lit("a"), key.cast("string")).alias("artifact_id"), F.when(F.col("o_orderpriority") == "1-URGENT", " ").otherwise("u").alias("download_url"))
    turns = coverage.recent(table(spark, sf, "events"), ["user_id"], ["event_id"], 3)
    log = lambda n, prefix, done, bad: turns.where(F.col("n") == n).select(F.concat(F.lit(prefix), F.col("user_id").cast("string")).alias("id"), F.when(F.col("event_type") == "error", bad).when(F.col("event_type") == "view", "Skipped").otherwise(done).alias("status"))
    held = lambda m: table(spark, sf, "orders").where(key % m != 0).select(F.concat(F.lit("a"), key.cast("string")).alias("artifact_id"))
    logs = {"downloaded": log(1, "", "downloaded", "failed"), "audio": log(2, "a", "extracted", "failed"), "transcribed": log(3, "", "completed", "broken")}
    states = status.stage_states(selected, logs, {"downloaded": held(3), "audio": held(4), "transcribed": held(5)})
    return states.groupBy("stage", "status", "code").agg(F.count("*").alias("n"))


STEPS = """
WITH e AS (SELECT user_id AS step_id, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'completed' END AS s, value > 50 AS v FROM events),
g AS (SELECT step_id, count(*) AS total, count(*) FILTER (s = 'completed' OR (s = 'skipped' AND coalesce(v, false))) AS succeeded,
  count(*) FILTER (s = 'failed') AS failed, count(*) FILTER (s = 'skipped' AND NOT coalesce(v, false)) AS skipped FROM e GROUP BY step_id),
st AS (SELECT *, CASE WHEN failed = total THEN 'failed' WHEN failed > 0 THEN 'partial' WHEN succeeded > 0 THEN CASE WHEN succeeded + skipped = total THEN 'succeeded' ELSE 'partial' END ELSE 'skipped' END AS status FROM g)"""


@query(STEPS + " SELECT * FROM st")
def step_rollup(spark, sf):
    kind = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("completed")
    return status.step_rollup(table(spark, sf, "events").select(F.col("user_id").alias("step_id"), kind.alias("status"), (F.col("value") > 50).alias("verified")))


@query(STEPS + " SELECT count(*) AS steps, CASE WHEN bool_or(status = 'failed') THEN 'failed' WHEN bool_or(status = 'partial') THEN 'partial' ELSE 'succeeded' END AS status, CASE WHEN bool_or(status = 'failed') THEN 1 WHEN bool_or(status = 'partial') THEN 2 ELSE 0 END AS exit_code FROM st")
def pipeline_status(spark, sf):
    return status.pipeline_status(step_rollup(spark, sf))


@query("""WITH d AS (SELECT user_id, sum(value) AS v FROM events GROUP BY user_id)
SELECT count(*) AS steps, round(sum(v), 2) AS total, round(max(v), 2) AS longest, arg_max(user_id, v) AS slowest FROM d""")
def execution_summary(spark, sf):
    return status.execution_summary(table(spark, sf, "events").groupBy("user_id").agg(F.sum("value").alias("v")), "user_id", "v")


@query("""WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations)
SELECT conv_id, count(*) AS rows, count(*) FILTER (turn <> i) AS faults FROM c GROUP BY conv_id""")
def sequence_check(spark, sf):
    return status.sequence_faults(table(spark, sf, "conversations").select("conv_id", "turn"), "conv_id", "turn", 0)


@query("""SELECT conv_id, turn, (sum(length(text)) OVER w - length(text))::BIGINT AS start_at, (sum(length(text)) OVER w)::BIGINT AS end_at
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)""")
def chunk_offsets(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("chars"))
    return status.running(rows, "conv_id", ["turn"], "chars").drop("chars")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS asked FROM conversations""")
def section_carry(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.col("turn")).alias("asked"))
    return status.carried(rows, "conv_id", ["turn"], "asked").drop("asked").withColumnRenamed("asked_carried", "asked")


@query("""WITH c AS (SELECT conv_id, turn, role, row_number() OVER w AS n, lag(role) OVER w AS b FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, role FROM c WHERE n = 1 OR role IS DISTINCT FROM b""")
def consecutive_dedupe(spark, sf):
    return status.without_repeats(table(spark, sf, "conversations").select("conv_id", "turn", "role"), "conv_id", ["turn"], "role")


@query("SELECT min(page_id) AS page_id, split_part(url, '?', 1) AS address, count(*) AS n FROM pages GROUP BY split_part(url, '?', 1)")
def page_dedupe(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", F.split_part("url", F.lit("?"), F.lit(1)).alias("address"))
    counts = rows.groupBy("address").agg(F.count("*").alias("n"))
    return status.keep_first(rows, ["address"], ["page_id"]).join(counts, "address")


ENCODING = r"""
WITH d AS (SELECT {key} AS id, coalesce({col}, '') AS t FROM {table}),
m AS (SELECT id, length(regexp_extract_all(t, '[?？]')) AS q, length(regexp_replace(t, '\s', '', 'g')) AS v, length(regexp_extract_all(t, '�')) AS b,
      coalesce(list_max(list_transform(regexp_extract_all(t, '[?？]+'), lambda x: length(x))), 0) AS r FROM d)
SELECT id, b AS replacement_chars, q AS question_marks, r AS longest_run, CASE WHEN v = 0 THEN 0.0 ELSE round(q / v, 4) END AS density,
       NOT (b > 0 OR (q >= 4 AND r >= 4) OR (q >= 12 AND q / greatest(v, 1) >= 0.15)) AS passed FROM m"""


@query(ENCODING.format(key="doc_id", col="text", table="documents"))
def encoding_report(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), *[c.alias(k) for k, c in hygiene.encoding_columns(F.col("text")).items()])


@query(ENCODING.format(key="page_id", col="html", table="pages"))
def encoding_pages(spark, sf):
    return table(spark, sf, "pages").select(F.col("page_id").alias("id"), *[c.alias(k) for k, c in hygiene.encoding_columns(F.col("html")).items()])


@query(r"""SELECT doc_id, length(regexp_extract_all(text, '(?m)^[ \t]*[-*][ \t]+\S')) AS bullets, length(regexp_extract_all(text, '(?m)^#{2,4}[ \t]+\S')) AS headings,
       length(regexp_extract_all(text, '(?m)^\|[^|\n]+\|')) AS table_rows FROM documents""")
def markdown_counts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", *[c.alias(k) for k, c in hygiene.markdown_columns(F.col("text")).items()])


WORDS = ("the", "license", "idiot", "moron")


@query("SELECT doc_id, (" + " + ".join(f"(length(text) - length(replace(text, '{w}', ''))) // {len(w)}" for w in WORDS) + ")::BIGINT AS total, (" + " + ".join(f"contains(text, '{w}')::INT" for w in WORDS) + ")::BIGINT AS \"unique\" FROM documents")
def generic_phrases(spark, sf):
    return table(spark, sf, "documents").select("doc_id", *[c.alias(k) for k, c in hygiene.generic_phrase_columns(F.col("text"), WORDS).items() if k != "passed"])


def _url_sql(x: str) -> str:
    """A URL without user, fragment and sensitive parameters."""
    form = lambda v: f"replace(url_encode(url_decode(replace({v}, '+', ' '))), '%20', '+')"
    secret = "'apikey|appkey|privatekey|accesskey|accesstoken|refreshtoken|authorization|credential|password|signature|secret|cookie|session|token$|^(auth|code|jwt|key|policy|sig|signed)$'"
    params = rf"list_filter(string_split(regexp_extract({x}, '\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(regexp_replace(lower(split_part(p, '=', 1)), '[^a-z0-9]', '', 'g'), {secret}))"
    query = rf"array_to_string(list_transform({params}, lambda p: {form("split_part(p, '=', 1)")} || '=' || {form("regexp_extract(p, '^[^=]*=(.*)$', 1)")}), '&')"
    return rf"(lower(regexp_extract({x}, '^([A-Za-z]+)://', 1)) || '://' || lower(regexp_extract({x}, '^[A-Za-z]+://(?:[^/?#]*@)?([^/?#]*)', 1)) || regexp_extract({x}, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END)"


@query(f"SELECT page_id, {_url_sql('trim(url)')} AS url FROM pages")
def redact_urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", hygiene.redacted_url(F.col("url")).alias("url"))


_WORD = "[A-Za-z0-9_-]*(?:api[_-]?key|app[_-]?key|access[_-]?key|private[_-]?key|access[_-]?token|refresh[_-]?token|token|password|secret|signature|credential|cookie|session)[A-Za-z0-9_-]*"


@query(rf"""
WITH a AS (SELECT doc_id, text, string_split_regex(text, '(?i)https?://[^\s<>"'';,)\]}}]+') AS s, regexp_extract_all(text, '(?i)https?://[^\s<>"'';,)\]}}]+') AS u FROM documents),
b AS (SELECT doc_id, text, array_to_string(list_transform(range(1, length(s) + 1), lambda i: s[i] || CASE WHEN i <= length(u) THEN {_url_sql("u[i]")} ELSE '' END), '') AS t FROM a),
c AS (SELECT doc_id, text, regexp_replace(t, '\bAuthorization\b(?:["'']?\s*[:=]\s*["'']?|\s+)(?:Bearer\s+)?(?:<redacted>|[^\s,;}}\]>''"]+)', 'Authorization: <redacted>', 'gi') AS t FROM b),
d AS (SELECT doc_id, text, regexp_replace(t, '\bBearer\s+(?:<redacted>|[^\s,;}}\]>''"]+)', 'Bearer <redacted>', 'gi') AS t FROM c),
e AS (SELECT doc_id, text, regexp_replace(regexp_replace(t, '(["'']?{_WORD}["'']?\s*[:=]\s*)"[^"\n]*"', '\1"<redacted>"', 'gi'), '(["'']?{_WORD}["'']?\s*[:=]\s*)''[^''\n]*''', '\1''<redacted>''', 'gi') AS t FROM d),
f AS (SELECT doc_id, text, regexp_replace(t, '(\b{_WORD}\b\s*[:=]\s*)([^&\s,;}}\]]+)', '\1<redacted>', 'gi') AS t FROM e),
g AS (SELECT doc_id, text, regexp_replace(t, '(^|[^A-Za-z0-9])[A-Za-z]:[\\/][^;\r\n,"''<>]+', '\1<redacted-path>', 'g') AS t FROM f),
h AS (SELECT doc_id, text, regexp_replace(t, '(^|[^A-Za-z0-9])/(?:home|Users|root|private|var|tmp|mnt)/[^;\s,"''<>]+', '\1<redacted-path>', 'gi') AS t FROM g)
SELECT doc_id, sha256(t) AS scrubbed_sha256, t <> text AS changed FROM h""")
def scrub_text(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text", hygiene.scrubbed(F.col("text")).alias("t"))
    return rows.select("doc_id", F.sha2("t", 256).alias("scrubbed_sha256"), (F.col("t") != F.col("text")).alias("changed"))


@query(r"SELECT page_id, regexp_matches(lower(ltrim(left(html, 4096))), '^(<!doctype|<html|<\?xml|<head|<body|[{\[])') AS not_media FROM pages")
def media_sniff(spark, sf):
    return table(spark, sf, "pages").select("page_id", hygiene.is_not_media(F.col("html")).alias("not_media"))


FORMS = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9.+/-]{2,}')) AS form FROM documents),
n AS (SELECT *, regexp_replace(lower(form), '[._/-]+', '', 'g') AS k FROM t WHERE lower(form) NOT IN ('and', 'for', 'from', 'that', 'the', 'this', 'with')),
f AS (SELECT k, form, count(*) AS c FROM n WHERE k <> '' GROUP BY k, form),
s AS (SELECT k, form FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY c DESC, lower(form), form) AS r FROM f) WHERE r = 1),
g AS (SELECT k, count(DISTINCT doc_id) AS df, count(*) AS occ FROM n WHERE k <> '' GROUP BY k)
SELECT k AS entity_key, form, df AS document_frequency, occ AS occurrences, (CASE WHEN df >= 3 THEN 0.85 WHEN df >= 2 OR occ >= 3 THEN 0.60 ELSE 0.30 END)::DOUBLE AS confidence,
       CASE WHEN df >= 2 OR occ >= 3 THEN 'medium' ELSE 'low' END AS impact, 'entity-' || left(sha256(k), 12) AS candidate_id
FROM g JOIN s USING (k)"""


@query(FORMS + " ORDER BY df DESC, occ DESC, k LIMIT 60")
def ascii_entities(spark, sf):
    return entities.ascii_candidates(table(spark, sf, "documents"))


@query(f"WITH c AS ({FORMS}) SELECT problem, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN document_frequency % 3 = 0 THEN 'candidate_id' END, CASE WHEN occurrences % 4 = 0 THEN 'confidence' END], lambda x: x IS NOT NULL)) AS problem FROM c) GROUP BY problem")
def candidate_contract(spark, sf):
    """Detected candidates, of which a third have another id and a quarter another confidence."""
    rows = entities.ascii_candidates(table(spark, sf, "documents"), limit=None)
    rows = rows.withColumn("candidate_id", F.when(F.col("document_frequency") % 3 == 0, "entity-0").otherwise(F.col("candidate_id"))).withColumn("confidence", F.when(F.col("occurrences") % 4 == 0, 0.5).otherwise(F.col("confidence")))
    return entities.candidate_problems(rows).groupBy("problem").agg(F.count("*").alias("n"))


#: Entities that stand in the documents.
ENTITIES = {"Apache License": ("apache-license 2.0",), "MIT License": (), "GNU General Public License": ("GPL",), "CC BY-NC": ("CC BY",)}


@query()
def entity_spans(spark, sf):
    return entities.entity_spans(table(spark, sf, "documents"), ENTITIES, "doc_id")


def _entity_sql() -> str:
    """Counts by document: white space and marks doubled, so that each match takes a guard of its own at both ends; longer forms first."""
    one = []
    for name, aliases in ENTITIES.items():
        forms = sorted(("".join(c for c in f if c.isalnum()) for f in (name, *aliases)), key=len, reverse=True)
        pattern = "|".join(r"[\s._\-/\\·・]*".join(f.replace(".", "") for f in form) for form in forms)
        one.append(f"SELECT '{name}' AS canonical, doc_id, length(regexp_extract_all(t, '(?i)(?:^|[^A-Za-z0-9])(?:{pattern})(?:[^A-Za-z0-9]|$)')) AS n FROM d")
    return " UNION ALL ".join(one)


@query(rf"""
WITH d AS (SELECT doc_id, regexp_replace(text, '([^A-Za-z0-9])', '\1\1', 'g') AS t FROM documents), m AS ({_entity_sql()}),
k AS (SELECT *, regexp_replace(lower(canonical), '[\s._\-/]+', '', 'g') AS entity_key FROM m WHERE n > 0)
SELECT canonical, entity_key, 'entity-' || left(sha256(entity_key), 12) AS candidate_id, count(*) AS document_frequency, sum(n)::BIGINT AS occurrences, 0.95::DOUBLE AS confidence FROM k GROUP BY canonical, entity_key""")
def entity_candidates(spark, sf):
    return entities.registered_candidates(entity_spans(spark, sf), "doc_id").drop("observed_forms")


@query(r"""
WITH f AS (SELECT DISTINCT regexp_replace(lower(p_brand), '[\s._\-/]+', '', 'g') AS o, regexp_replace(lower(p_type), '[\s._\-/]+', '', 'g') AS a FROM part),
k AS (SELECT a AS alias_key, o FROM f UNION SELECT o, o FROM f)
SELECT alias_key, count(*) AS owners FROM k GROUP BY alias_key HAVING count(*) > 1""")
def alias_collisions(spark, sf):
    return entities.alias_collisions(table(spark, sf, "part").select(F.col("p_brand").alias("canonical"), F.col("p_type").alias("form")))


def _review(spark, sf) -> DataFrame:
    """Documents as candidates, labels and events as decisions on them."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("candidate_id"), F.when(F.col("lang") == "en", "high").otherwise("medium").alias("impact"))
    e = table(spark, sf, "events").where("user_id <= 400")
    kind = F.when(F.col("event_type") == "view", "confirmed").when(F.col("event_type") == "click", "corrected").when(F.col("event_type") == "signup", "ignored").when(F.col("event_type") == "purchase", "unresolved").otherwise("closed")
    note = F.when(F.col("value") > 20, "seen")
    made = e.select(F.col("user_id").alias("candidate_id"), F.col("event_id").alias("ordinal"), kind.alias("status"), note.alias("treatment_note"), F.when(F.col("value") > 60, "name").alias("corrected_term"), F.when(F.col("value") > 40, F.array(F.lit("skill/a.md#x"))).alias("final_references"), F.lit("me").alias("reviewed_by"), F.when(F.col("event_id") % 7 != 0, "now").otherwise(" ").alias("reviewed_at"))
    return entities.reviewed(docs, made.withColumn("reviewed_by", F.when(F.col("status") != "unresolved", F.col("reviewed_by"))).withColumn("reviewed_at", F.when(F.col("status") != "unresolved", F.col("reviewed_at"))))


REVIEW = """
WITH d AS (SELECT doc_id, CASE WHEN lang = 'en' THEN 'high' ELSE 'medium' END AS impact FROM documents),
e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS turn, value > 20 AS note, value > 60 AS term, value > 40 AS refs, event_id % 7 <> 0 AS dated,
        CASE event_type WHEN 'view' THEN 'confirmed' WHEN 'click' THEN 'corrected' WHEN 'signup' THEN 'ignored' WHEN 'purchase' THEN 'unresolved' ELSE 'closed' END AS kind FROM events WHERE user_id <= 400),
j AS (SELECT coalesce(doc_id, user_id) AS id, impact, doc_id IS NULL OR coalesce(turn, 1) > 1 AS stray, kind, coalesce(note, false) AS note, coalesce(term, false) AS term, coalesce(refs, false) AS refs, dated, turn FROM d FULL JOIN e ON doc_id = user_id),
r AS (SELECT id, impact, CASE WHEN NOT stray AND kind <> 'closed' THEN kind END AS status,
  CASE WHEN stray THEN 'candidate_id' WHEN turn IS NULL THEN 'decision' WHEN kind = 'closed' THEN 'status'
       ELSE concat_ws(',', CASE WHEN kind = 'unresolved' AND (note OR term OR refs) THEN 'unresolved_fields' END, CASE WHEN kind <> 'unresolved' AND NOT note THEN 'treatment_note' END,
         CASE WHEN kind <> 'unresolved' AND NOT dated THEN 'reviewed_at' END, CASE WHEN kind IN ('confirmed', 'ignored') AND (term OR refs) THEN 'non_correction_fields' END,
         CASE WHEN kind = 'corrected' AND NOT term THEN 'corrected_term' END, CASE WHEN kind = 'corrected' AND NOT refs THEN 'final_references' END) END AS errors FROM j)"""


@query(REVIEW + " SELECT id AS candidate_id, impact, status, errors FROM r")
def entity_decisions(spark, sf):
    return _review(spark, sf).withColumn("errors", F.array_join("errors", ","))


@query(REVIEW + """, t AS (SELECT count(impact) AS candidates, count(*) FILTER (status = 'confirmed') AS confirmed, count(*) FILTER (status = 'corrected') AS corrected, count(*) FILTER (status = 'ignored') AS ignored,
  count(*) FILTER (status = 'unresolved') AS unresolved, count(*) FILTER (status = 'unresolved' AND impact = 'high') AS unresolved_high, count(*) FILTER (status = 'unresolved' AND coalesce(impact, '') <> 'high') AS warnings, count(*) FILTER (errors <> '') AS wrong FROM r),
u AS (SELECT *, confirmed + corrected + ignored AS processed FROM t)
SELECT *, unresolved_high + (wrong > 0)::BIGINT + (candidates > 0 AND processed = 0 AND unresolved_high = 0)::BIGINT AS blockers, unresolved_high + (wrong > 0)::BIGINT + (candidates > 0 AND processed = 0 AND unresolved_high = 0)::BIGINT = 0 AS complete FROM u""")
def entity_review(spark, sf):
    return entities.review_totals(_review(spark, sf))


@query("""
WITH t AS (SELECT event_id AS ordinal, user_id AS c, event_type AS k, value > 30 AS named, event_id % 90 AS into_, event_id % 5 <> 0 AS why FROM events),
m AS (SELECT t.*, a.doc_id IS NOT NULL AS here, b.doc_id IS NOT NULL AND b.doc_id <> c AS there FROM t LEFT JOIN documents a ON a.doc_id = c LEFT JOIN documents b ON b.doc_id = into_),
p AS (SELECT ordinal, unnest(list_filter([CASE WHEN NOT here THEN 'candidate_id' END, CASE WHEN k = 'error' THEN 'decision' END, CASE WHEN NOT why THEN 'reason' END,
  CASE WHEN k = 'click' AND NOT coalesce(named, false) THEN 'replacement_label' END, CASE WHEN k = 'view' AND NOT there THEN 'merged_into' END], lambda x: x IS NOT NULL)) AS problem FROM m)
SELECT ordinal, problem FROM p""")
def topic_decisions(spark, sf):
    kind = F.when(F.col("event_type") == "signup", "accepted").when(F.col("event_type") == "click", "renamed").when(F.col("event_type") == "view", "merged").when(F.col("event_type") == "purchase", "rejected").otherwise("none")
    made = table(spark, sf, "events").select(F.col("event_id").alias("ordinal"), F.col("user_id").alias("candidate_id"), kind.alias("decision"), F.when(F.col("event_id") % 5 != 0, "why").alias("reason"), F.lit("me").alias("reviewed_by"), F.lit("now").alias("reviewed_at"), F.when(F.col("value") > 30, "new").alias("replacement_label"), (F.col("event_id") % 90).alias("merged_into"))
    return entities.topic_decision_problems(table(spark, sf, "documents").select(F.col("doc_id").alias("candidate_id")), made)


@query("""WITH r AS (SELECT doc_id, sum(n_chars) OVER (ORDER BY doc_id) AS total FROM documents) SELECT doc_id, total::BIGINT AS total FROM r WHERE total > 100000 ORDER BY doc_id LIMIT 1""")
def first_over_limit(spark, sf):
    return checks.first_over(table(spark, sf, "documents"), "doc_id", "n_chars", 100_000)


@query("""WITH l AS (SELECT conv_id, turn, length(text) AS s, lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations)
SELECT conv_id, count(*) FILTER (s < b) AS faults FROM l GROUP BY conv_id""")
def timeline_faults(spark, sf):
    return checks.unordered(table(spark, sf, "conversations").select("conv_id", "turn", F.length("text").alias("start_ms")), "conv_id", ["turn"], "start_ms")


@query("""WITH p AS (SELECT event_type, '/events/' || event_id AS pointer FROM events)
SELECT event_type, array_to_string((list(pointer ORDER BY pointer))[1:50], ',') AS pointers, count(*) AS n, count(*) > 50 AS truncated FROM p GROUP BY event_type""")
def truncated_pointers(spark, sf):
    rows = table(spark, sf, "events").select("event_type", F.concat(F.lit("/events/"), F.col("event_id").cast("string")).alias("pointer"))
    return checks.truncated(rows, "event_type", "pointer").withColumn("pointers", F.array_join("pointers", ","))


@query("""SELECT o_orderkey, CASE WHEN left(o_orderpriority, 1)::INT BETWEEN 2 AND 4 THEN left(o_orderpriority, 1)::BIGINT END AS priority, CASE WHEN o_custkey BETWEEN 10 AND 90.5 THEN o_custkey::DOUBLE END AS share FROM orders""")
def bounded_numbers(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", checks.bounded_int(F.concat(F.lit(" +"), F.left("o_orderpriority", F.lit(1))), 2, 4).alias("priority"), checks.bounded_float(F.col("o_custkey").cast("string"), 10, 90.5).alias("share"))


@query("""SELECT CASE WHEN l IN ('cn', 'zh-cn', 'zh_cn') THEN 'zh' ELSE l END AS lang, count(*) AS n FROM (SELECT CASE WHEN doc_id % 3 = 0 THEN 'zh-cn' WHEN doc_id % 3 = 1 THEN 'cn' ELSE lang END AS l FROM documents) GROUP BY 1""")
def languages(spark, sf):
    name = F.when(F.col("doc_id") % 3 == 0, " ZH-CN ").when(F.col("doc_id") % 3 == 1, "cn").otherwise(F.upper("lang"))
    return table(spark, sf, "documents").select(checks.language(name).alias("lang")).groupBy("lang").agg(F.count("*").alias("n"))


@query("""SELECT o_custkey, CASE WHEN bool_and(o_orderstatus IN ('F', 'O') AND o_orderpriority <> '1-URGENT') THEN 'complete' WHEN bool_or(o_orderstatus = 'P') THEN 'action_required' ELSE 'active' END AS state FROM orders GROUP BY o_custkey""")
def manifest_states(spark, sf):
    kind = F.when(F.col("o_orderstatus") == "P", "cleanup_failed").when(F.col("o_orderpriority") == "1-URGENT", "uploaded").when(F.col("o_orderstatus") == "F", "deleted").otherwise("retained")
    return checks.manifest_status(table(spark, sf, "orders").select("o_custkey", kind.alias("status")), "o_custkey")


@query("""SELECT w AS name, coalesce(c.n, 0) AS n FROM (SELECT unnest(['EUROPE', 'ASIA', 'ATLANTIS', 'AFRICA']) AS w) LEFT JOIN (SELECT upper(r_name) AS r, count(*) AS n FROM region GROUP BY 1) c ON c.r = w WHERE coalesce(c.n, 0) <> 1""")
def case_problems(spark, sf):
    return checks.case_problems(table(spark, sf, "region").select(F.upper("r_name").alias("name")), ("EUROPE", "ASIA", "ATLANTIS", "AFRICA"))


@query("""SELECT count(DISTINCT user_id) AS selected, count(DISTINCT user_id) FILTER (user_id IN (SELECT doc_id FROM documents WHERE trim(text) <> '')) AS covered FROM events""")
def text_coverage(spark, sf):
    return checks.covered_count(table(spark, sf, "events").select(F.col("user_id").alias("doc_id")), table(spark, sf, "documents"), "doc_id")


CODED = """
WITH e AS (SELECT event_id, CASE event_id % 12 WHEN 0 THEN '[RATE_LIMIT] slow down' WHEN 1 THEN 'ReadTimeout' WHEN 2 THEN 'mediaTooShort' WHEN 3 THEN 'asr parse error' WHEN 4 THEN '' WHEN 5 THEN 'Fingerprint-Mismatch' WHEN 6 THEN 'workflow corrupt' WHEN 7 THEN 'http server error'
  WHEN 8 THEN 'poll deadline exceeded' WHEN 9 THEN '[bad] x' WHEN 10 THEN 'DOWNLOAD_EMPTY' ELSE event_type END AS m FROM events)"""


@query(CODED + """ SELECT CASE m WHEN '[RATE_LIMIT] slow down' THEN 'RATE_LIMIT' WHEN 'ReadTimeout' THEN 'NETWORK_TIMEOUT' WHEN 'poll deadline exceeded' THEN 'NETWORK_TIMEOUT' WHEN 'mediaTooShort' THEN 'INVALID_MEDIA' WHEN 'DOWNLOAD_EMPTY' THEN 'INVALID_MEDIA'
  WHEN 'asr parse error' THEN 'ASR_PARSE_FAILED' WHEN 'Fingerprint-Mismatch' THEN 'STALE_ARTIFACT' WHEN 'workflow corrupt' THEN 'WORKFLOW_STATE_ERROR' WHEN 'http server error' THEN 'PROVIDER_UNAVAILABLE' ELSE 'UNEXPECTED_ERROR' END AS code, count(*) AS n FROM e GROUP BY 1""")
def stable_codes(spark, sf):
    messages = "[RATE_LIMIT] slow down|ReadTimeout|mediaTooShort|asr parse error||Fingerprint-Mismatch|workflow corrupt|http server error|poll deadline exceeded|[bad] x|DOWNLOAD_EMPTY"
    one = F.get(F.split(F.lit(messages), r"\|"), (F.col("event_id") % 12).cast("int"))
    rows = table(spark, sf, "events").select(F.coalesce(one, "event_type").alias("m"))
    return rows.select(checks.stable_code(F.col("m")).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


@query(PHRASES.replace("c AS (SELECT *, round", "x AS (SELECT ids, phrase, row_number() OVER (ORDER BY df DESC, k DESC, tf DESC, phrase) AS place FROM kept ORDER BY place LIMIT 40), c AS (SELECT *, round").split("SELECT phrase, df AS")[0]
  + "SELECT video_id, array_to_string(list(phrase ORDER BY place), '|') AS phrases FROM (SELECT unnest(string_split(ids, ',')) AS video_id, phrase, place FROM x) GROUP BY video_id")
def phrases_by_document(spark, sf):
    rows = terms.top_phrases(documents(spark, sf, "benchmark", "item_id"))
    return checks.by_document(rows, "representative_video_ids", [F.desc("document_frequency"), F.desc("n_tokens"), F.desc("total_frequency"), "phrase"]).withColumn("phrases", F.array_join("phrases", "|"))


@query("SELECT page_id, regexp_extract(url, '^https?://.*') AS url FROM pages")
def nested_urls(spark, sf):
    """The address of each page, found in an object around it."""
    raw = F.to_json(F.struct(F.lit(1).alias("n"), F.struct(F.array(F.lit("x"), F.col("url")).alias("url_list")).alias("video")))
    return table(spark, sf, "pages").select("page_id", checks.json_url(raw).alias("url"))




@query("SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def json_props(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query(r"SELECT doc_id, sha256(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS fingerprint, 'doc-' || left(sha256(coalesce(text, '')), 12) AS short_id FROM documents")
def fingerprint(spark, sf):
    t = F.coalesce("text", F.lit(""))
    return table(spark, sf, "documents").select("doc_id", F.sha2(text.clean(t), 256).alias("fingerprint"), text.short_id("doc", t).alias("short_id"))


@query("""
WITH c AS (
  SELECT 'documents' AS gate, 'unique_ids' AS "check", count(*) = count(DISTINCT doc_id) AS passed FROM documents UNION ALL
  SELECT 'documents', 'no_empty_text', count(*) FILTER (length(text) > 0) = count(*) FROM documents UNION ALL
  SELECT 'labels', 'known_ids', count(*) = 0 FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL
  SELECT 'labels', 'all_good', coalesce(bool_and(quality = 1), false) FROM labels UNION ALL
  SELECT 'lineitem', 'known_orders', count(*) = 0 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
SELECT gate, bool_and(passed) AS passed, coalesce(string_agg("check", ',' ORDER BY "check") FILTER (NOT passed), '') AS failed FROM c GROUP BY gate""")
def readiness_gate(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    one = lambda gate, name, df: df.select(F.lit(gate).alias("gate"), F.lit(name).alias("check"), "passed")
    checks = [
        one("documents", "unique_ids", docs.agg((F.count("*") == F.count_distinct("doc_id")).alias("passed"))),
        one("documents", "no_empty_text", docs.agg((F.count_if(F.length("text") > 0) == F.count("*")).alias("passed"))),
        one("labels", "known_ids", evidence.orphans(labels, docs, "doc_id").agg((F.count("*") == 0).alias("passed"))),
        one("labels", "all_good", labels.agg(F.coalesce(F.bool_and(F.col("quality") == 1), F.lit(False)).alias("passed"))),
        one("lineitem", "known_orders", evidence.orphans(table(spark, sf, "lineitem").select("l_orderkey"), table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey").agg((F.count("*") == 0).alias("passed"))),
    ]
    rows = checks[0]
    for c in checks[1:]:
        rows = rows.unionByName(c)
    return evidence.gate(rows)


@query("""
WITH f AS (SELECT doc_id, quality AS status, row_number() OVER (PARTITION BY doc_id ORDER BY toxic, quality) AS k FROM labels)
SELECT coalesce(d.doc_id, f.doc_id) AS candidate_id, CASE WHEN d.doc_id IS NULL THEN 'orphaned' WHEN k > 1 THEN 'duplicate' WHEN status IS NULL THEN 'pending' ELSE status::VARCHAR END AS state
FROM documents d FULL JOIN f ON d.doc_id = f.doc_id""")
def decision_ledger(spark, sf):
    made = table(spark, sf, "labels").select(F.col("doc_id").alias("candidate_id"), (F.col("toxic") * 2 + F.col("quality")).alias("ordinal"), F.col("quality").cast("string").alias("status"))
    return evidence.synced_ledger(table(spark, sf, "documents").select(F.col("doc_id").alias("candidate_id")), made).drop("ordinal")


OVERLAP = r"""
WITH norm AS (SELECT 't' AS side, item_id AS id, lower(regexp_replace(regexp_replace(text, '[\[(]?(?:(?:\d{1,3}:)?\d{1,2}:\d{2})(?:[.,]\d{1,3})?[\])]?', '', 'g'), '[^\p{L}\p{N}]', '', 'g')) AS t FROM benchmark
  UNION ALL SELECT 's', doc_id, lower(regexp_replace(regexp_replace(text, '[\[(]?(?:(?:\d{1,3}:)?\d{1,2}:\d{2})(?:[.,]\d{1,3})?[\])]?', '', 'g'), '[^\p{L}\p{N}]', '', 'g')) FROM documents),
a AS (SELECT id, p, substr(t, p, 48) AS g FROM norm, range(1, length(t) - 46) r(p) WHERE side = 't'),
b AS (SELECT id AS doc, p AS q, substr(t, p, 48) AS g FROM norm, range(1, length(t) - 46) r(p) WHERE side = 's'),
m AS (SELECT a.id, b.doc, p, p - q AS d FROM a JOIN b USING (g)),
r AS (SELECT id, doc, d, p, p - row_number() OVER (PARTITION BY id, doc, d ORDER BY p) AS isl FROM m),
l AS (SELECT id, max(c) + 47 AS longest FROM (SELECT id, count(*) AS c FROM r GROUP BY id, doc, d, isl) GROUP BY id),
cov AS (SELECT id, count(DISTINCT p + o) AS matched FROM (SELECT DISTINCT id, p FROM m), range(0, 48) x(o) GROUP BY id),
n AS (SELECT id, count(DISTINCT doc) AS n_sources FROM m GROUP BY id)
SELECT norm.id AS item_id, length(t) AS chars, coalesce(matched, 0) AS matched_chars, coalesce(longest, 0) AS longest,
       CASE WHEN length(t) = 0 THEN 0.0 ELSE round(coalesce(matched, 0) / length(t), 4) END AS copied_ratio, coalesce(n_sources, 0) AS n_sources,
       coalesce(longest, 0) <= 239 AND (coalesce(matched, 0) < 120 OR round(coalesce(matched, 0) / length(t), 4) <= 0.20) AS passed
FROM norm LEFT JOIN l USING (id) LEFT JOIN cov USING (id) LEFT JOIN n USING (id) WHERE side = 't'"""


@query(OVERLAP)
def copyright_overlap(spark, sf):
    return overlap.overlap_verdict(overlap.overlap(table(spark, sf, "benchmark"), table(spark, sf, "documents").select("doc_id", "text")))


def _segments(spark, sf) -> DataFrame:
    """Turns as segments of five seconds, three to a chunk."""
    t = F.col("turn")
    return table(spark, sf, "conversations").select("conv_id", F.floor(t / 3).cast("int").alias("chunk_index"), (F.floor(t / 3) * 15000).alias("chunk_start_ms"), (F.floor(t / 3) * 15000 + 15000).alias("chunk_end_ms"), "text", (t % 3 * 5000).alias("start_ms"), (t % 3 * 5000 + 5000).alias("end_ms"), t.cast("int").alias("source_index"))


@query()
def chunk_merge(spark, sf):
    return transcripts.merge_chunks(_segments(spark, sf), "conv_id")


@query(r"""SELECT conv_id, array_to_string(list(printf('[%02d:%02d:%02d] ', turn * 5 // 3600, turn * 5 % 3600 // 60, turn * 5 % 60) || text ORDER BY turn), chr(10)) AS transcript FROM conversations GROUP BY conv_id""")
def transcript_text(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "text", (F.col("turn") * 5000).alias("start_ms"), F.lit(None).cast("long").alias("end_ms"), F.col("turn").cast("int").alias("source_index"))
    return transcripts.rendered(rows, "conv_id")


@query(r"SELECT doc_id, length(regexp_extract_all(text, '\b[0-9]{16,20}\b')) AS n, coalesce(regexp_extract_all(text, '\b[0-9]{16,20}\b')[1], '') AS first_id FROM documents")
def id_harvest(spark, sf):
    found = F.regexp_extract_all("text", F.lit(r"\b[0-9]{16,20}\b"), F.lit(0))
    return table(spark, sf, "documents").select("doc_id", F.size(found).cast("long").alias("n"), F.coalesce(F.get(found, F.lit(0)), F.lit("")).alias("first_id"))


@query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, length(regexp_extract_all(t, 'https?://[^\s)>\]]+')) AS urls, length(list_distinct(regexp_extract_all(t, 'https?://[^\s)>\]]+'))) AS distinct_urls,
       length(regexp_extract_all(t, '\b(?:TODO|FIXME|XXX)\b')) AS markers, length(list_filter(string_split(t, chr(10)), lambda x: starts_with(ltrim(x), '>') AND length(x) > 120)) AS long_quotes,
       strlen(t) AS bytes, strlen(t) >= 1200 AS big_enough FROM d""")
def note_metrics(spark, sf):
    return notes.note_metrics(table(spark, sf, "documents"), "doc_id")


@query(r"""SELECT page_id, html AS h, length(regexp_extract_all(html, 'https?://[^\s)>\]]+')) AS urls FROM pages""".replace("html AS h, ", ""))
def page_urls(spark, sf):
    return notes.note_metrics(table(spark, sf, "pages").select("page_id", F.col("html").alias("text")), "page_id").select("page_id", "urls")


@query("""
WITH b AS (SELECT event_id, event_type, user_id, lower(left(regexp_replace(event_type || ' ' || user_id, '[^A-Za-z0-9._-]+', '-', 'g'), 80)) AS base FROM events),
f AS (SELECT base, count(*) AS n, min(event_id) AS first FROM b GROUP BY base)
SELECT event_id, CASE WHEN n > 1 AND event_id <> first THEN base || '--' || left(sha256(event_type || ' ' || user_id), 10) ELSE base END AS artifact_id, n > 1 AND event_id <> first AS renamed FROM b JOIN f USING (base)""")
def artifact_ids(spark, sf):
    rows = table(spark, sf, "events").select(F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("key"), "event_id")
    return ids.assigned(rows, "key", "event_id").drop("key")


@query("""SELECT split_part(url, '/', 3) AS host, count(DISTINCT url) AS urls, CASE WHEN count(DISTINCT url) > 1 THEN 'conflict' WHEN count(*) > 1 THEN 'duplicate' ELSE 'single' END AS state FROM pages GROUP BY 1""")
def url_conflicts(spark, sf):
    return ids.url_conflicts(table(spark, sf, "pages").select(F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), "url"), "host", "url")


@query("""
WITH a AS (SELECT doc_id, 0 AS l, -n_chars::DOUBLE AS v FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10),
b AS (SELECT doc_id, 1 AS l, -strlen(text)::DOUBLE AS v FROM documents ORDER BY strlen(text) DESC, doc_id LIMIT 10),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b) SELECT doc_id, min(l)::BIGINT AS list FROM u GROUP BY doc_id""")
def representatives(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "n_chars", F.octet_length("text").alias("bytes"))
    return notes.representatives(rows, "doc_id", "n_chars", "bytes", 10).select("doc_id", F.col("place.list").cast("long").alias("list"))


@query("""
SELECT 'corpus' AS gate, c AS "check", p AS passed FROM (SELECT unnest(['enough', 'four_languages', 'no_nulls']) AS c,
  unnest([count(*) >= 100, count(DISTINCT lang) = 4, count(*) FILTER (text IS NULL) = 0]) AS p FROM documents)""")
def rule_checks(spark, sf):
    return notes.rule_checks(table(spark, sf, "documents"), "corpus", {"enough": F.count("*") >= 100, "four_languages": F.count_distinct("lang") == 4, "no_nulls": F.count_if(F.col("text").isNull()) == 0})


@query("""
SELECT n_nationkey AS key, f AS field, m AS matches FROM (
  SELECT n.n_nationkey, unnest(['regionkey', 'name']) AS f, unnest([n.n_regionkey IS NOT DISTINCT FROM r.r_regionkey, n.n_name IS NOT DISTINCT FROM r.r_name]) AS m
  FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_nationkey)""")
def field_matches(spark, sf):
    left = table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_regionkey").alias("regionkey"), F.col("n_name").alias("name"))
    right = table(spark, sf, "region").select(F.col("r_regionkey").alias("key"), F.col("r_regionkey").alias("regionkey"), F.col("r_name").alias("name"))
    return evidence.matching_fields(left, right, "key", ["regionkey", "name"])


@query("""
WITH e AS (SELECT doc_id, sha256(text) AS f FROM documents), r AS (SELECT doc_id, CASE WHEN quality = 1 THEN sha256(text) ELSE 'old' END AS f FROM (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) JOIN documents USING (doc_id))
SELECT CASE WHEN r.f IS NULL THEN 'missing' WHEN r.f <> e.f THEN 'stale' ELSE 'fresh' END AS state, count(*) AS n FROM e LEFT JOIN r USING (doc_id) GROUP BY 1""")
def freshness(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("artifact"), F.sha2("text", 256).alias("fingerprint"))
    marks = table(spark, sf, "labels").groupBy(F.col("doc_id").alias("artifact")).agg(F.max("quality").alias("quality"))
    held = docs.join(marks, "artifact").select("artifact", F.when(F.col("quality") == 1, F.col("fingerprint")).otherwise("old").alias("fingerprint"))
    return evidence.freshness(docs, held).groupBy("state").agg(F.count("*").alias("n"))


@query(r"""
WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]*/([^?]*)', 1) AS i FROM pages)
SELECT page_id, CASE WHEN trim(i) = '' THEN 'empty' WHEN length(i) > 512 THEN 'too_long' WHEN contains(i, '/') THEN 'separator' ELSE 'ok' END AS problem FROM p""")
def id_policy(spark, sf):
    ident = F.regexp_extract("url", r"^[a-z]+://[^/]*/([^?]*)", 1)
    return table(spark, sf, "pages").select("page_id", F.coalesce(hygiene.id_problem(ident), F.lit("ok")).alias("problem"))


@query("""
SELECT conv_id, '/turns/' || (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) AS pointer, turn::VARCHAR AS video_id, 'turn' AS reference_kind, 'transcript' AS required_type FROM conversations""")
def reference_list(spark, sf):
    docs = table(spark, sf, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("turn")), lambda t: t.cast("string")).alias("turns"))
    return evidence.flattened(docs, [("turns", "turn", "transcript")], "conv_id").drop("position")


@query("""
WITH c AS (SELECT conv_id, turn * 5000 AS s, turn * 5000 + 4000 + (length(text) % 2) * 1000 AS e FROM conversations),
l AS (SELECT conv_id, s, lag(e) OVER (PARTITION BY conv_id ORDER BY s) AS expected_start FROM c)
SELECT conv_id, s AS start_ms, expected_start FROM l WHERE expected_start IS NOT NULL AND expected_start <> s""")
def chunk_continuity(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", (F.col("turn") * 5000).alias("start_ms"), (F.col("turn") * 5000 + 4000 + F.length("text") % 2 * 1000).alias("end_ms"))
    return status.discontinuities(rows, "conv_id", ["start_ms"], "start_ms", "end_ms").drop("end_ms")


@query(r"""SELECT conv_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text, turn * 1000 AS start_ms, turn * 1000 + 900 AS end_ms, 0 AS source_index, 'sentences' AS provider FROM conversations WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> ''""")
def parsed_segments(spark, sf):
    payload = F.to_json(F.struct(F.array(F.struct(F.array(F.struct((F.col("turn") * 1000).alias("begin_time"), (F.col("turn") * 1000 + 900).alias("end_time"), F.col("text"))).alias("sentences"))).alias("transcripts")))
    return transcripts.parse_responses(table(spark, sf, "conversations").select("conv_id", payload.alias("payload")), "conv_id", "payload")


@query("""
WITH st AS (SELECT doc_id, bool_or(quality = 1) AS a, bool_or(quality <> 1) AS r, count(*) > 1 AS rep FROM labels GROUP BY doc_id),
k AS (SELECT e.event_type AS topic, e.user_id, d.doc_id IS NOT NULL AND coalesce(a AND NOT rep, false) AS ok FROM events e LEFT JOIN documents d ON d.doc_id = e.user_id LEFT JOIN st ON st.doc_id = e.user_id),
t AS (SELECT topic, count(DISTINCT user_id) AS n FROM k GROUP BY topic)
SELECT 'enough_anchors' AS "check", count(DISTINCT CASE WHEN ok THEN user_id END) >= 15 AS passed, count(DISTINCT CASE WHEN ok THEN user_id END) AS n FROM k
UNION ALL SELECT 'distinct_ids_per_topic', count(*) FILTER (n < 2) = 0, count(*) FILTER (n < 2) FROM t""")
def anchor_checks(spark, sf):
    refs = table(spark, sf, "events").select(F.col("event_type").alias("topic"), F.col("user_id").cast("string").alias("video_id"))
    return evidence.anchors(refs, table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("video_id")), _decisions(spark, sf))


@query("""
WITH f AS (SELECT regexp_extract(url, '^[a-z]+://[^/]*/([^?]*)', 1) AS path, strlen(html) AS bytes FROM pages)
SELECT regexp_matches(path, '^(?:skill|research|reports|transcripts)/|\\.json$') AS keep, count(*) AS files, sum(bytes)::BIGINT AS bytes FROM f GROUP BY 1""")
def retention_totals(spark, sf):
    files = table(spark, sf, "pages").select(F.regexp_extract("url", r"^[a-z]+://[^/]*/([^?]*)", 1).alias("path"), F.octet_length("html").cast("long").alias("bytes"))
    return retention.totals(retention.plan(files, "derived"))


@query(rf"""
WITH src AS (SELECT conv_id || '-' || turn AS id, coalesce(text, '') AS text FROM conversations),
w AS (SELECT id, unnest(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+(?:\.[0-9]+)?|[\x{{4e00}}-\x{{9fff}}]+'), lambda x: regexp_full_match(x, '[a-z][a-z0-9_+.-]*|[\x{{4e00}}-\x{{9fff}}]+') AND {IS_TERM})) AS term FROM src),
c AS (SELECT id, term, count(*) AS n FROM w GROUP BY id, term),
t AS (SELECT id, array_to_string((list(term || ': ' || n ORDER BY n DESC, term))[1:30], ', ') AS top_terms FROM c GROUP BY id)
SELECT src.id, length(text) AS chars, length(regexp_extract_all(text, '[。！？!?]')) AS sentence_breaks, coalesce(top_terms, '') AS top_terms FROM src LEFT JOIN t USING (id)""")
def transcript_summaries(spark, sf):
    return reports.transcript_summary(table(spark, sf, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), "text"), "id").withColumn("top_terms", F.array_join("top_terms", ", "))


#: What the props of an event should be.
PROPS = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 5, "maximum": 60}}}


@query("""SELECT event_id, '/k' AS pointer, CASE WHEN k > 60 THEN 'maximum' ELSE 'minimum' END AS keyword FROM (SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events) WHERE k > 60 OR k < 5""")
def schema_violations(spark, sf):
    return schemas.schema_errors(table(spark, sf, "events"), PROPS, "event_id", "props")


@query("""SELECT key, value, source FROM (SELECT user_id AS key, arg_max(event_id::VARCHAR, event_id) AS value, arg_max(event_type, event_id) AS source FROM events WHERE event_type <> 'error' GROUP BY user_id)""")
def layered_settings(spark, sf):
    value = F.when(F.col("event_type") != "error", F.col("event_id").cast("string"))
    return checks.layered(table(spark, sf, "events").select(F.col("event_id").alias("rank"), F.col("event_type").alias("source"), F.col("user_id").alias("key"), value.alias("value")))
