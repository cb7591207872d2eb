"""Terms, phrases and topics of a corpus, with the fragments they stand in.

Documents are rows (video_id, title, text); title may be null. A video_id is unique; where it isn't, each row is a
document. Tokens never reach over the end of a sentence, so frequencies come from whole texts in one pass, and
fragments are made only where their ids are asked for. Aggregates are partial before every shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corposcope.functions import ratios, text
from corposcope.operators import phrases
from corposcope.sources.scratch import written


def fragments(docs: DataFrame) -> DataFrame:
    """(video_id, kind, n, fragment_id, text): the title, then the sentences, numbered from 1 over the non-empty ones."""
    title = text.clean_fragment(F.coalesce("title", F.lit("")))
    said = docs.select("video_id", F.posexplode(F.concat(F.array(title), text.sentences("text"))).alias("n", "text")).where("text <> ''")
    return said.select("video_id", F.when(F.col("n") == 0, "title").otherwise("transcript").alias("kind"), "n", _fragment_id(F.col("n")).alias("fragment_id"), "text")


def _fragment_id(n: Column) -> Column:
    number = F.concat(F.lit("#transcript:"), F.lpad(n.cast("string"), F.greatest(F.lit(4), F.length(n.cast("string"))), "0"))
    return F.concat("video_id", F.when(n == 0, "#title").otherwise(number))


def analysed(docs: DataFrame) -> DataFrame:
    """One row: how many documents have a fragment."""
    return docs.agg(F.count_if(text.has_fragment("text") | text.has_fragment("title")).alias("n_docs"))


def term_rows(docs: DataFrame, tokenizer=text.tokens) -> DataFrame:
    """(video_id, kind, fragment_id, term) for each occurrence."""
    return fragments(docs).select("video_id", "kind", "fragment_id", F.explode(tokenizer(F.col("text"))).alias("term")).where(text.is_term(F.col("term")))


def occurrences(docs: DataFrame, tokenizer=text.tokens) -> DataFrame:
    """(video_id, term, hits): what each document gives for the counts of its terms, hits being 0 for an occurrence,
    1 for its first one in the document, 2 for its first one in the title. One pass, before any shuffle."""
    title, said = (tokenizer(text.without_times(F.coalesce(c, F.lit("")))) for c in ("title", "text"))
    split = docs.select("video_id", title.alias("title"), F.concat(title, said).alias("every"))
    marked = lambda c, hit: F.transform(c, lambda t: F.struct(t.alias("term"), F.lit(hit).alias("hits")))
    rows = F.concat(marked(F.col("every"), 0), marked(F.array_distinct("every"), 1), marked(F.array_distinct("title"), 2))
    return split.select("video_id", F.inline(rows))


def _counts(*more: Column) -> list[Column]:
    named = lambda hit, name: F.count_if(F.col("hits") == hit).alias(name)
    return [named(1, "document_frequency"), named(0, "total_frequency"), named(2, "title_document_frequency"), *more]


def term_evidence(docs: DataFrame, tokenizer=text.tokens) -> DataFrame:
    """Document, title and total frequency of each term, and the share of documents that have it.

    One shuffle, of counts by term; whether a token is a term is asked once for each.
    """
    found = occurrences(docs, tokenizer).groupBy("term").agg(*_counts()).where(text.is_term(F.col("term")))
    return found.crossJoin(F.broadcast(analysed(docs))).withColumn("coverage_ratio", ratios.floored_ratio(F.col("document_frequency"), F.col("n_docs"))).drop("n_docs")


def term_order() -> list:
    return [F.desc("document_frequency"), F.desc("title_document_frequency"), F.desc("total_frequency"), F.length("term"), F.col("term")]


def top_terms(docs: DataFrame, limit: int, tokenizer=text.tokens) -> DataFrame:
    return term_evidence(docs, tokenizer).orderBy(*term_order()).limit(limit)


def term_sources(docs: DataFrame, terms: DataFrame, tokenizer=text.tokens) -> DataFrame:
    """(term, representative_video_ids, source_fragment_ids) of chosen terms, sorted. A list is as long as the frequency
    of its term, so this is for the few terms of a report."""
    rows = term_rows(docs, tokenizer).join(F.broadcast(terms.select("term")), "term", "left_semi")
    return rows.groupBy("term").agg(F.sort_array(F.collect_set("video_id")).alias("representative_video_ids"), F.sort_array(F.collect_set("fragment_id")).alias("source_fragment_ids"))


def raw_token_counts(docs: DataFrame, stop=("这个", "一个", "我们", "你们", "他们", "就是", "然后", "因为", "所以", "但是", "the", "and", "for")) -> DataFrame:
    """(term, n): tokens of two CJK characters or three ASCII ones and more."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"[\x{4e00}-\x{9fff}]{2,}|[a-z][a-z0-9_-]{2,}"), F.lit(0))
    return docs.select(F.explode(found).alias("term")).where(~F.col("term").isin(*stop)).groupBy("term").agg(F.count("*").alias("n"))


def repeated_phrases(docs: DataFrame, least_docs: int = 2, tokenizer=text.tokens) -> DataFrame:
    """Phrases of `least_docs` documents or more, but those inside a phrase of the same documents that ranks before them."""
    return _with_confidence(phrases.outermost(phrases.blocks(docs, fragments, tokenizer), least_docs), docs)


def _with_confidence(found: DataFrame, docs: DataFrame) -> DataFrame:
    kept = found.crossJoin(F.broadcast(analysed(docs)))
    kept = kept.withColumn("coverage_ratio", ratios.floored_ratio(F.col("document_frequency"), F.col("n_docs")))
    level, score = ratios.phrase_confidence(F.col("document_frequency"), F.col("coverage_ratio"))
    return kept.select("phrase", "document_frequency", "total_frequency", "n_tokens", "coverage_ratio", level.alias("confidence_level"), score.alias("confidence_score"))


def top_phrases(docs: DataFrame, limit: int = 40, least_docs: int = 2, tokenizer=text.tokens) -> DataFrame:
    """The first `limit` of repeated_phrases() with their documents and fragments, and an id of phrase and documents.

    The lists are of these alone, each as long as the frequency of its phrase.
    """
    tokens = phrases.blocks(docs, fragments, tokenizer)
    rows = phrases.first(tokens, limit, least_docs)
    chosen = docs.sparkSession.createDataFrame(rows, phrases.COUNTED)
    places = phrases.places(tokens, [r[0] for r in rows]).withColumn("fragment_id", _fragment_id(F.col("n")))
    sources = places.groupBy("phrase").agg(F.sort_array(F.collect_set("video_id")).alias("representative_video_ids"), F.sort_array(F.collect_set("fragment_id")).alias("source_fragment_ids"))
    return _with_confidence(chosen, docs).join(sources, "phrase").withColumn("phrase_id", text.short_id("phrase", F.concat_ws("\n", "phrase", F.array_join("representative_video_ids", "\n"))))


def topic_groups(docs: DataFrame, tokenizer=text.tokens) -> DataFrame:
    """Terms of exactly the same documents: (docs, first_id, document_frequency, total_frequency, n_terms, terms ranked)."""
    # first occurrences alone carry the id, so each document is met once in its set
    rows = occurrences(docs, tokenizer).where("hits < 2").withColumn("video_id", F.when(F.col("hits") == 1, F.col("video_id")))
    first = rows.withColumn("h", F.xxhash64("video_id")).withColumn("k", F.xxhash64("video_id", F.lit(1)))
    once = F.col("hits") == 1
    identity = F.concat_ws(":", F.count("video_id"), F.sum(F.when(once, F.shiftrightunsigned("h", 32))), F.bit_xor(F.when(once, F.col("k"))))
    terms = first.groupBy("term").agg(identity.alias("docs"), F.count("video_id").alias("df"), F.min("video_id").alias("first_id"), F.count_if(F.col("hits") == 0).alias("tf"))
    many = docs.agg(F.when(F.count("*") <= 1, 1).otherwise(2).alias("least"))
    terms = terms.crossJoin(F.broadcast(many)).where((F.col("df") >= F.col("least")) & text.is_term(F.col("term")))
    order = F.array_sort(F.collect_list(F.struct(F.negative("tf").alias("o"), F.negative(F.length("term")).alias("l"), F.col("term").alias("term"))))
    return terms.groupBy("docs", F.col("df").alias("document_frequency"), "first_id").agg(F.sum("tf").alias("total_frequency"), F.count("*").alias("n_terms"), F.transform(order, lambda x: x["term"]).alias("terms"))


def distinct_terms(terms, limit: int = 6):
    """Greedy: takes terms in order unless they contain or are inside one already taken."""
    none = F.array().cast("array<string>")
    clash = lambda taken, t: F.exists(taken, lambda x: F.contains(x, t) | F.contains(t, x))
    return F.aggregate(terms, none, lambda taken, t: F.when((F.size(taken) >= limit) | clash(taken, t), taken).otherwise(F.array_append(taken, t)))


def topic_candidates(docs: DataFrame, limit: int = 12, tokenizer=text.tokens) -> DataFrame:
    """The first `limit` topic groups with two distinct terms, with their documents, confidence and status.

    Groups rank by documents and occurrences, both descending, then by their sorted ids; groups that tie beyond the
    limit are kept until the ids, made for the chosen groups only, settle them.
    """
    total = docs.agg(F.count_if((F.coalesce("title", F.lit("")) != "") | (F.coalesce("text", F.lit("")) != "")).alias("n_docs"))
    groups = written(topic_groups(docs, tokenizer).withColumn("distinguishing_terms", distinct_terms(F.col("terms"))).where(F.size("distinguishing_terms") >= 2).drop("terms"), "topics")
    order = [F.desc("document_frequency"), F.desc("total_frequency")]
    last = groups.orderBy(*order).limit(limit).agg(F.min(F.struct("document_frequency", "total_frequency")).alias("last"))
    near = groups.join(F.broadcast(last), F.struct("document_frequency", "total_frequency") >= F.col("last")).withColumn("term", F.col("distinguishing_terms")[0])
    ids = occurrences(docs, tokenizer).where("hits = 1").join(F.broadcast(near.select("term")), "term", "left_semi").groupBy("term").agg(F.sort_array(F.collect_list("video_id")).alias("video_ids"))
    top = near.join(F.broadcast(ids), "term").orderBy(*order, "video_ids").limit(limit).crossJoin(F.broadcast(total))
    top = top.withColumn("coverage_ratio", ratios.floored_ratio(F.col("document_frequency"), F.col("n_docs")))
    level, score = ratios.topic_confidence(F.col("document_frequency"), F.col("coverage_ratio"), F.size("distinguishing_terms"))
    ident = text.short_id("topic", F.concat_ws("\n", F.array_join("distinguishing_terms", "\n"), F.lit("--"), F.array_join("video_ids", "\n")))
    label = F.array_join(F.slice("distinguishing_terms", 1, 3), " / ")
    return top.select(ident.alias("candidate_id"), label.alias("provisional_label"), "document_frequency", "total_frequency", "coverage_ratio", level.alias("confidence_level"), score.alias("confidence_score"), F.array_join("distinguishing_terms", ",").alias("distinguishing_terms"), "video_ids")
