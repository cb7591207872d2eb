"""Corpus records, signals, coverage buckets, gaps, short forms and shifts over time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corposcope.functions import ratios, text
from corposcope.sources.scratch import written

SHORT = 800
LONG = 5000


def corpus_records(docs: DataFrame, themes: Mapping[str, Sequence[str]]) -> DataFrame:
    """(video_id, source, chars, sentence_breaks, themes, opener, ending): one projection, no shuffle."""
    t = F.coalesce("text", F.lit(""))
    return docs.select(
        "video_id",
        "title",
        F.length(t).cast("long").alias("transcript_chars"),
        text.sentence_count(t).cast("long").alias("sentence_breaks"),
        text.labels(F.coalesce("title", F.lit("")), themes).alias("themes"),
        F.left(text.clean(t), F.lit(180)).alias("opener"),
        F.right(text.clean(t), F.lit(180)).alias("ending"),
    )


def corpus_totals(records: DataFrame) -> DataFrame:
    chars = F.col("transcript_chars")
    return records.agg(
        F.count("*").alias("items"),
        F.count_if(chars > 0).alias("with_transcript"),
        F.coalesce(F.sum(chars), F.lit(0)).alias("total_chars"),
        F.count_if(chars >= LONG).alias("long_form"),
        F.count_if((chars > 0) & (chars < SHORT)).alias("short_form"),
    )


def weighted_score(likes, favorites, shares, comments):
    zero = lambda c: F.coalesce(c, F.lit(0))
    return zero(likes) + 3 * zero(favorites) + 4 * zero(shares) + 2 * zero(comments)


def signals(docs: DataFrame, preset) -> DataFrame:
    """Hook, argument, ending and contribution labels, and the boundary flag, of each document.

    What several labels look at is made once, in a projection of its own: the sentences and lower-case texts.
    """
    title, body = F.coalesce("title", F.lit("")), F.coalesce("text", F.lit(""))
    made = docs.select("video_id", F.length(body).cast("long").alias("transcript_chars"), F.lower(title).alias("title"), F.lower(F.concat_ws(" ", title, body)).alias("both"), text.sentences_with_ends(body).alias("parts"))
    first = F.lower(F.concat_ws(" ", F.slice("parts", 1, 3)))
    last = F.lower(F.concat_ws(" ", F.slice("parts", F.greatest(F.size("parts") - 2, F.lit(1)), F.lit(3))))
    made = made.withColumns({"first": F.when(F.length(first) > 0, first).otherwise(F.col("title")), "last": last, "themes": text.labels_in(F.col("title"), preset.themes)})
    none = F.array().cast("array<string>")
    pairs = [x for k, v in preset.contributions.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))]
    given = F.flatten(F.transform("themes", lambda t: F.coalesce(F.element_at(F.create_map(*pairs), t), none))) if pairs else none
    every = F.concat(given, text.labels_in(F.col("both"), preset.extra_contributions))
    return made.select(
        "video_id",
        "transcript_chars",
        "themes",
        text.labels_in(F.col("first"), preset.hooks).alias("hooks"),
        text.labels_in(F.col("both"), preset.arguments).alias("arguments"),
        text.labels_in(F.col("last"), preset.endings).alias("endings"),
        F.when(F.size(every) > 0, every).otherwise(F.array(F.lit("evidence:general_style"))).alias("contributions"),
        (F.arrays_overlap("themes", F.array(*[F.lit(x) for x in preset.boundary_themes]).cast("array<string>")) | text.holds_any(F.col("both"), preset.boundary_words)).alias("boundary"),
        text.first_with(F.col("parts"), preset.judgments).alias("judgment_sentence"),
    )


def label_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(kind, label, n) over array columns of labels."""
    kinds = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("labels")) for c in columns])
    flat = rows.select(F.explode(kinds).alias("k")).select("k.kind", F.explode("k.labels").alias("label"))
    return flat.groupBy("kind", "label").agg(F.count("*").alias("n"))


def evidence_decisions(rows: DataFrame) -> DataFrame:
    """Normalises (video_id, status, reason) to accepted, rejected or invalid, and flags repeated and conflicting ids."""
    plain = F.regexp_replace(F.lower(F.trim("status")), r"[\s_-]+", "")
    kind = F.when(plain.isin(*ACCEPTED), "accepted").when(plain.isin(*REJECTED), "rejected").otherwise("invalid")
    return rows.withColumn("decision", kind)


# Statuses as they are after normalisation.
ACCEPTED = ("accepted", "adopted", "covered", "included", "used", "接受", "采用", "已采用", "覆盖")
REJECTED = ("excluded", "ignored", "rejected", "notused", "不采用", "已拒绝", "拒绝", "排除", "未采用")


def decision_state(decisions: DataFrame) -> DataFrame:
    """(video_id, accepted, rejected, repeated, conflicting) of each decided id."""
    seen = decisions.groupBy("video_id").agg(F.count_if(F.col("decision") == "accepted").alias("a"), F.count_if(F.col("decision") == "rejected").alias("r"))
    return seen.select("video_id", (F.col("a") > 0).alias("accepted"), (F.col("r") > 0).alias("rejected"), (F.col("a") + F.col("r") > 1).alias("repeated"), ((F.col("a") > 0) & (F.col("r") > 0)).alias("conflicting"))


def bucket_members(records: DataFrame, top: int = 10) -> DataFrame:
    """(bucket, video_id): the first `top` by interaction score, by length, of short forms, and of boundary samples.

    Each is a top-k, so no task sorts the corpus."""
    of = lambda name, rows, *order: rows.orderBy(*order).limit(top).select(F.lit(name).alias("bucket"), "video_id")
    chars = F.col("transcript_chars")
    return (
        of("interaction", records, F.desc("score"), F.desc("transcript_chars"), "video_id")
        .unionByName(of("length", records, F.desc("transcript_chars"), F.desc("score"), "video_id"))
        .unionByName(of("short_form", records.where((chars > 0) & (chars < SHORT)), "video_id"))
        .unionByName(of("boundary", records.where("boundary"), "video_id"))
    )


BUCKETS = ("interaction", "length", "short_form", "boundary")


def coverage_buckets(members: DataFrame, state: DataFrame) -> DataFrame:
    """Total, covered, rejected, missing and ratio of each bucket; the ratio of an empty one is null (not applicable)."""
    names = members.sparkSession.createDataFrame([(b,) for b in BUCKETS], "bucket string")
    usable = state.select("video_id", (F.col("accepted") & ~F.col("conflicting")).alias("ok"), "rejected")
    joined = names.join(members.join(usable, "video_id", "left"), "bucket", "left")
    ok, no = F.coalesce("ok", F.lit(False)), F.coalesce("rejected", F.lit(False))
    here = F.col("video_id").isNotNull()
    out = joined.groupBy("bucket").agg(F.count_if(here).alias("total"), F.count_if(here & ok).alias("covered"), F.count_if(here & ~ok & no).alias("rejected"), F.count_if(here & ~ok & ~no).alias("missing"))
    return out.withColumn("ratio", ratios.ratio_or_null(F.col("covered"), F.col("total")))


def coverage_score(buckets: DataFrame) -> DataFrame:
    """The mean of the applicable ratios, 0 if there is none."""
    return buckets.agg(F.coalesce(F.round(F.avg("ratio"), 4), F.lit(0.0)).alias("score"), F.count("ratio").alias("applicable"))


def coverage_gaps(members: DataFrame, records: DataFrame, state: DataFrame, limit: int = 20) -> DataFrame:
    """The uncovered members, by the least priority number of their buckets: (video_id, priority, reasons)."""
    covered = state.where("accepted and not conflicting").select("video_id")
    gaps = members.join(covered, "video_id", "left_anti").withColumn("priority", F.when(F.col("bucket").isin("interaction", "length"), 1).otherwise(2))
    each = gaps.groupBy("video_id").agg(F.min("priority").alias("priority"), F.array_join(F.sort_array(F.collect_set("bucket")), ",").alias("reasons"))
    out = each.join(records.select("video_id", "score", "transcript_chars"), "video_id")
    return out.orderBy("priority", F.desc("score"), F.desc("transcript_chars"), "video_id").limit(limit)


def short_forms(docs: DataFrame, preset) -> DataFrame:
    """(pattern, strength, n) of hooks and endings of texts under 800 characters; weak ones have fewer than 300.

    Long texts are left out before anything is made of them; the only shuffle is of counts.
    """
    found = signals(docs.where((F.length("text") > 0) & (F.length("text") < SHORT)), preset)
    marks = F.concat(F.transform("hooks", lambda x: F.concat(F.lit("hook:"), x)), F.transform("endings", lambda x: F.concat(F.lit("ending:"), x)))
    rows = found.select(F.when(F.col("transcript_chars") < 300, "weak").otherwise("normal").alias("strength"), F.explode(marks).alias("pattern"))
    return rows.groupBy("pattern", "strength").agg(F.count("*").alias("n"))


def periods(rows: DataFrame, order: Sequence, parts: int = 3, name: str = "period") -> DataFrame:
    """Splits rows in order into `parts` runs that end at round(i n / parts), halves to even.

    Numbers are dealt by range partitions and their counts, so no task holds all rows.
    """
    dealt = rows.withColumn("__key", F.struct(*order)).repartitionByRange("__key").withColumn("__part", F.spark_partition_id())
    # written, as range bounds come from a sample and both reads below must see the same ones
    ordered = written(dealt, "periods")
    counts = ordered.groupBy("__part").agg(F.count("*").alias("c")).withColumn("__before", F.sum("c").over(Window.orderBy("__part")) - F.col("c"))
    total = rows.agg(F.count("*").alias("__n"))
    w = Window.partitionBy("__part").orderBy("__key")
    numbered = ordered.withColumn("__i", F.row_number().over(w)).join(F.broadcast(counts.select("__part", "__before")), "__part").crossJoin(F.broadcast(total))
    at = F.col("__before") + F.col("__i") - 1
    bound = lambda i: F.bround(F.col("__n") * i / parts, 0)
    which = F.lit(parts)
    for i in range(parts - 1, 0, -1):
        which = F.when(at < bound(i), i).otherwise(which)
    return numbered.withColumn(name, which).drop("__key", "__part", "__before", "__i", "__n")


def drift(first: DataFrame, last: DataFrame) -> DataFrame:
    """1 - Jaccard of two label sets (label), 0 if both are empty."""
    marked = first.select("label", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(last.select("label", F.lit(0).alias("a"), F.lit(1).alias("b"))).groupBy("label").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return marked.agg(F.when(F.count("*") == 0, 0.0).otherwise(F.round(1 - F.sum(F.col("a") * F.col("b")) / F.count("*"), 4)).alias("drift"))


def recent(rows: DataFrame, keys: Sequence[str], order: Sequence, limit: int) -> DataFrame:
    """The first `limit` rows of each key in order, numbered; Spark's group limit cuts them before the shuffle."""
    return rows.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("n") <= limit)
