"""References against corpus and decisions: orphans, missing, type mismatches, duplicates, anchors, gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def orphans(refs: DataFrame, corpus: DataFrame, key: str) -> DataFrame:
    return refs.join(corpus.select(key).distinct(), key, "left_anti")


def integrity_violations(refs: DataFrame, corpus: DataFrame, state: DataFrame) -> DataFrame:
    """(pointer, video_id, category) of references (pointer, video_id, required_type).

    orphan: not in the corpus (video_id, transcript_chars). missing: in it, but not accepted, or conflicting or
    decided more than once. type: a transcript is required and there is none.
    """
    known = refs.join(corpus.select("video_id", "transcript_chars"), "video_id", "left").join(state, "video_id", "left")
    there = F.col("transcript_chars").isNotNull()
    usable = F.coalesce(F.col("accepted") & ~F.col("repeated"), F.lit(False))
    found = F.array_compact(
        F.array(
            F.when(~there, "orphan"),
            F.when(there & ~usable, F.when(F.coalesce(F.col("repeated"), F.lit(False)), "ambiguous").when(F.coalesce(F.col("rejected"), F.lit(False)), "rejected").otherwise("missing")),
            F.when(there & (F.col("required_type") == "transcript") & (F.col("transcript_chars") <= 0), "type"),
        )
    )
    return known.select("pointer", "video_id", F.explode(found).alias("category"))


def violation_counts(violations: DataFrame) -> DataFrame:
    return violations.groupBy("category").agg(F.count("*").alias("n"), F.count_distinct("video_id").alias("ids"))


def first_pointers(refs: DataFrame, parent: Sequence[str], order: Sequence) -> DataFrame:
    """Adds first_pointer, that of the first equal id in the same list, and is_duplicate."""
    w = Window.partitionBy(*parent, "video_id").orderBy(*order)
    return refs.withColumn("first_pointer", F.first("pointer").over(w)).withColumn("is_duplicate", F.row_number().over(w) > 1)


def flattened(docs: DataFrame, lists: Sequence[tuple[str, str, str]], key: str) -> DataFrame:
    """(key, pointer, video_id, reference_kind, required_type, position) of list columns (column, kind, type)."""
    parts = [docs.select(key, F.posexplode(c).alias("position", "video_id")).select(key, F.concat(F.lit(f"/{c}/"), F.col("position").cast("string")).alias("pointer"), "video_id", F.lit(k).alias("reference_kind"), F.lit(t).alias("required_type"), "position") for c, k, t in lists]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate(checks: DataFrame) -> DataFrame:
    """(gate, passed, failed checks in order) of rows (gate, check, passed); null counts as not passed."""
    ok = F.coalesce("passed", F.lit(False))
    return checks.groupBy("gate").agg(F.bool_and(ok).alias("passed"), F.array_join(F.sort_array(F.collect_set(F.when(~ok, F.col("check")))), ",").alias("failed"))


def synced_ledger(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Full outer join of candidates (candidate_id) with their first decision (candidate_id, ordinal, status):
    new ones are pending, decisions without a candidate orphaned, later decisions of an id duplicates."""
    first = decisions.withColumn("k", F.row_number().over(Window.partitionBy("candidate_id").orderBy("ordinal")))
    kept = candidates.select("candidate_id", F.lit(True).alias("known")).join(first, "candidate_id", "full_outer")
    state = F.when(F.col("known").isNull(), "orphaned").when(F.col("k") > 1, "duplicate").when(F.col("status").isNull(), "pending").otherwise(F.col("status"))
    return kept.select("candidate_id", "ordinal", state.alias("state"))


def matching_fields(left: DataFrame, right: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, field, matches) for each field of both tables, nulls equal."""
    both = left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"), "full_outer")
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"l.{f}").cast("string").eqNullSafe(F.col(f"r.{f}").cast("string")).alias("matches")) for f in fields])
    return both.select(F.coalesce(f"l.{key}", f"r.{key}").alias(key), F.explode(rows).alias("x")).select(key, "x.field", "x.matches")


def freshness(expected: DataFrame, recorded: DataFrame) -> DataFrame:
    """(artifact, state): missing, stale or fresh, by the fingerprints of both tables (artifact, fingerprint)."""
    both = expected.join(recorded.withColumnRenamed("fingerprint", "recorded"), "artifact", "left")
    return both.select("artifact", F.when(F.col("recorded").isNull(), "missing").when(F.col("recorded") != F.col("fingerprint"), "stale").otherwise("fresh").alias("state"))


def anchors(refs: DataFrame, corpus: DataFrame, state: DataFrame, least: int = 15, per_topic: int = 2) -> DataFrame:
    """(check, passed, n) of anchors (topic, video_id): enough valid ones, and enough distinct ids in each topic.

    An anchor is valid if its id is in the corpus and accepted once, without conflict.
    """
    known = refs.join(corpus.select("video_id").distinct().withColumn("there", F.lit(True)), "video_id", "left").join(state, "video_id", "left")
    valid = F.coalesce(F.col("there") & F.col("accepted") & ~F.col("repeated"), F.lit(False))
    marked = known.withColumn("valid", valid)
    total = marked.agg(F.count_distinct(F.when(F.col("valid"), F.col("video_id"))).alias("n")).select(F.lit("enough_anchors").alias("check"), (F.col("n") >= least).alias("passed"), "n")
    topics = marked.groupBy("topic").agg(F.count_distinct("video_id").alias("k")).agg(F.count_if(F.col("k") < per_topic).alias("n"))
    return total.unionByName(topics.select(F.lit("distinct_ids_per_topic").alias("check"), (F.col("n") == 0).alias("passed"), "n"))
