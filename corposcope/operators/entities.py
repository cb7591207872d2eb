"""Entity candidates: ASCII names found in fragments, and defined entities with their spans."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corposcope.functions.text import short_id

# Fixed values.
IGNORED = ("and", "for", "from", "that", "the", "this", "with")
CANDIDATE = r"[A-Za-z][A-Za-z0-9.+/-]{2,}"


def entity_key(name: str) -> str:
    """Compatibility form, case folded, without separators."""
    return re.sub(r"[\s._\-/\\·・]+", "", unicodedata.normalize("NFKC", name).casefold())


def ascii_candidates(texts: DataFrame, limit: int | None = 60) -> DataFrame:
    """(entity_key, form, document_frequency, occurrences, confidence, level): the `limit` that most documents have.

    A row of texts is a document. Forms and keys are counted in one partial aggregate, then candidates in another; the
    form shown is the most frequent one, then the smallest. Key of an ASCII name: lower case without separators.
    """
    plain = lambda form: F.regexp_replace(F.lower(form), "[._/-]+", "")
    kept = lambda form: ~F.lower(form).isin(*IGNORED)
    split = texts.select(F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("forms"))
    # a row for each occurrence of a form, and one for each key that the document has
    keys = F.array_distinct(F.transform(F.filter(F.array_distinct("forms"), kept), plain))
    none = F.lit(None).cast("string")
    rows = F.concat(F.transform("forms", lambda x: F.struct(x.alias("form"), none.alias("key"))), F.transform(keys, lambda x: F.struct(none.alias("form"), x.alias("key"))))
    counted = split.select(F.inline(rows)).groupBy("form", "key").agg(F.count("*").alias("n")).where(F.col("form").isNull() | kept(F.col("form")))
    named = counted.withColumn("entity_key", F.coalesce("key", plain(F.col("form")))).where("entity_key <> ''")
    a_form = F.col("form").isNotNull()
    out = named.groupBy("entity_key").agg(
        F.min_by("form", F.when(a_form, F.struct(F.negative("n"), F.lower("form"), F.col("form")))).alias("form"),
        F.sum(F.when(a_form, F.col("n"))).alias("occurrences"),
        F.sum(F.when(~a_form, F.col("n"))).alias("document_frequency"),
    )
    df, occ = F.col("document_frequency"), F.col("occurrences")
    score = F.when(df >= 3, 0.85).when((df >= 2) | (occ >= 3), 0.60).otherwise(0.30)
    out = out.select("entity_key", "form", "document_frequency", "occurrences", score.alias("confidence"), F.when((df >= 2) | (occ >= 3), "medium").otherwise("low").alias("impact"), short_id("entity", F.col("entity_key")).alias("candidate_id"))
    return out if limit is None else out.orderBy(F.desc("document_frequency"), F.desc("occurrences"), "entity_key").limit(limit)


SEPARATORS = r"[\s._\-/\\·・]"


def entity_pattern(form: str) -> str:
    """A form in compatibility form, with separators anywhere between its characters, not inside a longer ASCII word."""
    letters = [c for c in unicodedata.normalize("NFKC", form) if not re.fullmatch(SEPARATORS, c)]
    if not letters:
        raise ValueError(f"{form!r} has nothing to match")
    edge = "[A-Za-z0-9]"
    guards = [f"(?{sign}{edge})" if re.fullmatch(edge, c) else "" for c, sign in ((letters[0], "<!"), (letters[-1], "!"))]
    return (SEPARATORS + "*").join(map(re.escape, letters)).join(guards)


def entity_spans(texts: DataFrame, definitions: Mapping[str, Sequence[str]], key: str) -> DataFrame:
    """(key, canonical, start, end, surface) of defined entities (canonical -> aliases), a bounded table sent to the workers.

    Of the matches of a definition's forms in a text, the one that starts first is taken, of those the longest, and so
    on after its end.
    """
    compiled = [(name, [re.compile(entity_pattern(f), re.I) for f in {entity_key(f): f for f in (name, *aliases)}.values()]) for name, aliases in sorted(definitions.items())]
    kind = dict(texts.dtypes)[key]

    def match(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for ident, text in zip(frame[key], frame["text"], strict=True):
                for name, patterns in compiled:
                    free = 0
                    for a, b in sorted({m.span() for p in patterns for m in p.finditer(text or "")}, key=lambda s: (s[0], -s[1])):
                        if a >= free:
                            out.append((ident, name, a, b, text[a:b]))
                            free = b
            yield pd.DataFrame(out, columns=[key, "canonical", "start", "end", "surface"])

    return texts.select(key, "text").mapInPandas(match, f"{key} {kind}, canonical string, start int, end int, surface string")


def registered_candidates(spans: DataFrame, key: str) -> DataFrame:
    """(canonical, entity_key, candidate_id, document_frequency, occurrences, observed_forms, confidence) of found entities.

    Counted by document and surface first, so a name that all documents have is a partial aggregate.
    """
    plain = F.regexp_replace(F.lower("canonical"), SEPARATORS + "+", "")
    per = spans.groupBy("canonical", key).agg(F.count("*").alias("n"), F.collect_set("surface").alias("forms"))
    forms = F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_set("forms"))), lambda x: F.struct(F.lower(x).alias("low"), x.alias("form"))))
    found = per.groupBy("canonical").agg(F.count("*").alias("document_frequency"), F.sum("n").alias("occurrences"), forms.alias("forms"))
    return found.select("canonical", plain.alias("entity_key"), short_id("entity", plain).alias("candidate_id"), "document_frequency", "occurrences", F.transform("forms", lambda x: x["form"]).alias("observed_forms"), F.lit(0.95).alias("confidence"))


def outside_spans(found: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """Rows (key, start, end) that are in no span of the same text: a range anti join within equal keys."""
    return found.alias("f").join(spans.alias("s"), (F.col(f"f.{key}") == F.col(f"s.{key}")) & (F.col("f.start") >= F.col("s.start")) & (F.col("f.end") <= F.col("s.end")), "left_anti")


def overlaid_definitions(preset: DataFrame, project: DataFrame) -> DataFrame:
    """Two definition tables (entity_key, canonical, category) as one; the project's row wins, the preset's name becomes an alias."""
    both = preset.alias("a").join(project.alias("b"), "entity_key", "full_outer")
    return both.select("entity_key", F.coalesce("b.canonical", "a.canonical").alias("canonical"), F.coalesce("b.category", "a.category").alias("category"), F.when(F.col("b.canonical") != F.col("a.canonical"), F.col("a.canonical")).alias("alias"), F.when(F.col("b.canonical").isNotNull(), "project").otherwise("preset").alias("origin"))


def alias_collisions(forms: DataFrame) -> DataFrame:
    """(alias_key, owners) of forms (canonical, form) that more than one canonical name has, separators and case aside."""
    alias = F.regexp_replace(F.lower("form"), SEPARATORS + "+", "")
    owner = F.regexp_replace(F.lower("canonical"), SEPARATORS + "+", "")
    both = forms.select(alias.alias("alias_key"), owner.alias("owner")).unionByName(forms.select(owner.alias("alias_key"), owner.alias("owner"))).distinct()
    return both.groupBy("alias_key").agg(F.count("*").alias("owners")).where("owners > 1")


STATUSES = ("confirmed", "corrected", "ignored", "unresolved")


def reviewed(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """(candidate_id, impact, status, errors): each candidate with its first decision and what is wrong with that.

    Candidates are (candidate_id, impact); decisions (candidate_id, ordinal, status, treatment_note, corrected_term,
    final_references, reviewed_by, reviewed_at). Decisions on unknown candidates, and repeated ones, have a row with
    the error candidate_id; a candidate without a decision has the error decision.
    """
    number = F.row_number().over(Window.partitionBy("candidate_id").orderBy("ordinal"))
    made = decisions.withColumn("turn", number)
    both = candidates.withColumn("known", F.lit(True)).join(made, "candidate_id", "full_outer")
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    none = F.size(F.coalesce("final_references", F.array().cast("array<string>"))) == 0
    notes = ("treatment_note", "reviewed_by", "reviewed_at")
    status = F.col("status")
    usable = F.coalesce(status.isin(*STATUSES), F.lit(False))
    settled = usable & (status != "unresolved")
    stray = F.col("known").isNull() | (F.col("turn") > 1)
    corrected, plain = usable & (status == "corrected"), usable & status.isin("confirmed", "ignored")
    wrong = [
        (F.col("turn").isNull(), "decision"),
        (F.col("turn").isNotNull() & ~usable, "status"),
        ((status == "unresolved") & ~(blank("treatment_note") & blank("corrected_term") & none & blank("reviewed_by") & blank("reviewed_at")), "unresolved_fields"),
        *[(settled & blank(c), c) for c in notes],
        (plain & ~(blank("corrected_term") & none), "non_correction_fields"),
        (corrected & blank("corrected_term"), "corrected_term"),
        (corrected & none, "final_references"),
    ]
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for c, name in wrong]))
    return both.select("candidate_id", "impact", F.when(~stray & usable, status).alias("status"), F.when(stray, F.array(F.lit("candidate_id"))).otherwise(found).alias("errors"))


def review_totals(rows: DataFrame) -> DataFrame:
    """One row over reviewed(): counts by status, what is unresolved, blockers, and whether the review is complete."""
    status, high = F.col("status"), F.coalesce(F.col("impact") == "high", F.lit(False))
    counts = [F.count_if(status == x).alias(x) for x in STATUSES]
    open_ = status == "unresolved"
    out = rows.agg(F.count_if(F.col("impact").isNotNull()).alias("candidates"), *counts, F.count_if(open_ & high).alias("unresolved_high"), F.count_if(open_ & ~high).alias("warnings"), F.count_if(F.size("errors") > 0).alias("wrong"))
    processed = F.col("confirmed") + F.col("corrected") + F.col("ignored")
    idle = (F.col("candidates") > 0) & (processed == 0) & (F.col("unresolved_high") == 0)
    blockers = F.col("unresolved_high") + (F.col("wrong") > 0).cast("long") + idle.cast("long")
    return out.withColumn("processed", processed).withColumn("blockers", blockers).withColumn("complete", blockers == 0)


TOPIC_DECISIONS = ("accepted", "renamed", "merged", "rejected")


def topic_decision_problems(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """(ordinal, problem) of topic decisions (ordinal, candidate_id, decision, reason, reviewed_by, reviewed_at,
    replacement_label, merged_into): on an unknown candidate, of an unknown kind, without reason or reviewer, a new name
    without the name, a merge into itself or into nothing known."""
    known = candidates.select("candidate_id").distinct()
    rows = decisions.join(known.withColumn("here", F.lit(True)), "candidate_id", "left").join(known.select(F.col("candidate_id").alias("merged_into"), F.lit(True).alias("there")), "merged_into", "left")
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    kind = F.col("decision")
    wrong = [
        (F.col("here").isNull(), "candidate_id"),
        (~F.coalesce(kind.isin(*TOPIC_DECISIONS), F.lit(False)), "decision"),
        *[(blank(c), c) for c in ("reason", "reviewed_by", "reviewed_at")],
        ((kind == "renamed") & blank("replacement_label"), "replacement_label"),
        ((kind == "merged") & (F.col("there").isNull() | (F.col("merged_into") == F.col("candidate_id"))), "merged_into"),
    ]
    found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for c, name in wrong]))
    return rows.select("ordinal", F.explode(found).alias("problem"))


def candidate_problems(candidates: DataFrame) -> DataFrame:
    """(entity_key, problem) of detected candidates whose id, confidence or counts are not what their key and counts give."""
    df, occ = F.col("document_frequency"), F.col("occurrences")
    due = F.when(df >= 3, 0.85).when((df >= 2) | (occ >= 3), 0.60).otherwise(0.30)
    wrong = [
        (~F.col("candidate_id").eqNullSafe(short_id("entity", F.col("entity_key"))), "candidate_id"),
        (~F.col("confidence").eqNullSafe(due), "confidence"),
        (~F.coalesce((df >= 1) & (occ >= df), F.lit(False)), "counts"),
    ]
    return candidates.select("entity_key", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in wrong]))).alias("problem"))
