"""Verbatim overlap of target texts with a corpus: characters covered by common runs, and the longest run."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corposcope.functions.text import overlap_text
from corposcope.sources.scratch import written

RUN = 48
#: Targets of up to this many seed rows are broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 2_000_000


def overlap(targets: DataFrame, corpus: DataFrame, run: int = RUN, key: str = "item_id", source: str = "doc_id") -> DataFrame:
    """(key, chars, matched_chars, longest, copied_ratio, n_sources) for every target (key, text).

    Letters and digits are compared, case aside. Every common run of `run` characters or more counts; texts
    shorter than that have none. A run of that length holds one aligned seed of the corpus text (seeds of
    (run + 2) / 2 characters start at each multiple of run - seed + 1), so only these are hashed and joined with
    all positions of the targets, whose number is checked before they are broadcast. Candidate
    (target, document, shift) triples are then extended character by character, so no hash decides a result.
    """
    seed = run // 2 + 1
    every = run - seed + 1
    goal = targets.select(key, overlap_text(F.coalesce("text", F.lit(""))).alias("t"))
    said = corpus.select(source, overlap_text(F.coalesce("text", F.lit(""))).alias("s"))
    spots = F.sequence(F.lit(0), F.length("t") - seed)
    goals = goal.where(F.length("t") >= run).select(key, F.posexplode(F.transform(spots, lambda i: F.xxhash64(F.substring("t", i + 1, F.lit(seed))))).alias("tpos", "h"))
    # a text is cut into blocks once; a seed is a block and the start of the next
    blocks = said.select(source, F.regexp_extract_all("s", F.lit(f".{{1,{every}}}"), F.lit(0)).alias("b"))
    seeds = blocks.select(source, F.posexplode(F.zip_with("b", F.slice("b", 2, F.greatest(F.size("b"), F.lit(1))), lambda x, y: F.left(F.concat(x, F.coalesce(y, F.lit(""))), F.lit(seed)))).alias("block", "seed"))
    seeds = seeds.where(F.length("seed") == seed).select(source, (F.col("block") * every).alias("spos"), F.xxhash64("seed").alias("h"))
    small = goal.agg(F.sum(F.length("t"))).first()[0] or 0
    goals = F.broadcast(goals) if small <= BROADCAST_ROWS else goals
    # one row for each target and document, so a text is taken once however often it quotes a target
    shifts = seeds.join(goals, "h").groupBy(key, source).agg(F.collect_set(F.col("tpos") - F.col("spos")).alias("shifts"))
    both = shifts.join(said, source).join(F.broadcast(goal) if small <= BROADCAST_ROWS else goal, key).select(key, source, "shifts", "s", "t")
    kind = dict(targets.dtypes)[key]

    def extend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [(r[0], sorted({x for shift in r[2] for x in _runs(r[3], r[4], int(shift), run)})) for r in frame.itertuples(index=False)]
            yield pd.DataFrame([(k, [{"start": a, "end": b} for a, b in runs]) for k, runs in found if runs], columns=[key, "runs"])

    return _summed(goal, both.mapInPandas(extend, f"{key} {kind}, runs array<struct<start:int,end:int>>"), key)


def _runs(s: str, t: str, shift: int, least: int) -> list[tuple[int, int]]:
    """[start, end) in t of maximal equal runs at one shift."""
    out, i, stop = [], max(0, shift), min(len(t), len(s) + shift)
    while i < stop:
        j = i
        while j < stop and t[j] == s[j - shift]:
            j += 1
        if j - i >= least:
            out.append((i, j))
        i = j + 1
    return out


def _summed(goal: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Totals of each target. Runs are first reduced to the longest from each start, so a target has as many as it has
    characters at most, however many documents quote it; the rest of a run beyond all earlier ones is what it adds."""
    found = written(found, "runs")
    sources = found.groupBy(key).agg(F.count("*").alias("n_sources"))
    runs = found.select(key, F.inline("runs")).groupBy(key, "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy(key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0)))
    per = runs.groupBy(key).agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reach"))).alias("covered"), F.max(F.col("end") - F.col("start")).alias("longest"))
    out = goal.select(key, F.length("t").cast("long").alias("chars")).join(per.join(sources, key), key, "left")
    matched = F.coalesce("covered", F.lit(0)).cast("long")
    ratio = F.when(F.col("chars") == 0, F.lit(0.0)).otherwise(F.round(matched / F.col("chars"), 4))
    return out.select(key, "chars", matched.alias("matched_chars"), F.coalesce("longest", F.lit(0)).cast("long").alias("longest"), ratio.alias("copied_ratio"), F.coalesce("n_sources", F.lit(0)).alias("n_sources"))


def overlap_verdict(found: DataFrame, longest: int = 239, ratio: float = 0.20, from_chars: int = 120) -> DataFrame:
    """Adds passed: no run is longer than `longest`, and not over `ratio` is copied once `from_chars` are."""
    return found.withColumn("passed", (F.col("longest") <= longest) & ((F.col("matched_chars") < from_chars) | (F.col("copied_ratio") <= ratio)))
