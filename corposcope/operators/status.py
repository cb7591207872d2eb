"""Stage coverage, step and pipeline rollups, sequences and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corposcope.functions import ratios


def stage_coverage(subjects: DataFrame, reached: DataFrame, stages: Sequence[str], key: str, draft=(2, 0.8), ready=(5, 0.95)) -> DataFrame:
    """Covered, ratio and gates of each stage over all subjects (key); reached has (key, stage).

    One aggregate gives each subject's stages, so a stage is no join of its own.
    """
    marks = reached.where(F.col("stage").isin(*stages)).groupBy(key).agg(*[F.max((F.col("stage") == s).cast("int")).alias(s) for s in stages])
    all_ = subjects.select(key).distinct().join(marks, key, "left")
    one = all_.agg(F.count("*").alias("expected"), *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in stages])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(s).alias("stage"), F.col(s).alias("covered")) for i, s in enumerate(stages)])
    out = one.select("expected", F.explode(rows).alias("x")).select("x.position", "x.stage", "expected", "x.covered")
    return out.select(
        "stage",
        "expected",
        "covered",
        ratios.ratio_or_zero(F.col("covered"), F.col("expected")).alias("ratio"),
        (F.col("covered") >= ratios.required(F.col("expected"), *draft)).alias("draft"),
        (F.col("covered") >= ratios.required(F.col("expected"), *ready)).alias("ready"),
    )


# Statuses that count as success.
SUCCESS = ("succeeded", "completed", "downloaded", "extracted", "transcribed")


def step_rollup(rows: DataFrame) -> DataFrame:
    """Four counts and a status of each step from rows (step_id, status, verified): a skip that was verified counts as success."""
    s = F.lower("status")
    good = s.isin(*SUCCESS) | ((s == "skipped") & F.coalesce("verified", F.lit(False)))
    skip = (s == "skipped") & ~good
    fail = s == "failed"
    out = rows.groupBy("step_id").agg(F.count("*").alias("total"), F.count_if(good).alias("succeeded"), F.count_if(fail).alias("failed"), F.count_if(skip).alias("skipped"))
    t, g, f, k = (F.col(c) for c in ("total", "succeeded", "failed", "skipped"))
    return out.withColumn("status", F.when(f == t, "failed").when(f > 0, "partial").when(g > 0, F.when(g + k == t, "succeeded").otherwise("partial")).otherwise("skipped"))


def pipeline_status(steps: DataFrame) -> DataFrame:
    """One row: failed before partial before succeeded, with the exit code."""
    any_ = lambda s: F.coalesce(F.bool_or(F.col("status") == s), F.lit(False))
    out = steps.agg(any_("failed").alias("f"), any_("partial").alias("p"), F.count("*").alias("steps"))
    status = F.when(F.col("f"), "failed").when(F.col("p"), "partial").otherwise("succeeded")
    return out.select("steps", status.alias("status"), F.when(F.col("f"), 1).when(F.col("p"), 2).otherwise(0).alias("exit_code"))


def execution_summary(steps: DataFrame, key: str, duration: str) -> DataFrame:
    """Steps, their total duration and the slowest one, the first by key of equal ones."""
    return steps.agg(F.count("*").alias("steps"), F.round(F.sum(duration), 2).alias("total"), F.round(F.max(duration), 2).alias("longest"), F.min_by(key, F.struct(F.negative(duration), key)).alias("slowest"))


def sequence_faults(rows: DataFrame, key: str, number: str, first: int) -> DataFrame:
    """(key, rows, faults) where the numbers of a key don't run on from `first` without gap or repeat."""
    w = Window.partitionBy(key).orderBy(number)
    placed = rows.withColumn("__at", F.row_number().over(w) - 1 + first)
    return placed.groupBy(key).agg(F.count("*").alias("rows"), F.count_if(F.col(number) != F.col("__at")).alias("faults"))


def running(rows: DataFrame, key: str, order: Sequence, amount: str) -> DataFrame:
    """Adds start_at, the sum of the amounts before a row, and end_at."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("end_at", F.sum(amount).over(w)).withColumn("start_at", F.col("end_at") - F.col(amount))


def discontinuities(rows: DataFrame, key: str, order: Sequence, start: str, end: str) -> DataFrame:
    """Rows that don't start where the row before them ended."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("expected_start", F.lag(end).over(w)).where(F.col("expected_start").isNotNull() & (F.col("expected_start") != F.col(start)))


def carried(rows: DataFrame, key: str, order: Sequence, column: str) -> DataFrame:
    """Adds <column>_carried: the last value that is not null so far."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(f"{column}_carried", F.last(column, ignorenulls=True).over(w))


def without_repeats(rows: DataFrame, key: str, order: Sequence, column: str) -> DataFrame:
    """Rows whose value differs from that of the row before."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).withColumn("__before", F.lag(column).over(w)).where((F.col("__n") == 1) | ~F.col(column).eqNullSafe(F.col("__before"))).drop("__n", "__before")


def keep_first(rows: DataFrame, keys: Sequence[str], order) -> DataFrame:
    """The first row of each key; an aggregate, so a key's rows are reduced before the shuffle."""
    first = F.min_by(F.struct(*rows.columns), F.struct(*order))
    return rows.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(first.alias("__row")).select("__row.*")


def upserted(state: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """state with the rows of changes (same columns) put in place of those of equal key, or added."""
    return state.join(changes.select(key), key, "left_anti").unionByName(changes)


# Statuses of a log that say a stage was done.
DONE = {"downloaded": ("downloaded", "succeeded", "completed"), "audio": ("extracted", "succeeded", "completed"), "transcribed": ("transcribed", "succeeded", "completed")}


def stage_states(selected: DataFrame, logs: dict[str, DataFrame], files: dict[str, DataFrame], offline: bool = False) -> DataFrame:
    """(video_id, stage, status, code) of every selected item in each of four stages; code is null where nothing is wrong.

    selected is (video_id, artifact_id, download_url); logs are (id, status) by stage, one row for an id, found by the
    item's own id or else by its artifact's; files are (artifact_id) by stage. What a stage's log says of a failure
    counts before the file. A stage without a log is blocked where the one before it isn't covered. Offline runs need
    no download and no audio. Seven left joins, each on one key; the ladder is one projection.
    """
    rows = selected
    for stage in ("downloaded", "audio", "transcribed"):
        for by in ("video_id", "artifact_id"):
            log = logs[stage].select(F.col("id").alias(by), F.lower("status").alias(f"{stage}_{by}"), F.lit(True).alias(f"{stage}_{by}_row"))
            rows = rows.join(log, by, "left")
        held = files[stage].select("artifact_id").distinct().withColumn(f"{stage}_file", F.lit(True))
        rows = rows.join(held, "artifact_id", "left")
    found = lambda s: F.coalesce(f"{s}_video_id_row", f"{s}_artifact_id_row", F.lit(False))
    said = lambda s: F.coalesce(F.when(F.col(f"{s}_video_id_row"), F.col(f"{s}_video_id")).otherwise(F.col(f"{s}_artifact_id")), F.lit(""))
    file = lambda s: F.coalesce(f"{s}_file", F.lit(False))
    done = lambda s: said(s).isin(*DONE[s])

    def produced(s: str, name: str, absent: str, ladder):
        """What to say where a stage left no file."""
        return ladder.when(~found(s), absent).when(done(s), f"{name}_ARTIFACT_MISSING").when(said(s) == "skipped", f"{name}_SKIPPED").otherwise(f"{name}_FAILED")

    no_url = F.trim(F.coalesce("download_url", F.lit(""))) == ""
    fetched = F.when(no_url, "DOWNLOAD_URL_MISSING").when(said("downloaded") == "failed", "DOWNLOAD_FAILED").when(file("downloaded"), None)
    rows = rows.withColumn("downloaded", produced("downloaded", "DOWNLOAD", "DOWNLOAD_NOT_RECORDED", fetched))
    heard = F.when(said("audio") == "failed", "AUDIO_FAILED").when(file("audio"), None).when(F.col("downloaded").isNotNull() & ~found("audio"), "AUDIO_BLOCKED")
    rows = rows.withColumn("audio", produced("audio", "AUDIO", "AUDIO_NOT_PRODUCED", heard))
    blocked = F.lit(not offline) & F.col("audio").isNotNull()
    written_out = F.when(file("transcribed"), None).when(said("transcribed") == "skipped", "ASR_SKIPPED").when(found("transcribed") & ~done("transcribed"), "ASR_FAILED")
    rows = rows.withColumn("transcribed", written_out.when(blocked, "TRANSCRIPTION_BLOCKED").otherwise("TRANSCRIPT_MISSING"))
    state = lambda c: F.when(c.isNull(), "covered").when(c.endswith("_BLOCKED"), "blocked").otherwise("failed")
    exempt = F.struct(F.lit("not_required").alias("status"), F.lit(None).cast("string").alias("code"))
    one = lambda s: F.struct(state(F.col(s)).alias("status"), F.col(s).alias("code"))
    picked = F.when(F.trim(F.coalesce("video_id", F.lit(""))) == "", "VIDEO_ID_INVALID")
    stages = {"selected": F.struct(state(picked).alias("status"), picked.alias("code")), "downloaded": exempt if offline else one("downloaded"), "audio": exempt if offline else one("audio"), "transcribed": one("transcribed")}
    every = F.array(*[F.struct(F.lit(s).alias("stage"), x["status"].alias("status"), x["code"].alias("code")) for s, x in stages.items()])
    return rows.select("video_id", F.inline(every))
