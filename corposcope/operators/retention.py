"""What a run keeps: files by policy, totals, and a digest of the listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Path patterns that each policy keeps; the plan is made here, nothing is deleted.
KEEPS = {
    "all": r".*",
    "derived": r"^(?:skill|research|reports|transcripts)/|\.json$",
    "final": r"^skill/|(?:^|/)(?:manifest|meta|quality_report)\.json$",
}


def kept(path: Column, policy: str) -> Column:
    return path.rlike(KEEPS[policy])


def plan(files: DataFrame, policy: str) -> DataFrame:
    """Adds keep to rows (path, bytes)."""
    return files.withColumn("keep", kept(F.col("path"), policy))


def totals(planned: DataFrame) -> DataFrame:
    """(keep, files, bytes) of a plan."""
    return planned.groupBy("keep").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def listing_digest(files: DataFrame) -> DataFrame:
    """One row: files, bytes and a digest that doesn't depend on order: the sum of the rows' hashes."""
    row = F.xxhash64("path", "bytes").cast("decimal(38,0)")
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.sha2(F.coalesce(F.sum(row), F.lit(0)).cast("string"), 256).alias("digest"))
