"""Artifact ids: safe names, with a suffix of the id's hash where two ids would share one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corposcope.functions.text import safe_name


def assigned(items: DataFrame, key: str, order: str) -> DataFrame:
    """(key, order, artifact_id, renamed): the first item of a base name keeps it, others get --<sha10>.

    Only names that occur twice are numbered, after an aggregate over all names.
    """
    base = items.select(key, order, F.lower(safe_name(F.col(key).cast("string"), "video")).alias("__base"))
    shared = base.groupBy("__base").agg(F.count("*").alias("__n"), F.min(order).alias("__first"))
    out = base.join(shared, "__base")
    again = (F.col("__n") > 1) & (F.col(order) != F.col("__first"))
    return out.select(key, order, F.when(again, F.concat("__base", F.lit("--"), F.left(F.sha2(F.col(key).cast("string"), 256), F.lit(10)))).otherwise(F.col("__base")).alias("artifact_id"), again.alias("renamed"))


def url_conflicts(rows: DataFrame, key: str, url: str) -> DataFrame:
    """(key, urls, state) of rows grouped by id: several URLs conflict, one repeated is a duplicate."""
    out = rows.groupBy(key).agg(F.count_distinct(url).alias("urls"), F.count("*").alias("n"))
    return out.select(key, "urls", F.when(F.col("urls") > 1, "conflict").when(F.col("n") > 1, "duplicate").otherwise("single").alias("state"))


def numbered(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(order)))
