"""Exact duplicates by distributed MSD radix partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corposcope.llm.common import dropped, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first_digit: int = 48, next_digit: int = 2048, growth: int = 8) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row; the largest id of a group stays.

    Null text counts as empty. Texts are equal when their bytes are equal after lower-casing A-Z;
    equality is decided by comparing bytes, never by a digest (text_sha256 is only reported).

    Buckets are split by successive runs of bytes. The first digit is the length with the first
    `first_digit` bytes, later digits are runs that grow by `growth`. A bucket ends when it has one
    row or its bytes are used up; only rows of buckets with more are carried on, with the bytes they
    still have, under a number of their bucket that is written with its size. Bucket sizes are
    partial aggregates, so a bucket with a third of all rows is counted before the shuffle; the join
    that hands them back reads written tables, so the adaptive skew join can split it. Other columns of docs are ignored; repeated ids count as rows of their own,
    a null id is smaller than all others.
    """
    text = F.encode(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER), "utf-8")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("t")).select("id", F.sha2("t", 256).alias("sha"), F.octet_length("t").alias("len"), "t")
    settled: list[DataFrame] = []
    width, level = first_digit, 0
    now = rows.withColumn("bucket", F.lit(None).cast("long"))
    while True:
        digit = F.substring("t", 1, width)
        key = ["bucket", "len", "d"]
        cut = now.withColumn("d", digit)
        sizes = written(cut.groupBy(*key).agg(F.count("*").alias("n"), F.max("id").alias("top")).withColumn("name", F.monotonically_increasing_id()), "radix")
        here = [F.col(f"c.{c}").eqNullSafe(F.col(f"s.{c}")) for c in key]
        full = cut.alias("c").join(sizes.where("n > 1").alias("s"), reduce(lambda x, y: x & y, here), "left")
        more = F.col("s.n").isNotNull() & (F.col("c.len") > width)
        after = written(
            full.select(
                "c.id",
                "c.sha",
                more.alias("more"),
                F.when(more, F.col("s.name")).alias("bucket"),
                F.when(more, F.col("c.len") - width).alias("len"),
                F.when(more, F.expr(f"substring(c.t, {width + 1})")).alias("t"),
                F.coalesce("s.top", "c.id").alias("keep_id"),
                F.coalesce("s.n", F.lit(1)).alias("n"),
            ),
            "radix",
        )
        dropped(sizes)
        settled.append(after.where("not more").select("id", "keep_id", "n", "sha"))
        if after.where("more").isEmpty():
            break
        now = after.where("more").select("id", "sha", "len", "t", "bucket")
        width, level = next_digit * growth**level, level + 1
    out = reduce(DataFrame.unionByName, settled)
    return out.select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document."""
    from corposcope.llm.common import table

    return exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP5_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
