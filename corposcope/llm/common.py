"""Shared parts of the operators: tables, written intermediate tables, components, hash splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corposcope.sources.readers import spread
from corposcope.sources.scratch import dropped, scope, scratch_path, shared_folder, written

__all__ = ["components", "dropped", "id_crc", "portions", "scope", "scratch_path", "shared_folder", "table", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; a small one, whose file has fewer parts than there are cores, is dealt over all of them."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def id_crc(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary"))


def is_star_forest(edges: DataFrame) -> bool:
    """Whether every edge (a, b) goes straight to a root: no node has two edges up, none has one up and one down."""
    ends = edges.selectExpr("a v", "1 up", "0 down").unionByName(edges.selectExpr("b v", "0 up", "1 down"))
    return ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").where("up > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b), a written table: root is the smallest node reachable.

    Alternating large-star and small-star rounds until every edge is a star's; each round's edges and minima
    are written tables, so a hub's rows can be split by the adaptive skew join. Self loops are ignored.
    """
    now = written(edges.where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct(), "edges")
    while not is_star_forest(now):
        # large star: larger neighbours of every node point to its smallest neighbour
        both = now.unionByName(now.selectExpr("b a", "a b"))
        low = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "low")
        large = written(both.where("b > a").join(low, "a").selectExpr("b a", "m b").where("a <> b").distinct(), "large")
        dropped(low)
        # small star: smaller neighbours and the node itself point to the smallest
        low = written(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").where("b <> m").selectExpr("b a", "m b").unionByName(low.selectExpr("a", "m b")).distinct()
        after = written(small, "edges")
        dropped(now, large, low)
        now = after
    roots = written(now.selectExpr("a node", "b root").unionByName(now.selectExpr("b node", "b root").distinct()), "roots")
    dropped(now)
    return roots


def portions(batches, rows: int = 256, size: int = 4 << 20):
    """Arrow batches cut into at most `rows` rows and about `size` bytes each, so that Python objects made of one stay few."""
    for batch in batches:
        at, each = 0, max(1, min(rows, int(rows * size / max(1, batch.nbytes) * batch.num_rows / rows) if batch.nbytes > size else rows))
        while at < batch.num_rows:
            yield batch.slice(at, each)
            at += each
