"""Near-duplicate vectors: spherical k-means cells, blocked cosine products inside the cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corposcope.llm.common import components, dropped, written


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """k unit centroids of the unit rows of x; a cell without rows keeps its centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        cell = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, cell, x)
        norm = np.linalg.norm(total, axis=1)
        c[norm > 0] = total[norm > 0] / norm[norm > 0, None]
    return c


def unit_rows(column) -> np.ndarray:
    """Vectors as unit rows in double precision; scaled first, so that no norm overflows."""
    x = np.stack([np.asarray(v, np.float64) for v in column])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spanning(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the same nodes as all links of the matrix, fewer than it has rows and columns."""
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while root.setdefault(v, v) != v:
            root[v] = v = root[root[v]]
        return v

    out = []
    for i in np.flatnonzero(hit.any(axis=1)):
        a = find(int(left[i]))
        for j in np.unique([find(int(right[n])) for n in np.flatnonzero(hit[i])]):
            b = find(int(j))
            a = find(a)
            if a != b:
                out.append((max(a, b), min(a, b)))
                root[max(a, b)] = min(a, b)
    return out


def cells_of(most: int, max_cells: int) -> int:
    """Half the square root of the rows of the largest label: cells stay worth a visit, and visits fewer than blocks would be."""
    return int(min(max_cells, max(1, np.ceil(np.sqrt(most) / 2))))


def visits(x: np.ndarray, c: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """(home cell of each row, matrix of the cells with larger numbers that may hold a partner within distance r)."""
    near = x @ c.T
    home = np.argmax(near, axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))
    may = near[np.arange(len(x)), home][:, None] - near <= r * apart[home] + 1e-9
    return home, may & (np.arange(len(c))[None, :] > home[:, None])


def vector_links(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", fit_rows: int = 20_000, max_cells: int = 2048, block: int = 2048) -> DataFrame:
    """(id, n_links, component_id, kept) for every row.

    Rows link when their labels are equal and not null and their cosine, in double precision, is
    `least` or more. Null or zero vectors and vectors with a null or non-finite component link with
    nothing, nor do rows without an id or vectors of different length. Rows that repeat an id count as rows of
    their own, whether their vectors are equal or not. Other columns are ignored.

    Equal vectors of a label are one node, under a number that is written with it, that counts for all its rows.
    Spherical k-means, fitted on at most `fit_rows` distinct nodes, gives cells_of() cells, at most `max_cells`, so
    what is sent to the workers is bounded. A node lives in the cell of its closest centroid c. It also visits each
    cell of a larger number whose centroid d has v.(c - d) <= r |c - d|, r = sqrt(2 - 2 least): a node w of that
    cell has w.(d - c) >= 0 and lies within r of v if they link, so of two nodes that link, the one with the smaller
    cell visits the other, and no link is lost or met twice. In every cell and label the visitors and residents meet
    the residents in blocks of about `block` rows; every block pair is its own task group. A group returns link
    counts and a spanning set of its links, never all its pairs.
    """
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)
    fine = usable & F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec_col, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.when(fine, F.col(label_col)).alias("label"), F.when(fine, F.col(vec_col)).alias("v"))
    nodes = written(rows.where("v is not null").groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("times")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    n = nodes.count()
    most = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    r = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-9

    centres: dict[int, np.ndarray] = {}
    if n:
        chance = F.pmod(F.xxhash64("label", "id"), F.lit(1_000_000)) < F.lit(1e6 * min(1.0, fit_rows / n))
        sample = nodes.where(chance).select("id", "v").orderBy(F.xxhash64("id"), "id", "v").limit(fit_rows).toPandas()
        for width, part in sample.groupby(sample["v"].map(len)):
            centres[int(width)] = spherical_kmeans(unit_rows(part["v"]), cells_of(int(most * len(part) / max(1, len(sample))), max_cells))
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for width, part in frame.groupby(frame["v"].map(len)):
                home, may = visits(unit_rows(part["v"]), shared.value.get(int(width), np.eye(1, int(width))), r)
                yield part.assign(width=width, home=home, away=[np.flatnonzero(x) for x in may])

    label, vector = (dict(vectors.dtypes)[c] for c in (label_col, vec_col))
    cells = ["label", "width", "cell"]
    placed = written(nodes.select("label", "node", "times", "v").mapInPandas(place, f"label {label}, node long, times long, v {vector}, width int, home int, away array<int>"), "placed")
    hosts = placed.select("label", "width", F.col("home").alias("cell"), "node")
    guests = hosts.withColumn("resident", F.lit(True)).unionByName(placed.select("label", "width", F.explode("away").alias("cell"), "node", F.lit(False).alias("resident")))
    parts = lambda c: F.greatest(F.lit(1), F.ceil(c / block)).cast("int")
    sizes = guests.groupBy(*cells).agg(parts(F.count("*")).alias("ng"), parts(F.count_if("resident")).alias("nh"), F.count_if("resident").alias("residents"))
    sizes = written(sizes.where("residents > 0").drop("residents"), "cells")
    mine = F.pmod(F.xxhash64("node"), F.lit(1 << 30))
    every = F.array_union(F.array("home"), "away")
    at = placed.select("label", "width", "node", "times", "v", "home", F.explode(every).alias("cell")).withColumn("resident", F.col("home") == F.col("cell")).drop("home").join(sizes, cells)
    guest = at.withColumn("i", F.pmod(mine, F.col("ng")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nh") - 1))).withColumn("guest", F.lit(True))
    host = at.where("resident").withColumn("j", F.pmod(mine, F.col("nh")).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ng") - 1))).withColumn("guest", F.lit(False))
    pairs = guest.unionByName(host).select(*cells, "i", "j", "guest", "resident", "node", "times", "v")

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        guest, host = frame[frame["guest"]], frame[~frame["guest"]]
        if guest.empty or host.empty:
            return pd.DataFrame({"node": [], "n": [], "other": []}).astype({"node": "int64", "n": "int64", "other": "float64"})
        a, b = guest["node"].to_numpy(), host["node"].to_numpy()
        hit = unit_rows(guest["v"]) @ unit_rows(host["v"]).T >= least
        hit &= a[:, None] != b[None, :]
        # two residents meet once from each side, a visitor and a resident only here
        n = hit.astype(np.int64) @ host["times"].to_numpy()
        back = np.where(guest["resident"], 0, guest["times"]) @ hit.astype(np.int64)
        tree = spanning(hit, a, b)
        found = [pd.DataFrame({"node": x[m > 0], "n": m[m > 0], "other": None}) for x, m in ((a, n), (b, back))]
        return pd.concat([*found, pd.DataFrame({"node": [x for x, _ in tree], "n": 0, "other": [y for _, y in tree]})], ignore_index=True)

    found = written(pairs.groupBy(*cells, "i", "j").applyInPandas(meet, "node long, n long, other long"), "links")
    counts = found.where("other is null").groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.where("other is not null").selectExpr("node a", "other b"))
    lowest = roots.join(nodes.select("node", "id"), "node").groupBy("root").agg(F.min("id").alias("component_id"))
    named = roots.join(lowest, "root").select("node", "component_id")
    whole = written(
        nodes.join(counts, "node", "left").join(named, "node", "left").select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")),
        "nodes",
    )
    out = rows.join(whole, ["label", "v"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    dropped(nodes, placed, sizes, found, roots)
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def op3_vectors(spark, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector, at a cosine of 0.98."""
    from corposcope.llm.common import table

    return vector_links(table(spark, sf_dir, "embeddings"))
