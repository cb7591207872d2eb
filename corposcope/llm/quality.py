"""Quality by compression: dictionaries of good and of bad text, and the difference in size they give."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corposcope.llm.common import id_crc, portions

BLOCK = 4096
LEVEL = 3


def dictionary(texts: list[str], size: int) -> bytes:
    """A trained zstandard dictionary of texts; their plain bytes where there is too little to train on."""
    blocks = [raw[i : i + 1024] for raw in (t.encode() for t in texts) for i in range(0, len(raw), 1024)]
    try:
        return zstandard.train_dictionary(size, blocks, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(blocks)[:size]


class Sizes:
    """Bytes of a text compressed block by block with one dictionary; blocks are independent, so the dictionary counts in all of them."""

    def __init__(self, raw: bytes) -> None:
        held = zstandard.ZstdCompressionDict(raw)
        if raw:
            held.precompute_compress(level=LEVEL)
        self.to = zstandard.ZstdCompressor(level=LEVEL, dict_data=held if raw else None, write_checksum=False, write_content_size=False, write_dict_id=False)

    def __call__(self, raw: bytes) -> int:
        press = self.to.compress
        return sum(len(press(raw[i : i + BLOCK])) for i in range(0, len(raw), BLOCK))


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float
    #: Score of texts without a byte, and of all texts where one class was not seen.
    base: float

    def scorer(self):
        if not (self.good and self.bad):
            return lambda text: self.base
        good, bad = Sizes(self.good), Sizes(self.bad)

        def score(text: str | None) -> float:
            raw = (text or "").encode("utf-8", "replace")
            return chance(self.slope * difference(raw, good, bad) + self.offset) if raw else self.base

        return score


def difference(raw: bytes, good: Sizes, bad: Sizes) -> float:
    """Positive where the good dictionary compresses better; normalised by both sizes."""
    g, b = good(raw), bad(raw)
    return (b - g) / (b + g)


def chance(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def calibrated(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps."""
    scale = max(float(np.std(x)), 1e-9)
    a = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(steps):
        p = chance(a @ w)
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        w += np.linalg.solve(h, a.T @ (y - p) - ridge * w)
    return float(w[0] / scale), float(w[1])


def fit(good: list[str], bad: list[str], share_good: float, size: int = 64 << 10) -> QualityModel:
    """Dictionaries from the even texts of each class, the curve from the odd ones, weighted to the class shares by its offset."""
    base = float(np.clip(share_good, 0, 1))
    model = QualityModel(dictionary(good[::2], size), dictionary(bad[::2], size), 0.0, 0.0, base)
    held = [(t.encode(), 1.0) for t in good[1::2] if t] + [(t.encode(), 0.0) for t in bad[1::2] if t]
    if not (model.good and model.bad) or len({y for _, y in held}) < 2:
        return QualityModel(b"", b"", 0.0, 0.0, base)
    g, b = Sizes(model.good), Sizes(model.bad)
    x, y = np.array([difference(raw, g, b) for raw, _ in held]), np.array([y for _, y in held])
    model.slope, model.offset = calibrated(x, y)
    seen = y.mean()
    odds = lambda p: np.log(max(p, 1e-6) / max(1 - p, 1e-6))
    model.offset += float(odds(base) - odds(seen))
    return model


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500, chars_per_doc: int = 20_000) -> QualityModel:
    """Fits on labelled rows. The sample is bounded by its parameters: `per_class` rows of each class,
    those with the smallest hash of doc_id, and `chars_per_doc` characters of each. Rows without a
    quality of 0 or 1, or without an id, are left out; an id with both labels counts as good. Rows of documents that
    repeat an id are all used."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    shares = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    of: dict[int, list[str]] = {0: [], 1: []}
    first = lambda y: known.where(F.col("quality") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    rows = docs.where("text <> ''").select("doc_id", F.substring("text", 1, chars_per_doc).alias("text")).join(F.broadcast(first(0).unionByName(first(1))), "doc_id")
    for r in sorted(rows.collect(), key=lambda r: (r["doc_id"], r["text"])):
        of[r["quality"]].append(r["text"])
    return fit(of[1], of[0], shares.get(1, 0) / sum(shares.values()) if shares else 0.5)


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) for every row, from the whole text alone.

    Repeated rows and ids, and rows without an id, have a row each; other columns are ignored. Null and empty texts get the share of label 1 as their score. predicted is 1 from a score of 0.5 on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value.scorer()
        for batch in portions(batches):
            got = [float(of(x.as_py())) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64()), pa.array([int(x >= 0.5) for x in got], pa.int32())], ["id", "score", "predicted"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; learned from labels of rows that are not held out."""
    from corposcope.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.pmod(id_crc(), F.lit(3)) == 1
    model = train(docs, table(spark, sf_dir, "labels").where(~held))
    return score(docs, model).withColumn("held_out", held).select("doc_id", "held_out", "score", "predicted")
