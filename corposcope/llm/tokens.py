"""Byte-level BPE encoding in overlapping chunks, and decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corposcope.llm.common import dropped, portions, written

#: Characters that a chunk shares with the one after it; the last of a cut-off chunk that the pattern could still change.
OVERLAP, TAIL = 1024, 4


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def splitter(pattern: str):
    import regex

    return regex.compile(pattern)


def boundaries(text: str, pattern: str, low: int, high: int) -> list[int]:
    """Starts of matches within [low, high) that follow a visible character: there a scan of either side alone gives the matches of the whole."""
    out = []
    for m in splitter(pattern).finditer(text):
        at = m.start()
        if at >= high:
            break
        if at >= low and at > 0 and not text[at - 1].isspace():
            out.append(at)
    return out


def packed(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = 32_768) -> DataFrame:
    """(id, n_tokens, ids, decoded) for every row: ids as little-endian unsigned 32-bit integers, decoded as bytes.

    Null text is empty: no ids. Repeated and null ids have rows of their own: long texts are chunked under a
    key that is written with them. A text of up to `chunk_chars` characters
    is one piece. Longer ones are cut into chunks that overlap and are pre-tokenised in parallel; each
    neighbouring pair is stitched at the first pre-token boundary that both found in their overlap, and the
    pieces between these places are encoded in parallel. From a common boundary on, both scans are alike, as
    the pattern looks at nothing before it. A text with an overlap without common boundary (one pre-token
    longer than the overlap) is encoded as one piece.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = F.length("text")
    whole = rows.where(size <= chunk_chars)
    count = F.ceil((size - OVERLAP) / chunk_chars).cast("int")
    keyed = written(rows.where(size > chunk_chars).withColumn("row", F.monotonically_increasing_id()), "long")
    chunks = keyed.select("row", "id", F.posexplode(F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring("text", i * chunk_chars + 1, F.lit(chunk_chars + OVERLAP)))).alias("chunk", "text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            texts = batch.column(3).to_pylist()
            head = [boundaries(t, pattern, 0, OVERLAP) for t in texts]
            tail = [[x - chunk_chars for x in boundaries(t, pattern, chunk_chars, len(t) - TAIL)] for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(head, pa.list_(pa.int32())), pa.array(tail, pa.list_(pa.int32()))], ["row", "id", "chunk", "text", "head", "tail"])

    scanned = chunks.repartition("row", "chunk").mapInArrow(scan, f"row long, id {kind}, chunk int, text string, head array<int>, tail array<int>")
    by_text = Window.partitionBy("row").orderBy("chunk")
    common = lambda a, b: F.array_min(F.array_intersect(a, b))
    cut = scanned.select(
        "row",
        "id",
        "chunk",
        "text",
        F.lead("chunk").over(by_text).isNull().alias("last"),
        F.when(F.col("chunk") == 0, 0).otherwise(common("head", F.lag("tail").over(by_text))).alias("start"),
        common("tail", F.lead("head").over(by_text)).alias("stop"),
    )
    cut = cut.withColumn("stitched", F.min((F.col("start").isNotNull() & (F.col("last") | F.col("stop").isNotNull())).cast("int")).over(Window.partitionBy("row")) == 1)
    # without a common boundary a chunk keeps its own part, to be joined again
    piece = F.when(F.col("stitched"), F.when(F.col("last"), F.expr("substring(text, start + 1)")).otherwise(F.expr(f"substring(text, start + 1, {chunk_chars} + stop - start)")))
    piece = F.coalesce(piece, F.when(F.col("last"), F.col("text")).otherwise(F.substring("text", 1, chunk_chars)))
    cut = written(cut.select("row", "id", "chunk", "stitched", piece.alias("text")), "pieces")
    dropped(keyed)
    joined = cut.where("not stitched").groupBy("row", "id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "text"))), lambda x: x["text"]), "").alias("text")).drop("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = encoder(ranks_path, pattern)
        for batch in portions(batches):
            ids = [to.encode_ordinary(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            raw = [to.decode_bytes(x) for x in ids]
            new = [pa.array([len(x) for x in ids], pa.int64()), pa.array([packed(x) for x in ids], pa.binary()), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], [*batch.schema.names[:-1], "n_tokens", "ids", "decoded"])

    made = "n_tokens long, ids binary, decoded binary"
    pieces = cut.where("stitched").select("row", "id", "chunk", "text").repartition("row", "chunk").mapInArrow(run, f"row long, id {kind}, chunk int, {made}")
    glued = lambda c: F.expr(f"listagg({c}, X'') WITHIN GROUP (ORDER BY chunk)").alias(c)
    long = pieces.groupBy("row", "id").agg(F.sum("n_tokens").alias("n_tokens"), glued("ids"), glued("decoded")).drop("row")
    short = whole.unionByName(joined).mapInArrow(run, f"id {kind}, {made}")
    return short.unionByName(long).withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) for every row: the bytes of its ids, concatenated. Null ids give no bytes; an id outside the ranks is an error."""
    kind = dict(tokens.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = encoder(ranks_path, pattern)
        for batch in portions(batches):
            raw = [to.decode_bytes(np.frombuffer(x.as_py() or b"", "<u4").tolist()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["id", "decoded"])

    return tokens.select(id_col, ids_col).mapInArrow(run, f"id {kind}, decoded binary").withColumnRenamed("id", id_col)


def op10_byte_bpe(spark, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    import public_tokenizers

    from corposcope.llm.common import table

    made = encode(table(spark, sf_dir, "documents"), ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return made.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def reference_hashes(text: str | None, ranks_path: str, pattern: str) -> tuple[int, str, str]:
    """What a row must give, by the library alone; for tests."""
    ids = encoder(ranks_path, pattern).encode_ordinary(text or "")
    return len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
