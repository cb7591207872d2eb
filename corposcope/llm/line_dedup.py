"""Repeated runs of lines, found by winnowing over line hashes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corposcope.llm.common import dropped, portions, written

WORDS = 5


def spans_of(weights: list[int], least: int) -> set[tuple[int, int]]:
    """The shortest runs [i, j] of `least` words or more, from each line on and up to each line; ends weigh something."""
    out: set[tuple[int, int]] = set()
    i, total = 0, 0
    for j, w in enumerate(weights):
        total += w
        while total - weights[i] >= least:
            total -= weights[i]
            i += 1
        if w and total >= least:
            out.add((i, j))
    j, total = len(weights) - 1, 0
    for i in range(len(weights) - 1, -1, -1):
        total += weights[i]
        while total - weights[j] >= least:
            total -= weights[j]
            j -= 1
        if weights[i] and total >= least:
            out.add((i, j))
    return out


def minima(text: str, least: int = WORDS) -> list[tuple[int, bytes, list[int], list[int], list[tuple[int, int, int, int]]]]:
    """The selected lines of a text: (line, fingerprint, lines before, lines after, windows).

    A window is a shortest run of lines with `least` words; a long line is one by itself. Each window selects the line
    with its smallest hash, the first of equal ones, so equal windows select alike, and two texts that share a run
    of `least` words both select the same line of it. Lines before and after are the hashes of the neighbours, nearest
    first, as far as the windows that selected the line reach. A window is (first line, last line, lines before, lines
    after). Lines are compared without white space at their ends; lines without a word are left out of what is compared.
    """
    lines = [x.strip() for x in text.split("\n")]
    weights = [len(x.split()) for x in lines]
    spans = spans_of(weights, least)
    if not spans:
        return []
    full = [k for k, w in enumerate(weights) if w]
    rank = {k: n for n, k in enumerate(full)}
    marks = {k: xxhash.xxh3_128_digest(lines[k]) for k in full}
    chosen: dict[int, list[tuple[int, int, int, int]]] = {}
    for i, j in sorted(spans):
        low, high = rank[i], rank[j]
        at = min(full[low : high + 1], key=marks.__getitem__)
        chosen.setdefault(at, []).append((i, j, rank[at] - low, high - rank[at]))
    short = lambda k: int.from_bytes(marks[k][:8], "little", signed=True)
    out = []
    for at, found in chosen.items():
        n, b, a = rank[at], max(w[2] for w in found), max(w[3] for w in found)
        out.append((at, marks[at], [short(k) for k in reversed(full[n - b : n])], [short(k) for k in full[n + 1 : n + 1 + a]], found))
    return out


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = WORDS) -> DataFrame:
    """(id, mark, lines) for rows that repeat earlier text: the line numbers to delete, in order.

    A line goes if it is part of a run of lines, `least` words or more in all, that also stands earlier: in a row
    with a smaller id, or further up in the same row without overlap. Empty lines count for nothing in a
    run; one goes if it stands inside a repeated window.
    Null texts have no lines. mark is a hash of the text: rows that repeat an id are told apart by it, and come
    in its order; rows that repeat both are one row to this operator, they lose the same lines. Rows without an id
    neither lose lines nor make others lose them. Other columns are ignored.

    Each row gives its selected lines only (see minima()). Fingerprints that stand at two places or more are joined
    back; the other positions end there. Each position that is left is extended line by line, up and down, to the
    windows that selected it: places are the same where the fingerprint and all lines before and after it are. The
    first place of each is a partial aggregate, so a line that stands in a third of all rows is met once per
    task and no pairs are made; what is joined back is a written table of repeated ones only, which the adaptive join
    can split. A longer repeated run goes whole, as all its lines lie in windows that are repeated.
    """
    kind = dict(docs.dtypes)[id_col]
    columns = ["id", "mark", "print", "before", "after", "windows"]
    window = pa.struct([(c, pa.int32()) for c in ("i", "j", "up", "down")])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            at: list[int] = []
            rows: list[tuple] = []
            for n, text in enumerate(batch.column(2)):
                for _, mark, before, after, found in minima(text.as_py() or "", least):
                    at.append(n)
                    rows.append((mark, before, after, [dict(zip(("i", "j", "up", "down"), w, strict=True)) for w in found]))
            made = list(zip(*rows, strict=True)) if rows else [[]] * 4
            types = (pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(window))
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(at, pa.int64())) for k in (0, 1)], *[pa.array(c, t) for c, t in zip(made, types, strict=True)]], columns)

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    schema = f"id {kind}, mark long, print binary, before array<long>, after array<long>, windows array<struct<i:int,j:int,up:int,down:int>>"
    selected = written(rows.mapInArrow(scan, schema), "selected")
    prints = written(selected.groupBy("print").agg(F.count("*").alias("n"), F.max(F.size("windows")).alias("w")).where("n > 1").select("print"), "prints")
    matched = selected.join(prints, "print").select("id", "mark", "print", "before", "after", F.inline("windows"))
    extended = matched.select("id", "mark", "i", "j", "print", F.expr("slice(before, 1, up)").alias("before"), F.expr("slice(after, 1, down)").alias("after"))
    key = ["print", "before", "after"]
    extended = written(extended, "windows")
    first = written(extended.groupBy(*key).agg(F.min(F.struct("id", "mark", "i", "j")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "windows")
    here, there = F.struct("id", "mark"), F.struct("first.id", "first.mark")
    later = extended.join(first, key).where((here > there) | ((here == there) & (F.col("i") > F.col("first.j"))))
    lines = written(later.groupBy("id", "mark").agg(F.collect_set(F.struct("i", "j")).alias("runs")), "lines")
    dropped(selected, prints, extended, first)
    numbers = F.array_sort(F.array_distinct(F.flatten(F.transform("runs", lambda x: F.sequence(x["i"], x["j"])))))
    return lines.select(F.col("id").alias(id_col), "mark", numbers.alias("lines"))


def without_lines(docs: DataFrame, repeated: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_removed") -> DataFrame:
    """docs with `text_col` less the lines of repeated_lines(), and their number in `count_col`. A row whose lines all go keeps an empty text."""
    gone = repeated.select(F.col(id_col).alias("__id"), F.col("mark").alias("__mark"), F.col("lines").alias("__lines"))
    out = docs.join(gone, (F.col(id_col) == F.col("__id")) & (F.xxhash64(F.col(text_col)) == F.col("__mark")), "left")
    parts = F.split(F.col(text_col), "\n", -1)
    # a text has a mark for each line up to the last that goes, so no line is looked up in a list
    marks = F.expr("split(array_join(transform(__lines, (x, n) -> repeat('0', x - if(n = 0, -1, __lines[n - 1]) - 1) || '1'), ''), '')")
    kept = F.array_join(F.zip_with(parts, marks, lambda line, gone: F.when(F.coalesce(gone, F.lit("0")) != "1", line)), "\n")
    text = F.when(F.col("__lines").isNull(), F.col(text_col)).otherwise(kept)
    return out.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns], F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias(count_col))


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_left_lines, n_removed, kept_sha256 (of the text that is left, null as empty) of every document."""
    from corposcope.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = without_lines(docs, repeated_lines(docs))
    lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0))
    return out.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(lines).alias("n_left_lines").cast("long"), "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
