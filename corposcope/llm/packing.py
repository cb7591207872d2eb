"""Packing of token pieces into sequences by bounded-space online best fit."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corposcope.llm.common import portions, written

END = 1
#: The white space that a tokenizer drops between words and that no word of it can hold.
GAPS = re.compile(r"[ \t\n\r]+")
#: Words whose normal form is their lower case: visible ASCII and the Latin letters of two bytes from U+00C0 to U+00FF.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: The tokenizer's own pattern, for lower-case plain words (fixed value).
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: Longer words aren't kept in the table.
LONGEST = 64

PIECE = "doc_id {0}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordIds:
    """Token ids of texts as bytes, little-endian unsigned 32-bit.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its words in a
    row. Ids of words are kept in a table of two generations: a word that is met moves to the young one; when
    that has `most` words, it becomes the old one and the old one goes. So common words stay, and what is kept
    is bounded. A plain word that is new is split by the tokenizer's pattern and its parts go to the
    tokenizer's model; other new words go through the whole tokenizer.
    """

    def __init__(self, path: str, most: int = 300_000) -> None:
        from tokenizers import Tokenizer

        self.of = Tokenizer.from_file(path)
        self.most = most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        letters = [chr(c) for c in (*range(33, 127), *range(0xC0, 0x100))]
        # how the tokenizer's model sees each character: as one character for each byte
        self.seen = str.maketrans({c: "".join(part for part, _ in self.of.pre_tokenizer.pre_tokenize_str(c)) for c in letters})

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        get, out, late = self.young.get, [], []
        for text in texts:
            if any(x in text for x in SEPARATORS):
                words = [w for w in GAPS.split(text) if w]
            else:
                words = (text.lower() if text.isascii() and "<|" not in text else text).split()
            parts = list(map(get, words))
            if None in parts:
                parts = [self.found(w) if p is None else p for w, p in zip(words, parts, strict=True)]
                if None in parts:
                    late.append((len(out), words, parts))
                    parts = []
            out.append(b"".join(parts))
        new = list(dict.fromkeys(w for _, words, parts in late for w, p in zip(words, parts, strict=True) if p is None))
        learned: dict[str, bytes] = {}
        for at in range(0, len(new), 2048):
            some = new[at : at + 2048]
            for w, e in zip(some, self.of.encode_batch_fast(some, add_special_tokens=False), strict=True):
                learned[w] = np.asarray(e.ids, "<u4").tobytes()
                if len(w) <= LONGEST:
                    self.young[w] = learned[w]
        for k, words, parts in late:
            out[k] = b"".join(learned[w] if p is None else p for w, p in zip(words, parts, strict=True))
        return out

    def found(self, word: str) -> bytes | None:
        """Ids of a word that the young table may lack; None where only the whole tokenizer can tell."""
        ids = self.young.get(word) or self.old.get(word)
        if ids is None:
            if not PLAIN.fullmatch(word) or "<|" in word:
                return None
            parts = PARTS.findall(word.lower())
            if len(parts) == 1:
                ids = np.asarray([t.id for t in self.of.model.tokenize(parts[0].translate(self.seen))], "<u4").tobytes()
            else:
                ids = b"".join(map(self.found, parts))
        if len(word) <= LONGEST:
            self.young[word] = ids
        return ids


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One table for all tasks of a worker process."""
    return WordIds(path)


#: What str.split() takes as white space and the tokenizer does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"


@dataclass
class Open:
    """A sequence that is not closed: its pieces as (doc_id, start, ids, doc_tokens)."""

    used: int = 0
    pieces: list[tuple] = field(default_factory=list)


class Packer:
    """Keeps `windows` open sequences of `size` ids. A piece goes where least room is left after it; where it fits in
    none, the fullest is emitted: with its room filled from the piece if that is more than `slack`, else padded."""

    def __init__(self, base: int, size: int, windows: int, slack: int) -> None:
        self.size, self.windows, self.slack, self.next = size, windows, slack, base
        self.open: list[Open] = []
        self.rows: list[tuple] = []

    def add(self, doc, start: int, ids: bytes, total: int) -> None:
        whole = len(ids) // 4 // self.size
        for at in range(whole):
            self.emit(Open(self.size, [(doc, start + at * self.size, ids[4 * at * self.size : 4 * (at + 1) * self.size], total)]))
        rest = ids[4 * whole * self.size :]
        if rest:
            self.place(doc, start + whole * self.size, rest, len(rest) // 4, total)

    def place(self, doc, start: int, ids: bytes, n: int, total: int) -> None:
        fits = [w for w in self.open if w.used + n <= self.size]
        if not fits and len(self.open) < self.windows:
            fits = [Open()]
            self.open += fits
        if not fits:
            full = max(self.open, key=lambda w: w.used)
            self.open.remove(full)
            room = self.size - full.used
            if room > self.slack:
                full.pieces.append((doc, start, ids[: 4 * room], total))
                full.used += room
                ids, start, n = ids[4 * room :], start + room, n - room
            self.emit(full)
            fits = [w for w in self.open if w.used + n <= self.size] or [Open()]
            if not fits[0].used:
                self.open += fits
        best = max(fits, key=lambda w: w.used)
        best.pieces.append((doc, start, ids, total))
        best.used += n
        if best.used == self.size:
            self.open.remove(best)
            self.emit(best)

    def emit(self, w: Open) -> None:
        offset = 0
        for doc, start, ids, total in w.pieces:
            self.rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, self.next, offset, None))
            offset += len(ids) // 4
        self.next += 1

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows

    def left(self) -> list[tuple]:
        """Open sequences as rows: their ids go along, for they may be cut again."""
        return [(doc, start, len(ids) // 4, zlib.crc32(ids), total, None, k, ids) for k, w in enumerate(self.open) for doc, start, ids, total in w.pieces]

    def close(self) -> None:
        """Ends with no padding but in powers of two: what is left is filled up in order, the rest cut into such lengths."""
        rest = [p for w in sorted(self.open, key=lambda w: -w.used) for p in w.pieces]
        self.open = []
        have = sum(len(p[2]) // 4 for p in rest)
        while have:
            want = self.size if have >= self.size else 1 << (have.bit_length() - 1)
            w = Open()
            while w.used < want:
                doc, start, ids, total = rest.pop(0)
                n = min(want - w.used, len(ids) // 4)
                w.pieces.append((doc, start, ids[: 4 * n], total))
                w.used += n
                if n < len(ids) // 4:
                    rest.insert(0, (doc, start + n, ids[4 * n :], total))
            self.emit(w)
            have -= want


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def to_batch(rows: list[tuple], part: int, like: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(NAMES)
    types = [like, *[pa.int64()] * 6, pa.binary()]
    return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(columns, types, strict=True)], pa.array([part] * len(rows), pa.int64())], [*NAMES, "part"])


def repacked(level: int, last: bool, size: int, windows: int, slack: int):
    """Packs the open sequences of a group of partitions; the last group closes."""

    def again(key: tuple, held: pa.Table) -> pa.Table:
        group = key[0].as_py()
        packer = Packer(level * LEVEL + group * GROUP, size, windows, slack)
        order = [(c, "ascending") for c in ("part", "offset", "doc_id", "start")]
        for r in held.sort_by(order).select(["doc_id", "start", "ids", "doc_tokens"]).to_pylist():
            packer.add(r["doc_id"], r["start"], r["ids"], r["doc_tokens"])
        if last:
            packer.close()
        return pa.Table.from_batches([to_batch(packer.taken() + packer.left(), group, held.schema.field("doc_id").type)])

    return again


#: Sequence ids: the level of the merge, the group there, and a count within it.
LEVEL, GROUP = 1 << 58, 1 << 32


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, windows: int = 16, slack: int = 16, merge: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row for each piece.

    Null text is empty: its row is the end id alone. Repeated rows are packed each. Every partition of the
    input packs its rows as they come, with `windows` open sequences at most; emitted sequences are final.
    What stays open goes, ids and all, to groups of `merge` partitions, which pack it likewise, until one
    group is left; that closes the last ones without padding. A task holds `merge` x `windows` sequences at most.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        packer, words, like = Packer(part * GROUP, size, windows, slack), word_ids(tokenizer_path), None
        end = np.asarray([END], "<u4").tobytes()
        for batch in portions(batches):
            like = batch.column(0).type
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for doc, ids in zip(batch.column(0).to_pylist(), words(texts), strict=True):
                packer.add(doc, 0, ids + end, len(ids) // 4 + 1)
            yield to_batch(packer.taken(), part, like)
        if like is not None:
            yield to_batch(packer.left(), part, like)

    schema = PIECE.format(kind) + ", ids binary, part long"
    now = written(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema), "packed")
    out, level = [now.where("sequence_id is not null")], 0
    while True:
        left = now.where("sequence_id is null")
        groups = left.agg(F.max(F.floor(F.col("part") / merge))).first()[0]
        if groups is None:
            break
        level += 1
        last = groups == 0

        now = written(left.withColumn("group", F.floor(F.col("part") / merge)).groupBy("group").applyInArrow(repacked(level, last, size, windows, slack), schema), "packed")
        out.append(now.where("sequence_id is not null"))
        if last:
            break
    total = out[0]
    for more in out[1:]:
        total = total.unionByName(more)
    return total.drop("ids", "part").withColumnRenamed("doc_id", id_col)


def op7_packing(spark, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece of every document, in sequences of 2048 ids."""
    import public_tokenizers

    from corposcope.llm.common import table

    return pack(table(spark, sf_dir, "documents"), tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))
