"""Language identification by segmentation-marginalised unigrams of pieces."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from corposcope.llm.common import id_crc, portions

LETTER = re.compile(r"[^\W\d_]")
#: Words of more characters than this are scored one by one, without a cache.
LONG = 32
#: Probability of a character that no piece covers, alike in every language.
UNSEEN = 1e-7


def public_pieces(path: str) -> list[str]:
    """The pieces of a public sentencepiece model, lower case, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    kept = {model.id_to_piece(i).lower() for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
    return sorted(x for x in kept if len(x) <= 16 and "▁" not in x[1:])


class PieceTable:
    """Looks up many substrings at once: pieces by a 64-bit hash of their characters, in open tables of arrays."""

    PRIME = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: list[str]) -> None:
        self.widest = max(map(len, pieces), default=1)
        self.none = len(pieces)
        left = [(int(h), i) for i, h in enumerate(map(self.hashed, pieces))]
        self.tables: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        shift = 46
        while left:
            keys, values, rest = np.zeros(1 << 18, np.uint64), np.full(1 << 18, self.none, np.int32), []
            for h, i in left:
                slot = h >> shift & 0x3FFFF
                if values[slot] == self.none:
                    keys[slot], values[slot] = h, i
                else:
                    rest.append((h, i))
            self.tables.append((np.uint64(shift), keys, values))
            left, shift = rest, shift - 9 if shift > 9 else 46

    def extended(self, h: np.ndarray, c: np.ndarray) -> np.ndarray:
        h = (h ^ c) * self.PRIME
        return h ^ (h >> np.uint64(29))

    def hashed(self, piece: str) -> np.uint64:
        h = np.full(1, len(piece), np.uint64)
        for c in characters([piece])[0]:
            h = self.extended(h, c)
        return h[0]

    def found(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), self.none, np.int32)
        for shift, keys, values in self.tables:
            slot = (h >> shift & np.uint64(0x3FFFF)).astype(np.int64)
            hit = np.flatnonzero((keys[slot] == h) & (out == self.none))
            out[hit] = values[slot[hit]]
        return out


def characters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, [word, character]."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1).astype(np.uint64)


@dataclass
class PieceModel:
    """p[piece, language]; prior[language]. Pieces mark a word's start by U+2581."""

    langs: list[str]
    index: dict[str, int]
    p: np.ndarray
    prior: np.ndarray

    def __post_init__(self) -> None:
        self.table = PieceTable(list(self.index))
        self.widest = self.table.widest
        #: Words scored so far in this process: word -> row of `rows`.
        self.place: dict[str, int] = {}
        self.rows = np.empty((1 << 12, len(self.langs)))

    def remember(self, scores: np.ndarray) -> None:
        """Puts the scores of the words that were added to `place` last into their rows."""
        used = len(self.place)
        if used > len(self.rows):
            grown = np.empty((2 * used, len(self.langs)))
            grown[: used - len(scores)] = self.rows[: used - len(scores)]
            self.rows = grown
        self.rows[used - len(scores) : used] = scores


def lattice(words: list[str], table: PieceTable) -> np.ndarray:
    """ids[w, end, length - 1] for words of one length; table.none where no piece fits."""
    c = characters(words)
    n = c.shape[1]
    ids = np.full((len(words), n + 1, min(table.widest, n)), table.none, np.int32)
    for size in range(1, min(table.widest, n) + 1):
        h = np.full((len(words), n - size + 1), size, np.uint64)
        for k in range(size):
            h = table.extended(h, c[:, k : n - size + 1 + k])
        ids[:, size:, size - 1] = table.found(h.ravel()).reshape(h.shape)
    return ids


def forward(ids: np.ndarray, p: np.ndarray) -> np.ndarray:
    """alpha[w, position, language]: the sum over all segmentations of each prefix. p has a last row for no piece."""
    n_words, ends, widest = ids.shape
    none = len(p) - 1
    alpha = np.zeros((n_words, ends, p.shape[1]))
    alpha[:, 0] = 1
    for end in range(1, ends):
        for size in range(1, min(widest, end) + 1):
            some = np.flatnonzero(ids[:, end, size - 1] != none)
            if len(some):
                alpha[some, end] += alpha[some, end - size] * p[ids[some, end, size - 1]]
        alone = ids[:, end, 0] == none
        alpha[alone, end] += alpha[alone, end - 1] * UNSEEN
    return alpha


def word_scores(words: list[str], model: PieceModel) -> np.ndarray:
    """log P(word | language) for each word, over all its segmentations."""
    p = np.vstack([model.p, np.zeros(len(model.langs))])
    out = np.empty((len(words), len(model.langs)))
    by_length: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        by_length.setdefault(len(word), []).append(k)
    for n, ks in by_length.items():
        if n > LONG + 1:
            for k in ks:
                out[k] = long_score(words[k], model, p)
            continue
        for at in range(0, len(ks), 1024):
            some = ks[at : at + 1024]
            out[some] = np.log(forward(lattice([words[k] for k in some], model.table), p)[:, -1])
    return out


def long_score(word: str, model: PieceModel, p: np.ndarray) -> np.ndarray:
    """The forward sum over a word of any length, in time linear in it: a ring of sums, rescaled as they shrink."""
    widest = model.widest
    ring, scale = [np.ones(len(model.langs))], np.zeros(len(model.langs))
    for end in range(1, len(word) + 1):
        total = np.zeros(len(model.langs))
        for size in range(1, min(widest, end) + 1):
            i = model.index.get(word[end - size : end])
            if i is not None:
                total = total + ring[-size] * p[i]
            elif size == 1:
                total = total + ring[-1] * UNSEEN
        ring.append(total)
        del ring[:-widest]
        if total.max() < 1e-100:
            down = np.maximum(total, 1e-290)
            ring, scale = [x / down for x in ring], scale + np.log(down)
    return np.log(np.maximum(ring[-1], 1e-290)) + scale


def fit(counts: dict[str, dict[str, int]], pieces: list[str], rounds: int = 3, smooth: float = 0.05) -> PieceModel:
    """Piece probabilities of each language by expectation maximisation over all segmentations.

    counts: language -> word -> occurrences. Starts from equal probabilities; every round counts
    the pieces expected in each word (forward and backward sums) and adds `smooth` to each piece.
    """
    langs = sorted(counts)
    index = {x: i for i, x in enumerate(pieces)}
    table = PieceTable(pieces)
    none = len(pieces)
    p = np.empty((none, len(langs)))
    prior = np.array([max(1, sum(counts[x].values())) for x in langs], float)
    for k, lang in enumerate(langs):
        by_length: dict[int, list[str]] = {}
        for word in sorted(counts[lang]):
            if len(word) <= LONG:
                by_length.setdefault(len(word) + 1, []).append("▁" + word)
        parts = [(lattice(x, table), np.array([counts[lang][w[1:]] for w in x], float)) for _, x in sorted(by_length.items())]
        now = np.full((none + 1, 1), 1.0 / max(1, none))
        now[none] = 0
        for _ in range(rounds):
            expected = np.zeros(none + 1)
            for ids, times in parts:
                a = forward(ids, now)[..., 0]
                ends, wide = ids.shape[1], ids.shape[2]
                b = np.zeros_like(a)
                b[:, -1] = 1
                for start in range(ends - 2, -1, -1):
                    for size in range(1, min(wide, ends - 1 - start) + 1):
                        b[:, start] += b[:, start + size] * now[ids[:, start + size, size - 1], 0]
                    alone = ids[:, start + 1, 0] == none
                    b[alone, start] += b[alone, start + 1] * UNSEEN
                whole = np.maximum(a[:, -1], 1e-300)
                for end in range(1, ends):
                    for size in range(1, min(wide, end) + 1):
                        i = ids[:, end, size - 1]
                        expected += np.bincount(i, a[:, end - size] * now[i, 0] * b[:, end] / whole * times, none + 1)
            expected[none] = 0
            now = np.append((expected[:none] + smooth) / (expected[:none] + smooth).sum(), 0)[:, None]
        p[:, k] = now[:none, 0]
    return PieceModel(langs, index, p, np.full(len(langs), 1 / max(1, len(langs))))


def train(docs: DataFrame, pieces: list[str], docs_per_lang: int = 300, chars_per_doc: int = 20_000) -> PieceModel:
    """Fits on rows with text and lang. The sample is bounded by its two parameters: about
    `docs_per_lang` rows of each language, chosen by a hash of doc_id, `chars_per_doc` characters each."""
    known = docs.where("text is not null and lang is not null").select("doc_id", "lang", "text")
    share = {r["lang"]: min(1.0, docs_per_lang / r["count"]) for r in known.groupBy("lang").count().collect()}
    if not share:
        return fit({}, pieces)
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6
    cut = F.create_map(*[F.lit(x) for pair in sorted(share.items()) for x in pair])[F.col("lang")]
    words = known.where(chance < cut).select("lang", F.explode(F.split(F.lower(F.substring("text", 1, chars_per_doc)), r"\s+")).alias("word"))
    counts: dict[str, dict[str, int]] = {x: {} for x in share}
    for r in words.where("word <> ''").groupBy("lang", "word").count().toLocalIterator():
        counts[r["lang"]][r["word"]] = r["count"]
    return fit(counts, pieces)


def predict(texts: list[str | None], model: PieceModel, cache_words: int = 500_000) -> list[tuple[str, float]]:
    """(language, posterior) of each text."""
    if len(model.place) > cache_words:
        model.place = {}
    place, split, new = model.place, [], []
    for text in texts:
        if text is None or not model.langs or not LETTER.search(text):
            split.append(None)
            continue
        words = text.lower().split()
        wide = None
        if len(max(words, key=len)) > LONG:
            wide = word_scores(["▁" + w for w in words if len(w) > LONG], model).sum(axis=0)
            words = [w for w in words if len(w) <= LONG]
        at = list(map(place.get, words))
        if None in at:
            for w in words:
                if w not in place:
                    place[w] = len(place)
                    new.append("▁" + w)
            at = list(map(place.get, words))
        split.append((at, wide))
    if new:
        model.remember(word_scores(new, model))
    out = []
    for found in split:
        if found is None:
            out.append(("und", 0.0))
            continue
        at, wide = found
        total = np.log(model.prior)
        if wide is not None:
            total = total + wide
        if at:
            total = total + model.rows[np.array(at, np.int64)].sum(axis=0)
        best = int(np.argmax(total))
        out.append((model.langs[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())))
    return out


def identify(docs: DataFrame, model: PieceModel, id_col: str = "doc_id", text_col: str = "text", cache_words: int = 500_000, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """(id, lang_pred, score) for every row, from the whole text alone; with `keep`, those columns instead of the id.
    `prefix` goes before the new names, where kept columns could clash with them.

    lang_pred is `und` with score 0 where the text is null or has no letter, and where the model
    knows no language. score is the posterior of lang_pred under equal priors. Ties go to the
    first language by name. Words are scored once per worker and kept in a bounded cache.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    columns = keep or [id_col]
    names = [*columns, f"{prefix}lang_pred", f"{prefix}score"]
    at = columns.index(text_col) if text_col in columns else len(columns)
    rows = docs.select(*columns, *[text_col] * (text_col not in columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            got = predict(batch.column(at).to_pylist(), shared.value, cache_words)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())], names)

    schema = StructType([*rows.schema.fields[: len(columns)], StructField(names[-2], StringType()), StructField(names[-1], DoubleType())])
    return rows.mapInArrow(run, schema)


def op1_lang_id(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learned from rows that are not held out."""
    import public_tokenizers

    from corposcope.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.pmod(id_crc(), F.lit(5)) == 0
    model = train(docs.where(~held), public_pieces(vocabulary or public_tokenizers.path("piece_bpe_32k.model")))
    return identify(docs, model).withColumn("held_out", held).select("doc_id", "held_out", "lang_pred", "score")
