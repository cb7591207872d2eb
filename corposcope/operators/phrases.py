"""Counts of token windows over a corpus, in slices of the space of their hashes.

A corpus has five windows a token, and nearly all stand in one document only, so rows of them would be many times the
input. Here they are never rows. The tokens are written once, as coded blocks of whole documents. Each of some rounds
makes the windows of one slice again and deals sorted, packed hashes with their documents over buckets; a bucket adds up
its blocks and tells the first block of every repeated phrase its totals. Phrases of the same documents have the same
first block, so which of them are inside another is settled in that block, where their texts are.

The first phrases by documents need less: counts of documents by slots of the hash, a table of fixed size, bound the
documents of every phrase from above. Phrases of the fullest slots are counted exactly, and if enough of them have as
many documents as the emptiest of these slots, no other phrase can come before them.

A phrase is known by 96 bits of hashes of its text, a set of documents by 64 bits within a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corposcope.functions import text
from corposcope.sources.scratch import dropped, written

#: Rounds over the tokens of all but small corpora; the disk that a round takes falls with them. Tokens of a block and windows of a bucket, about.
SLICES, BLOCK_TOKENS, BUCKET_WINDOWS = 8, 400_000, 1_500_000
SHORTEST, LONGEST, LOW, HIGH = 4, 32, 2, 6
#: Phrases of one document set up to which plain search finds those inside another.
FEW = 3000
STOPWORDS = frozenset(text.STOPWORDS)
#: Of first(): bits of a slot; slots that are looked into for each wanted phrase, and times as many after each try; phrases that the driver may be sent.
SLOT_BITS, LIKELY, MORE, SENT = 22, 25, 8, 200_000

BLOCK = "block long, n_tokens long, ids array<string>, words array<string>, codes binary, sizes binary, docs binary, numbers binary"
DEALT = "bucket long, block long, hashes binary, checks binary, total binary, df binary, docs binary, cjk binary, cjk_ids array<string>, cjk_numbers binary, cjk_tokens binary"
TOTALS = "block long, bucket long, at binary, df binary, total binary, docs binary, tokens binary"
SLOTS, SLOT_PARTS = "part long, counts binary", 16
PLACED = "phrase string, df long, total long, docs long, video_id string, n long, n_tokens long"
COUNTED = "phrase string, document_frequency long, total_frequency long, n_tokens long"

U = np.uint64
BASES = U(0x9E3779B97F4A7C15), U(0xD1342543DE82EF95)
SEEDS = U(0x2545F4914F6CDD1D), U(0x5851F42D4C957F2D)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads them."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers by byte planes; the high planes of small ones take no room."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T
    raw = np.ascontiguousarray(planes).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(b: bytes, kind=np.uint32) -> np.ndarray:
    size = int.from_bytes(b[:8], "little")
    raw = np.frombuffer(pa.decompress(b[8:], decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    wide = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(wide, size // wide).T).view(kind).ravel()


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def _is_term(w: str) -> bool:
    """text.is_term() of a string."""
    if w in STOPWORDS:
        return False
    if "一" <= w[:1] <= "鿿":
        return 2 <= len(w) <= 12 and len(set(w)) > 1 and not set(w) <= set(text.FUNCTION_CHARS)
    return 2 <= len(w) <= 64


def _text_hashes(words: list[str], sizes: np.ndarray, checked: bool = True) -> list[np.ndarray]:
    """Two polynomials (one unless checked) over the characters of each word, so that those of joined words follow from theirs."""
    width = max(1, int(sizes.max(initial=0)))
    chars = np.array([w[:width] for w in words], dtype=f"U{width}").view(np.uint32).reshape(len(words), width).astype(U)
    out = []
    for base, seed in zip(BASES[: 1 + checked], SEEDS, strict=False):
        h = np.zeros(len(words), U)
        for j in range(width):
            h = np.where(sizes > j, h * base + _mixed(chars[:, j] + seed), h)
        out.append(h)
    return out


def _keys(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _mixed(first), (_mixed(second) >> U(32)).astype(np.uint32)


def phrase_keys(phrases: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return _keys(*_text_hashes(phrases, np.array([len(p) for p in phrases], np.int64)))


def _slot(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U(64 - bits)).astype(np.int64)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> U(32)) * U(buckets)) >> U(32)


class Block:
    """The tokens of some whole documents."""

    def __init__(self, row: dict):
        self.number, self.ids, self.words = row["block"], row["ids"], row["words"]
        self.codes = _unpacked(row["codes"])
        sizes = _unpacked(row["sizes"])
        self.sentence = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
        self.doc, self.fragment = _unpacked(row["docs"]), _unpacked(row["numbers"])

    def windows(self, keep, checked: bool = True) -> dict[str, np.ndarray]:
        """Hash, check (0 unless checked), place, number of tokens of every window that can be a phrase and whose hash `keep` holds; cjk: joined without spaces."""
        bases = BASES[: 1 + checked]
        c, n = self.codes, len(self.codes)
        visible = np.array([len(w.replace(" ", "")) for w in self.words], np.int64)
        sizes = np.where(visible > LONGEST, 0, np.array([len(w) for w in self.words], np.int64))
        hashes = _text_hashes(self.words, sizes, checked)
        size, cjk = sizes[c], np.array(["一" <= w[:1] <= "鿿" for w in self.words])[c]
        visible, term = visible[c].astype(np.int32), np.array([_is_term(w) for w in self.words])[c].astype(np.int8)
        any_cjk = bool(cjk.any())
        own, power, space = [], [], []
        for base, seed, h in zip(bases, SEEDS, hashes, strict=False):
            powers = np.cumprod(np.concatenate([[U(1)], np.full(int(sizes.max(initial=0)), base, U)]), dtype=U)
            own.append(h[c])
            power.append(powers[size])
            space.append(_mixed(np.array([32], U) + seed)[0])
        spaced, joined = list(own), list(own)
        seen, terms, all_cjk = visible, term, cjk
        found = []
        for k in range(LOW, HIGH + 1):
            m, last = n - k + 1, slice(k - 1, None)
            if m <= 0:
                break
            for i, base in enumerate(bases):
                spaced[i] = (spaced[i][:m] * base + space[i]) * power[i][last] + own[i][last]
                if any_cjk:
                    joined[i] = joined[i][:m] * power[i][last] + own[i][last]
            seen, terms = seen[:m] + visible[last], terms[:m] + term[last]
            all_cjk = all_cjk[:m] & cjk[last]
            at = np.flatnonzero((self.sentence[:m] == self.sentence[last]) & (terms >= 2) & (seen >= SHORTEST) & (seen <= LONGEST))
            pair = [np.where(all_cjk[at], j[at], s[at]) if any_cjk else s[at] for s, j in zip(spaced, joined, strict=True)]
            hashed, check = _keys(*pair) if checked else (_mixed(pair[0]), np.zeros(len(at), np.uint32))
            kept = keep(hashed)
            at = at[kept]
            found.append((hashed[kept], check[kept], at.astype(np.uint32), np.full(len(at), k, np.uint8), all_cjk[at]))
        names = "hash", "check", "at", "tokens", "cjk"
        kinds = U, np.uint32, np.uint32, np.uint8, bool
        return {name: np.concatenate([f[i] for f in found]) if found else np.zeros(0, kind) for i, (name, kind) in enumerate(zip(names, kinds, strict=True))}

    def phrases(self, keep) -> dict[str, np.ndarray]:
        """windows() with their phrase, a number in the order of hash and check; `first` is a window of each phrase."""
        w = self.windows(keep)
        order, new = _grouped(w["hash"], w["check"])
        starts = np.flatnonzero(new)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        return w | {"phrase": number, "first": order[starts], "total": np.diff(np.append(starts, len(order))).astype(np.uint32)}

    def documents(self, w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The phrase and the document of every such pair of phrases(), in this order."""
        pairs = np.sort((w["phrase"].astype(U) << U(32)) | self.doc[w["at"]].astype(U))
        pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]
        return (pairs >> U(32)).astype(np.int64), pairs.astype(np.uint32)

    def last_places(self, w: dict[str, np.ndarray], which: np.ndarray) -> np.ndarray:
        """Of some windows of phrases() the last one of each phrase, by document, fragment and length."""
        place = {x: r for r, x in enumerate(sorted(set(self.ids), key=lambda x: (x is not None, x or "")))}
        rank, at = np.array([place[x] for x in self.ids]), w["at"][which]
        which = which[np.lexsort((w["tokens"][which], self.fragment[at], rank[self.doc[at]], w["phrase"][which]))]
        return which[np.append(w["phrase"][which][1:] != w["phrase"][which][:-1], True)]

    def texts(self, w: dict[str, np.ndarray], which: np.ndarray) -> list[str]:
        words, codes = self.words, self.codes
        return [("" if j else " ").join([words[x] for x in codes[a : a + k]]) for a, k, j in zip(w["at"][which].tolist(), w["tokens"][which].tolist(), w["cjk"][which].tolist(), strict=True)]


def _grouped(hashes: np.ndarray, checks: np.ndarray, *then: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by hash and check, and whether a new pair begins; equal ones are in the order of `then`."""
    order = np.lexsort((*then, hashes)) if then else np.argsort(hashes)
    h, c = hashes[order], checks[order]
    new = np.ones(len(order), bool)
    new[1:] = h[1:] != h[:-1]
    if (~new[1:] & (c[1:] != c[:-1])).any():
        order = np.lexsort((*then, checks, hashes))
        h, c = hashes[order], checks[order]
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    return order, new


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.strip().split(" ") for x in ddl.split(","))])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the fragments of two tokens or more of a partition; rows of a document follow each other."""
    schema, part, made = _schema(BLOCK), TaskContext.get().partitionId(), 0
    words, sizes, docs, numbers, ids, held = [], [], [], [], [], 0

    def block():
        coded = pa.chunked_array(words, pa.string()).combine_chunks()
        coded = (coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded).dictionary_encode()
        each = np.concatenate(sizes)
        per_token = lambda x: _packed(np.repeat(np.array(x, np.uint32), each))
        row = ((part << 33) + made, held, ids, coded.dictionary.to_pylist(), _packed(coded.indices.to_numpy().astype(np.uint32)), _packed(each.astype(np.uint32)), per_token(docs), per_token(numbers))
        return _batch([row], schema)

    last = object()
    for b in batches:
        b = b.filter(pc.greater_equal(pc.list_value_length(b.column("tokens")), 2))  # noqa: PLW2901  here, as Spark would make the tokens twice for it
        lists = b.column("tokens")
        ends, flat = lists.offsets.to_numpy(), lists.values
        begun = 0
        for i, (vid, n) in enumerate(zip(b.column("video_id").to_pylist(), b.column("n").to_pylist(), strict=True)):
            if vid != last:
                if held + int(ends[i] - ends[begun]) >= BLOCK_TOKENS:
                    words.append(flat.slice(ends[begun], ends[i] - ends[begun]))
                    sizes.append(np.diff(ends[begun : i + 1]))
                    held += int(ends[i] - ends[begun])
                    yield block()
                    made, begun = made + 1, i
                    words, sizes, docs, numbers, ids, held = [], [], [], [], [], 0
                last = vid
                ids.append(vid)
            docs.append(len(ids) - 1)
            numbers.append(n)
        rest = b.num_rows
        words.append(flat.slice(ends[begun], ends[rest] - ends[begun]))
        sizes.append(np.diff(ends[begun : rest + 1]))
        held += int(ends[rest] - ends[begun])
    if held:
        yield block()


def blocks(docs: DataFrame, fragments, tokenizer) -> DataFrame:
    """The tokens of all fragments of two tokens or more, written. Rows that repeat an id, if there are any, are one document."""
    again = written(docs.groupBy("video_id").count().where("count > 1").select(F.col("video_id").alias("again")), "again")
    said = fragments(docs)
    if not again.isEmpty():
        same = F.col("video_id").eqNullSafe(F.col("again"))
        many = fragments(docs.join(again, same, "left_semi")).repartition("video_id").sortWithinPartitions("video_id")
        said = fragments(docs.join(again, same, "left_anti")).unionByName(many)
    rows = said.select("video_id", "n", tokenizer(F.col("text")).alias("tokens"))
    out = written(rows.mapInArrow(_blocks, BLOCK), "tokens")
    dropped(again)
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _dealer(low: int, high: int, buckets: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(DEALT)

        def keep(hashes):
            b = _bucket(hashes, buckets)
            return (b >= U(low)) & (b < U(high))

        for row in _rows(batches):
            block = Block(row)
            w = block.phrases(keep)
            if not len(w["hash"]):
                continue
            first = w["first"]
            hashes, checks = w["hash"][first], w["check"][first]
            whose, docs = block.documents(w)
            df = np.bincount(whose, minlength=len(first)).astype(np.uint32)
            cuts = np.searchsorted(_bucket(hashes, buckets), np.arange(low, high + 1).astype(U))
            doc_cuts = np.searchsorted(whose, cuts)
            # of phrases without spaces, which other tokens could give too, the last place
            at = np.flatnonzero(w["cjk"])
            if len(at):
                at = block.last_places(w, at)
            cjk = w["phrase"][at]
            cjk_cuts = np.searchsorted(cjk, cuts)
            out = []
            for i, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if a < z:
                    these = at[cjk_cuts[i] : cjk_cuts[i + 1]]
                    where = w["at"][these]
                    out.append((low + i, block.number, _packed(_steps(hashes[a:z])), _packed(checks[a:z]), _packed(w["total"][a:z]), _packed(df[a:z]), _packed(docs[doc_cuts[i] : doc_cuts[i + 1]]), _packed((w["phrase"][these] - a).astype(np.uint32)), [block.ids[d] for d in block.doc[where]], _packed(block.fragment[where]), _packed(w["tokens"][these])))
            yield _batch(out, schema)

    return deal


def _adder(least_docs: int):
    def add(table: pa.Table) -> pa.Table:
        rows = table.sort_by("block").to_pylist()
        parts, last = [], {}
        for i, r in enumerate(rows):
            hashes, df, docs = np.cumsum(_unpacked(r["hashes"], U), dtype=U), _unpacked(r["df"]), _unpacked(r["docs"])
            ident = _mixed(_mixed(np.array([r["block"]], U) + SEEDS[0]) + docs)
            starts = np.cumsum(df, dtype=np.int64) - df
            parts.append((hashes, _unpacked(r["checks"]), _unpacked(r["total"]).astype(np.int64), df.astype(np.int64), np.add.reduceat(ident, starts), np.full(len(df), i, np.int32), np.arange(len(df), dtype=np.uint32)))
            r["cjk"], r["cjk_numbers"], r["cjk_tokens"] = _unpacked(r["cjk"]), _unpacked(r["cjk_numbers"]), _unpacked(r["cjk_tokens"], np.uint8)
        hashes, checks, total, df, docs, row, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order, new = _grouped(hashes, checks, row)
        starts = np.flatnonzero(new)
        total, df, docs = (np.add.reduceat(x[order], starts) for x in (total, df, docs))
        owner = order[starts]
        if any(len(r["cjk"]) for r in rows):
            group = np.empty(len(order), np.int64)
            group[order] = np.cumsum(new) - 1
            begins = np.searchsorted(row, np.arange(len(rows)))
            for r, begin in zip(rows, begins.tolist(), strict=True):
                for g, vid, n, k in zip(group[begin + r["cjk"].astype(np.int64)].tolist(), r["cjk_ids"], r["cjk_numbers"].tolist(), r["cjk_tokens"].tolist(), strict=True):
                    last[g] = max(last.get(g, ()), (vid is not None, vid or "", n, k))
        tokens = np.zeros(len(starts), np.uint8)
        for g, found in last.items():
            tokens[g] = found[-1]
        kept = np.flatnonzero(df >= least_docs)
        kept = kept[np.lexsort((at[owner[kept]], row[owner[kept]]))]
        out = []
        for these in np.split(kept, np.flatnonzero(np.diff(row[owner[kept]])) + 1):
            if len(these):
                r = rows[row[owner[these[0]]]]
                out.append((r["block"], r["bucket"], _packed(_steps(at[owner[these]])), _packed(df[these]), _packed(total[these]), _packed(docs[these]), _packed(tokens[these])))
        schema = _schema(TOTALS)
        return pa.Table.from_batches([_batch(out, schema)] if out else [], schema=schema)

    return add


def _inside_earlier(phrases: list[str]) -> list[bool]:
    """Of each phrase, whether it is inside one that stands before it."""
    whole = "\n".join(phrases)
    sizes = np.array([len(p) for p in phrases], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    if len(phrases) <= FEW:
        return [whole.find(p) < a for p, a in zip(phrases, starts.tolist(), strict=True)]
    # the first place of each hash among all substrings of its length, in linear time
    chars = _mixed(np.array([whole]).view(np.uint32).astype(U) + SEEDS[0])
    inside = np.zeros(len(phrases), bool)
    by_size = {int(s): np.flatnonzero(sizes == s) for s in np.unique(sizes)}
    h = np.zeros(len(chars), U)
    for size in range(1, int(sizes.max()) + 1):
        h = h[: len(chars) - size + 1] * BASES[0] + chars[size - 1 :]
        which = by_size.get(size)
        if which is None:
            continue
        own = h[starts[which]]
        order = np.argsort(own)
        own, which = own[order], which[order]
        place = np.minimum(np.searchsorted(own, h), len(own) - 1)
        hits = np.flatnonzero(own[place] == h)
        first = np.full(len(own), len(chars), np.int64)
        np.minimum.at(first, place[hits], hits)
        for i, at in zip(which.tolist(), first[np.searchsorted(own, own)].tolist(), strict=True):
            if at < starts[i]:
                inside[i] = whole[at : at + size] == phrases[i] or whole.find(phrases[i]) < starts[i]
    return inside.tolist()


def _outer(rows: list[tuple]) -> list[tuple]:
    """Of (documents' hash, -documents, -tokens, -occurrences, phrase) those of three characters or more that are not inside an earlier one of the same documents."""
    rows = sorted(x for x in rows if len(set(x[4])) > 2)
    out, begin = [], 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i][:2] != rows[begin][:2]:
            group = rows[begin:i]
            out += [r for r, inside in zip(group, _inside_earlier([r[4] for r in group]) if len(group) > 1 else [False], strict=True) if not inside]
            begin = i
    return out


def _settler(buckets: int):
    def settle(tokens: pa.Table, totals: pa.Table) -> pa.Table:
        schema = _schema(COUNTED)
        if not (tokens.num_rows and totals.num_rows):
            return pa.Table.from_batches([], schema=schema)
        block = Block(tokens.to_pylist()[0])
        w = block.phrases(lambda h: slice(None))
        first = w["first"]
        owns = _bucket(w["hash"][first], buckets)
        df, total, k = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64), w["tokens"][first].astype(np.int64)
        docs = np.zeros(len(first), U)
        for r in totals.to_pylist():
            at = int(np.searchsorted(owns, U(r["bucket"]))) + np.cumsum(_unpacked(r["at"]), dtype=np.int64)
            df[at], total[at], docs[at] = _unpacked(r["df"], np.int64), _unpacked(r["total"], np.int64), _unpacked(r["docs"], U)
            known = _unpacked(r["tokens"], np.uint8)
            k[at] = np.where(known > 0, known, k[at])
        # a phrase goes if it is one less its first or last word of the same documents
        gone = df == 0
        one = np.full(len(block.codes) + 1, -1, np.int64)
        for low in range(LOW, HIGH):
            by_place = []
            for n in (low, low + 1):
                these = np.flatnonzero(w["tokens"] == n)
                p = one.copy()
                p[w["at"][these]] = np.where(df[w["phrase"][these]] > 0, w["phrase"][these], -1)
                by_place.append(p)
            for p, q in ((by_place[0], by_place[1]), (by_place[0][1:], by_place[1][:-1])):
                both = (p >= 0) & (q >= 0)
                p, q = p[both], q[both]
                same = (docs[p] == docs[q]) & (df[p] == df[q]) & (k[q] > k[p]) & (w["cjk"][first[p]] == w["cjk"][first[q]])
                gone[p[same]] = True
        left = np.flatnonzero(~gone)
        texts = block.texts(w, first[left])
        del w, owns
        out = _outer(list(zip(docs[left].tolist(), (-df[left]).tolist(), (-k[left]).tolist(), (-total[left]).tolist(), texts, strict=True)))
        columns = [[r[4] for r in out], *([-r[j] for r in out] for j in (1, 3, 2))]
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)

    return settle


def _windows_at_most(tokens: DataFrame) -> int:
    return (tokens.agg(F.sum("n_tokens").alias("n")).first()["n"] or 0) * (HIGH - LOW + 1)


def outermost(tokens: DataFrame, least_docs: int = 2) -> DataFrame:
    """(phrase, document_frequency, total_frequency, n_tokens) of the phrases of `least_docs` documents or more, but those
    inside one of the same documents that ranks before them. Ranks: documents, tokens, occurrences (all descending), phrase.

    The tokens of a phrase are those of its last occurrence, by document, fragment and length.
    """
    spark = tokens.sparkSession
    size = _windows_at_most(tokens)
    rounds = min(SLICES, max(1, -(-size // (4 * BUCKET_WINDOWS))))
    each = max(1, -(-size // (rounds * BUCKET_WINDOWS)))
    parts = []
    for low in range(0, rounds * each, each):
        dealt = tokens.mapInArrow(_dealer(low, low + each, rounds * each), DEALT)
        parts.append(written_once(dealt.groupBy("bucket").applyInArrow(_adder(least_docs), TOTALS), "totals"))
    totals = spark.read.schema(parts[0].schema).parquet(*[p._scratch for p in parts])  # type: ignore[attr-defined]
    return tokens.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(_settler(rounds * each), COUNTED)


def document_bounds(tokens: DataFrame, bits: int) -> np.ndarray:
    """Of each slot of hashes the documents of its phrases, added up: no phrase has more documents than its slot."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        for row in _rows(batches):
            block = Block(row)
            w = block.windows(lambda h: slice(None), checked=False)
            kind = np.uint32 if len(block.ids) << bits < 1 << 32 else U
            once = np.sort((block.doc[w["at"]].astype(kind) << kind(bits)) | _slot(w["hash"], bits).astype(kind))
            once = once[np.append(True, once[1:] != once[:-1])] if len(once) else once
            counts += np.bincount(once & kind((1 << bits) - 1), minlength=1 << bits)
        yield _batch([(i, _packed(x)) for i, x in enumerate(np.split(counts, SLOT_PARTS))], _schema(SLOTS))

    def add(table: pa.Table) -> pa.Table:
        total = sum(_unpacked(x, np.int64) for x in table.column("counts").to_pylist())
        return pa.Table.from_batches([_batch([(table.column("part")[0].as_py(), _packed(total))], _schema(SLOTS))])

    rows = tokens.mapInArrow(count, SLOTS).groupBy("part").applyInArrow(add, SLOTS).collect()
    found = {r["part"]: _unpacked(r["counts"], np.int64) for r in rows}
    return np.concatenate([found[i] for i in range(SLOT_PARTS)]) if found else np.zeros(1 << bits, np.int64)


def _in_slots(tokens: DataFrame, slots: np.ndarray, bits: int, least_docs: int) -> DataFrame:
    """Phrases of some slots that stand in `least_docs` documents or more: documents, occurrences, hash of the documents and the tokens of the last one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, hot = _schema(PLACED), np.zeros(1 << bits, bool)
        hot[slots] = True
        for row in _rows(batches):
            block = Block(row)
            w = block.phrases(lambda h: hot[_slot(h, bits)])
            if not len(w["hash"]):
                continue
            whose, docs = block.documents(w)
            df = np.bincount(whose)
            ident = np.array([int.from_bytes(hashlib.blake2b(repr(x).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for x in block.ids], U)
            sets = np.bitwise_xor.reduceat(ident[docs], np.cumsum(df) - df).view(np.int64)
            last = block.last_places(w, np.arange(len(w["hash"])))
            at = w["at"][last]
            ids = [block.ids[d] for d in block.doc[at].tolist()]
            yield _batch(list(zip(block.texts(w, w["first"]), df.tolist(), w["total"].tolist(), sets.tolist(), ids, block.fragment[at].tolist(), w["tokens"][last].tolist(), strict=True)), schema)

    last = F.max(F.struct("video_id", "n", "n_tokens"))["n_tokens"]  # null is the smallest
    found = tokens.mapInArrow(count, PLACED).groupBy("phrase").agg(F.sum("df").alias("df"), F.sum("total").alias("total"), F.bit_xor("docs").alias("docs"), last.alias("n_tokens"))
    return found.where(F.col("df") >= least_docs)


def first(tokens: DataFrame, limit: int, least_docs: int = 2) -> list[tuple]:
    """The first `limit` rows of outermost() by documents, tokens, occurrences (all descending) and phrase.

    A phrase can only be inside one of as many documents, so those of a number of documents or more settle it among
    themselves. Where the first phrases stand in so few documents that too many slots are as full, all are counted.
    """
    size = _windows_at_most(tokens)
    bits = min(SLOT_BITS, max(8, size.bit_length()))
    bounds = document_bounds(tokens, bits)
    ranked, total = np.sort(bounds)[::-1], int(bounds.sum())
    looked, tried = LIKELY * limit, None
    while True:
        least = max(least_docs, int(ranked[looked - 1])) if 0 < looked <= len(ranked) else least_docs
        looked *= MORE
        if least == tried:
            continue
        tried, slots = least, np.flatnonzero(bounds >= least)
        held = int(bounds[slots].sum())
        if held > SENT * least or held > total // 8 and total > 4 * BUCKET_WINDOWS:
            order = F.desc("document_frequency"), F.desc("n_tokens"), F.desc("total_frequency"), "phrase"
            return [tuple(r) for r in outermost(tokens, least_docs).orderBy(*order).limit(limit).collect()]
        rows = _in_slots(tokens, slots, bits, least).collect()
        rows = sorted(x[1:] for x in _outer([(r["docs"], -r["df"], -r["n_tokens"], -r["total"], r["phrase"]) for r in rows]))
        if len(rows) >= limit or least == least_docs:
            return [(phrase, -df, -n, -k) for df, k, n, phrase in rows[:limit]]


def written_once(df: DataFrame, label: str) -> DataFrame:
    """written(), after which the shuffle files of df go at once, as no other plan reads them."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return written(df, label)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def places(tokens: DataFrame, phrases: list[str]) -> DataFrame:
    """(phrase, video_id, n) of every occurrence of a few phrases."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema("phrase string, video_id string, n long")
        wanted, chosen, near = phrase_keys(phrases)[0], set(phrases), np.zeros(1 << 16, bool)
        near[_slot(wanted, 16)] = True

        def keep(hashes):
            some = np.flatnonzero(near[_slot(hashes, 16)])
            return some[np.isin(hashes[some], wanted)]

        for row in _rows(batches):
            block = Block(row)
            w = block.windows(keep, checked=False)
            texts = block.texts(w, np.arange(len(w["at"])))
            found = [(p, block.ids[block.doc[a]], int(block.fragment[a])) for p, a in zip(texts, w["at"].tolist(), strict=True) if p in chosen]
            if found:
                yield _batch(found, schema)

    return tokens.mapInArrow(find, "phrase string, video_id string, n long")
