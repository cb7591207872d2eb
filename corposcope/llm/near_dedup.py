"""Near duplicates: BagMinHash signatures of word-shingle multisets, bands, and verified multiset overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corposcope.llm.common import components, dropped, portions, written

SHINGLE, LEAST = 5, 0.8
REGISTERS, BANDS = 64, 16
#: Registers that must agree before a pair's texts are compared; a pair of similarity 0.8 has fewer with a probability of 3e-5.
AGREE = 38
#: Nodes on each side of a block of comparisons inside a bucket.
BLOCK = 512
#: Odd constants of the public splitmix64 generator (fixed values).
STEP, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def step(n: int) -> np.uint64:
    return np.uint64(int(STEP) * n & (1 << 64) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of each word; cleared when it has many."""

    def __missing__(self, word: str) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, known: WordHashes) -> np.ndarray:
    """Hashes of all runs of five words (lower case, split at white space), repeats included; a shorter text is one run."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        total = mixed(total * STEP + h[k : len(h) - size + 1 + k])
    return total


def bag(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, and how often each occurs."""
    return np.unique(x, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """BagMinHash: [bag, register] values; two agree in a register with the probability of the bags' weighted Jaccard.

    A shingle of weight w covers [0, w) of its weight axis. The axis is discretised to [0, 1), [1, 2), [2, 4), ...:
    each interval has a Poisson process whose rate is its length, and whose points fall on a weight and a register
    at random; points at weights of w or more do not count. A register keeps its earliest point. Processes are
    followed to a horizon; where a register is still empty or later than that, the bag is done again with twice the horizon.
    """
    out = np.full((len(bags), registers), np.inf)
    horizon = {k: registers * (np.log(registers) + 3) / w.sum() for k, (_, w) in enumerate(bags) if len(w)}
    while horizon:
        some = list(horizon)
        seeds, tops, owners, rates, lows = [], [], [], [], []
        for n, k in enumerate(some):
            e, w = bags[k]
            level, low = 0, 0
            while len(e):
                seeds.append(mixed(e + step(level + 1)))
                tops.append(w)
                owners.append(np.full(len(e), n, np.int64))
                rates.append(np.full(len(e), max(1, low), np.float64))
                lows.append(np.full(len(e), low, np.float64))
                level, low = level + 1, max(1, 2 * low)
                more = w > low
                e, w = e[more], w[more]
        seed, top, owner, rate, base = map(np.concatenate, (seeds, tops, owners, rates, lows))
        until = np.array([horizon[k] for k in some])[owner]
        time, got, turn = np.zeros(len(seed)), np.full(len(some) * registers, np.inf), 0
        while len(seed):
            turn += 1
            a = mixed(seed + step(2 * turn))
            time = time - np.log(((a >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / rate
            live = time <= until
            seed, top, owner, rate, base, until, time = (x[live] for x in (seed, top, owner, rate, base, until, time))
            b = mixed(seed + step(2 * turn + 1))
            weight = base + np.floor((b & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2.0**32 * rate)
            counts = weight < top
            np.minimum.at(got, (owner * registers + ((b >> np.uint64(32)) % np.uint64(registers)).astype(np.int64))[counts], time[counts])
        got = got.reshape(len(some), registers)
        again = {}
        for n, k in enumerate(some):
            if got[n].max() <= horizon[k]:
                out[k] = got[n]
            else:
                again[k] = 2 * horizon[k]
        horizon = again
    return out


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two bags that aren't empty."""
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    both = int(np.minimum(a[1][at], b[1])[a[0][at] == b[0]].sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


SKETCH = ["id", "mark", "key", "bands", "sig"]


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, key, bands, sig): a hash of the text, which tells rows of one id apart, a digest of the bag, band hashes,
    and 16 bits of each register. The last three are null for texts without a word."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in portions(batches):
            if len(known) > 500_000:
                known.clear()
            bags = [bag(shingles(x.as_py(), known)) for x in batch.column(2)]
            sig = signatures(bags)
            bits = mixed(sig.view(np.uint64))
            keys, bands, short = [], [], []
            rows = REGISTERS // BANDS
            for (e, w), s in zip(bags, bits, strict=True):
                keys.append(xxhash.xxh3_128_digest(e.tobytes() + w.tobytes()) if len(e) else None)
                bands.append([xxhash.xxh3_64_intdigest(s[k * rows : (k + 1) * rows].tobytes(), k) - (1 << 63) for k in range(BANDS)] if len(e) else None)
                short.append((s & np.uint64(0xFFFF)).astype("<u2").tobytes() if len(e) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(short, pa.binary())], SKETCH)

    return docs.select(id_col, F.xxhash64(text_col).alias("mark"), text_col).mapInArrow(run, f"id {kind}, mark long, key binary, bands array<long>, sig binary")


def alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of nodes (a, b) whose signatures agree in AGREE registers or more."""
    both = pairs.join(nodes.selectExpr("node a", "sig sa"), "a").join(nodes.selectExpr("node b", "sig sb"), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, REGISTERS) for k in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((x == y).sum(axis=1) >= AGREE))

    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs of nodes (a, b) whose bags overlap by `least` or more, from their whole texts (node, text)."""
    both = pairs.join(texts.selectExpr("node b", "text tb"), "b").join(texts.selectExpr("node a", "text ta"), "a").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last, mine = WordHashes(), None, None
        for batch in portions(batches):
            if len(known) > 500_000:
                known.clear()
            keep = []
            for a, ta, tb in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if mine is None or a != last:
                    last, mine = a, bag(shingles(ta.as_py(), known))
                keep.append(overlap(mine, bag(shingles(tb.as_py(), known))) >= least)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return written(both.mapInArrow(run, "a long, b long"), "links")


def candidates(held: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(guest rows, host rows, registers that agree) of the pairs to compare in a block: one bucket, or a part of it.

    A pair is compared in the first band that it shares. Two guests meet twice, once as guest and host each way,
    and are compared once.
    """
    guest, outside = (held[c].to_numpy(zero_copy_only=False) for c in ("guest", "outside"))
    node = held["node"].to_numpy()
    band, bands = held["band"][0].as_py(), np.array(held["bands"].to_pylist(), np.int64)
    sig = np.frombuffer(b"".join(held["sig"].to_pylist()), "<u2").reshape(-1, REGISTERS)
    g, h = np.flatnonzero(guest), np.flatnonzero(~guest)
    if not len(g) or not len(h):
        return np.empty(0, int), np.empty(0, int), np.empty(0, int)
    fit = np.ones((len(g), len(h)), bool)
    for k in range(int(np.flatnonzero(bands[g[0]] == band)[0])):
        fit &= bands[g, k][:, None] != bands[h, k][None, :]
    agree = np.zeros(fit.shape, np.int16)
    for k in range(REGISTERS):
        agree += sig[g, k][:, None] == sig[h, k][None, :]
    fit &= agree >= AGREE
    fit &= ~outside[h][None, :] | (node[g][:, None] > node[h][None, :])
    i, j = np.nonzero(fit)
    return g[i], h[j], agree[i, j]


def block_links(held: pa.Table, least: float) -> list[tuple[int, int]]:
    """Links of a block that join different classes, from whole texts.

    Pairs that agree most come first, and a pair whose classes have met through other links of the block isn't
    compared; so links come as a spanning set, and the pairs of a large group never leave the task.
    """
    x, y, agree = candidates(held)
    node, roots, texts = (held[c].to_pylist() for c in ("node", "root", "text"))
    up = {v: v for v in roots}

    def find(v):
        while up[v] != v:
            up[v] = v = up[up[v]]
        return v

    known, bags, out = WordHashes(), {}, []
    for k in np.argsort(-agree, kind="stable"):
        ends = int(x[k]), int(y[k])
        p, q = (find(roots[n]) for n in ends)
        if p == q:
            continue
        for n in ends:
            if n not in bags:
                bags[n] = bag(shingles(texts[n], known))
        if overlap(bags[ends[0]], bags[ends[1]]) >= least:
            out.append((max(node[n] for n in ends), min(node[n] for n in ends)))
            up[max(p, q)] = min(p, q)
    return out


def residual_links(members: DataFrame, nodes: DataFrame, roots: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between classes that are still apart in a bucket they share.

    In each such bucket the nodes outside its largest class are guests; they meet all its nodes, in blocks of BLOCK
    by BLOCK, each a task group of its own. The largest class doesn't meet itself, so a bucket costs its size times
    the blocks of its guests. Blocks are gone through twice: first signatures alone tell which nodes have a candidate
    in a block at all, then the texts of these go there.
    """
    placed = members.select("band", "node").join(roots.selectExpr("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = placed.groupBy("band", "root").agg(F.count("*").alias("n"))
    buckets = sizes.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most")).where("all > most")
    parts = lambda c: F.ceil(c / BLOCK).cast("int")
    buckets = written(buckets.select("band", "main", parts(F.col("all") - F.col("most")).alias("ng"), parts(F.col("all")).alias("nh")), "buckets")
    left = placed.join(buckets, "band").join(nodes.select("node", "bands", "sig"), "node").withColumn("outside", F.col("root") != F.col("main"))
    left = written(left.drop("main"), "left")
    mine = F.pmod(F.xxhash64("node"), F.lit(1 << 30))
    guests = left.where("outside").withColumn("i", F.pmod(mine, F.col("ng")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nh") - 1))).withColumn("guest", F.lit(True))
    hosts = left.withColumn("j", F.pmod(mine, F.col("nh")).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ng") - 1))).withColumn("guest", F.lit(False))
    columns = ["band", "i", "j", "guest", "outside", "node", "root", "bands", "sig"]
    blocks = guests.select(*columns).unionByName(hosts.select(*columns))

    def choose(held: pa.Table) -> pa.Table:
        x, y, _ = candidates(held)
        return held.take(pa.array(np.unique(np.concatenate([x, y]))))

    def meet(held: pa.Table) -> pa.Table:
        out = block_links(held, least)
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    kinds = dict(blocks.dtypes)
    chosen = written(blocks.groupBy("band", "i", "j").applyInArrow(choose, ", ".join(f"{c} {kinds[c]}" for c in columns)), "chosen")
    links = written(chosen.join(texts, "node").groupBy("band", "i", "j").applyInArrow(meet, "a long, b long"), "links")
    dropped(left, buckets, chosen)
    return links


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """(id, class_id, kept) for every row: class_id is the smallest id that links of similarity `least` or more reach.

    Similarity is the weighted Jaccard of the multisets of five-word runs. Null texts and texts without a word link
    with nothing; texts of fewer than five words are one run. Rows that repeat an id are rows of their own, grouped
    by their texts; a null id links with nothing. Other columns are ignored.

    Rows with equal multisets are one node, under a number that is written with it. Nodes that share a band (16 bands
    of 4 registers; a pair of similarity 0.8 shares one with a probability of 0.9998) are candidates. First each is
    compared with the smallest node of its buckets. Where a bucket then still holds several classes, its nodes outside
    the largest one meet all others, in blocks; links come out as a spanning set, so no candidate is left out and no
    group is expanded into its pairs.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    made = written(sketches(rows, "id", "text"), "sketches")
    place = F.struct("id", "mark")
    nodes = made.where("key is not null and id is not null").groupBy("key").agg(F.min(place).alias("place"), F.min_by("bands", place).alias("bands"), F.min_by("sig", place).alias("sig"))
    nodes = written(nodes.select("key", "place.*", "bands", "sig", F.monotonically_increasing_id().alias("node")), "nodes")
    bands = nodes.select("node", F.explode("bands").alias("band"))
    shared = written(bands.groupBy("band").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "buckets")
    members = written(bands.join(shared, "band"), "members")
    dropped(shared)
    pairs = members.where("node <> first").selectExpr("first a", "node b").distinct()
    tried = written(alike(pairs, nodes), "pairs")
    # the texts of all nodes that share a bucket, taken from the documents once; a shuffle join at every size,
    # as these nodes are a share of the corpus
    wanted = nodes.select("id", "mark", "node").join(members.select("node").distinct(), "node", "left_semi").hint("merge")
    texts = rows.withColumn("mark", F.xxhash64("text")).join(wanted, ["id", "mark"]).groupBy("id", "mark").agg(F.min("node").alias("node"), F.min("text").alias("text"))
    texts = written(texts.select("node", "text"), "texts")
    links = verified(tried, texts, least)
    roots = components(links)
    more = residual_links(members, nodes, roots, texts, least)
    if not more.isEmpty():
        dropped(roots)
        roots = components(links.unionByName(more))
    lowest = nodes.join(roots, "node").groupBy("root").agg(F.min("id").alias("class_id"))
    named = roots.join(lowest, "root").select("node", "class_id")
    classes = written(nodes.join(named, "node", "left").select("key", F.coalesce("class_id", "id").alias("class_id")), "classes")
    dropped(nodes, members, more, tried, links, texts, roots)
    out = made.select("id", F.expr("if(id is null, null, key)").alias("key")).join(classes, "key", "left").select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("class_id")))


def op8_near_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, class_id, kept of every document, at a similarity of 0.8 of five-word runs."""
    from corposcope.llm.common import table

    return near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
