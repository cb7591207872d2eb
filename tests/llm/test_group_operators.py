"""Duplicates, lines, vectors, archives, components: brute force on small fixtures, and odd rows."""

import base64
import hashlib
import io
import random
from collections import Counter

import numpy as np
import pytest

import brute
from brute import bags_of, union_find, weighted_jaccard
from corposcope.llm import common, exact_dedup, line_dedup, near_dedup, vectors, warc

SF = "/root/testdata/sf0.001"


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(30)] + [(200, x) for x in range(201, 260)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = union_find({x for p in links for x in p}, links)
    assert all(got.get(v, v) == r for v, r in want.items())
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_groups(spark):
    long = "prefix " * 3000
    texts = [None, "", "Abc", "aBC", "abc ", "É", "é", long + "x", long + "X", long + "y", long, "abc", "a\0b", "A\0B"]
    rows = [(i, t, "n", 1) for i, t in enumerate(texts)] + [(3, "aBC", "n", 1), (None, "abc", "n", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket string, len int")
    norm = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(norm(t), []).append(i)
    for digit in ({}, {"first_digit": 1, "next_digit": 2, "growth": 3}):
        got = exact_dedup.exact_groups(df, **digit).collect()
        want = Counter()
        for t, ids in groups.items():
            top = max(i for i in ids if i is not None)
            for i in ids:
                want[(i, top, len(ids), i == top, hashlib.sha256(t.encode()).hexdigest())] += 1
        assert Counter(tuple(r) for r in got) == want
    assert exact_dedup.exact_groups(df.where("false")).count() == 0


def test_exact_groups_of_repeated_ids_and_equal_tails(spark):
    a, b, tail = "a" * 48, "b" * 48, "the same tail " * 10
    rows = [(None, a + tail), (None, a + tail), (None, b + tail), (None, b + tail), (7, "c" * 48 + tail), (7, "c" * 48 + tail), (7, "d" * 48 + tail), (7, "d" * 48 + tail)]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = Counter((i, i, 2, True, hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    assert Counter(tuple(r) for r in got) == want


def test_line_dedup_brute_force(spark):
    rng = random.Random(5)
    lines = ["a b c d e f", "x", "y z", "one two", "", " x ", "p q r s t", "end"]
    texts = {i: "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9))) for i in range(60)}
    texts |= {100: None, 101: "", 102: "x\nx\nx\nx\nx\nx\nx\nx\nx\nx\nx\nx"}
    df = spark.createDataFrame([(i, t, "l") for i, t in texts.items()], "doc_id long, text string, lines string")
    got = {r["doc_id"]: r["lines"] for r in line_dedup.repeated_lines(df).collect()}
    assert got == brute.lines_to_delete(texts)
    out = {r["doc_id"]: r for r in line_dedup.without_lines(df, line_dedup.repeated_lines(df)).collect()}
    for i, t in texts.items():
        gone = set(got.get(i, []))
        assert out[i]["text"] == (t if not gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone))
    assert line_dedup.repeated_lines(df.where("false")).count() == 0


def test_minima_are_few_and_shared():
    lines = ["one", "two", "three", "four", "five", "six", "seven", "eight"] * 12
    text = "\n".join(f"{x}{k // 8}" for k, x in enumerate(lines))
    found = line_dedup.minima(text)
    assert len(found) < 0.6 * len(lines)
    other = "some other lines\n" + "\n".join(text.split("\n")[20:60])
    assert {m[1] for m in line_dedup.minima(other)} & {m[1] for m in found}
    assert [m[0] for m in line_dedup.minima("a b c d e\n\nv w x y z")] == [0, 2]


def test_fingerprint_decides_where_neighbours_agree(spark):
    # the middle lines differ only, so the lines before and after them are the same in all rows
    rows = [(k, f"top\n{x} {x} {x}\nend") for k, x in enumerate(("a", "c", "a"))]
    got = {r["doc_id"]: r["lines"] for r in line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {2: [0, 1, 2]}


def test_line_dedup_of_repeated_ids(spark):
    line, own = "the first line of some words", "words that stand nowhere else at all"
    rows = [(1, f"{line}\n{own} one"), (2, f"{line}\n{own} two"), (2, f"{own} three\nlast line of the second row"), (2, f"{own} three\nlast line of the second row"), (None, line), (3, line)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r["doc_id"], r["text"], r["n_removed"]) for r in line_dedup.without_lines(df, line_dedup.repeated_lines(df)).collect()), key=repr)
    assert out == sorted([(1, rows[0][1], 0), (2, f"{own} two", 1), (*rows[2], 0), (*rows[3], 0), (None, line, 0), (3, "", 1)], key=repr)


def test_line_dedup_of_a_very_long_text(spark):
    import time

    n = 60_000
    rows = [(1, "\n".join(f"line {k} of the long text\n" for k in range(n))), (2, "own words that no other has\n" + "\n".join(f"line {k} of the long text" for k in range(n)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.time()
    out = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.without_lines(df, line_dedup.repeated_lines(df)).collect()}
    assert out == {1: (rows[0][1], 0), 2: ("own words that no other has", n)} and time.time() - began < 60


def test_shared_passage_goes_from_later_documents_only(spark):
    passage = "\n".join(" ".join(f"w{i}{k}" for k in range(12)) for i in range(5))
    rows = [(1, "first own line here now ok\n" + passage), (2, "second own line is this one\n" + passage + "\nlast words of mine are here"), (3, "a clean document with its own line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["lines"] for r in line_dedup.repeated_lines(df).collect()}
    assert got == {2: [1, 2, 3, 4, 5]}


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    a = {int(k): int(w) for k, w in zip(rng.integers(1, 1 << 60, 40), rng.integers(1, 30, 40), strict=True)}
    b = {k: max(1, w + int(rng.integers(-5, 6))) for k, w in a.items() if rng.random() < 0.8}
    bags = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
    want = near_dedup.overlap(*bags)
    assert np.isclose(want, sum(min(a[k], b.get(k, 0)) for k in a) / sum(max(a[k], b.get(k, 0)) for k in a))
    s = near_dedup.signatures(bags, registers=4096)
    assert abs((s[0] == s[1]).mean() - want) < 0.04
    alone = near_dedup.signatures(bags[1:], registers=4096)
    assert (alone[0] == s[1]).all()


def test_near_groups_brute_force(spark):
    rng = random.Random(8)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 160))] for _ in range(25)]
    texts = {}
    for k in range(120):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(len(words))] = f"e{rng.randrange(999)}"
        texts[k] = " ".join(words)
    texts |= {500: None, 501: "", 502: " ", 503: "one two", 504: "One  two", 505: "one", 506: ""}
    df = spark.createDataFrame([(i, t, "k") for i, t in texts.items()], "doc_id long, text string, key string")
    bags = bags_of(texts)
    links = [(a, b) for a in bags for b in bags if a < b and weighted_jaccard(bags[a], bags[b]) >= 0.8]
    want = union_find(texts, links)
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_dedup.near_groups(df).collect()}
    assert got == {i: (c, c == i) for i, c in want.items()}
    repeated = df.unionByName(df).unionByName(spark.createDataFrame([(None, "one two", "k")], df.schema))
    twice = near_dedup.near_groups(repeated).collect()
    assert len(twice) == 2 * len(texts) + 1 and {(r["doc_id"], r["class_id"]) for r in twice} == {*((i, c) for i, c in want.items()), (None, None)}
    assert near_dedup.near_groups(df.where("false")).count() == 0


def test_near_groups_of_repeated_ids(spark):
    a, z = (" ".join(f"{x}{k}" for k in range(100)) for x in "az")
    rows = [(5, a), (5, z + " more"), (3, z), (5, None), (7, a + " more"), (None, a), (9, "words of one row"), (9, "and of another of the same id")]
    got = sorted((tuple(r) for r in near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(5, 5, True), (5, 3, False), (3, 3, True), (5, 5, True), (7, 5, False), (None, None, True), (9, 9, True), (9, 9, True)], key=repr)


def test_blocks_of_a_large_family(spark, monkeypatch):
    """Many classes in the same buckets, met in blocks of 8 by 8."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(60)]
    texts = {}
    for k in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"x{rng.randrange(99)}"
        texts[k] = " ".join(words)
    bags = bags_of(texts)
    want = union_find(texts, [(a, b) for a in bags for b in bags if a < b and weighted_jaccard(bags[a], bags[b]) >= 0.8])
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == want and len(set(want.values())) > 5


def test_vectors_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(300):
        v = centres[rng.integers(12)] + rng.normal(scale=rng.choice([0.0, 0.05, 0.12, 0.2]), size=16)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(3))))
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [float("nan")] * 16, 1), (904, [None] * 16, 1), (905, rows[0][1], None), (906, [float("inf")] * 16, 2), (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1), (None, rows[1][1], rows[1][2])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<float>, label int, cell int")
    n = {i: 0 for i, _, _ in rows}
    links = []
    for a, x, p in rows:
        for b, y, q in rows:
            if a is not None and b is not None and a < b and p is not None and p == q and x and y and len(x) == len(y) and None not in x + y and np.isfinite(x + y).all() and any(x) and any(y):
                if np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    links.append((a, b))
                    n[a] += 1
                    n[b] += 1
    want = union_find([i for i in n if i is not None], links)
    for kw in ({}, {"block": 16}, {"max_cells": 1, "block": 40}, {"max_cells": 2}):
        got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.vector_links(df, **kw).collect()}
        assert len(got) == len(rows) and len(links) > 100
        assert all(got[i] == (n[i], c, c == i) for i, c in want.items())
        assert got[None][0] == 0
    assert vectors.vector_links(df.where("false")).count() == 0


def test_vectors_of_repeated_ids(spark):
    x, near, far, other = [1.0, 0.0, 0.0], [1.0, 0.05, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(1, x, 0), (1, far, 0), (2, near, 0), (3, other, 0), (3, other, 0), (3, other, 1), (None, x, 0), (None, x, 0)]
    got = sorted((tuple(r) for r in vectors.vector_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()), key=repr)
    assert got == sorted([(1, 1, 1, True), (1, 0, 1, True), (2, 1, 1, False), (3, 1, 3, True), (3, 1, 3, True), (3, 0, 3, True), (None, 0, None, True), (None, 0, None, True)], key=repr)


def test_vectors_go_through_cells(spark, monkeypatch):
    asked = []
    plain = vectors.spherical_kmeans
    monkeypatch.setattr(vectors, "spherical_kmeans", lambda x, k, **kw: asked.append(k) or plain(x, k, **kw))
    assert vectors.op3_vectors(spark, "/root/testdata/sf0.1").count() == 2000
    assert asked and min(asked) > 4


def test_visits_reach_every_partner():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 4))
    x = np.concatenate([x, x + rng.normal(scale=0.06, size=x.shape)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    home, may = vectors.visits(x, vectors.spherical_kmeans(x, 30), np.sqrt(0.04) + 1e-9)
    a, b = np.nonzero(np.triu(x @ x.T >= 0.98, 1))
    low, high = np.where(home[a] <= home[b], a, b), np.where(home[a] <= home[b], b, a)
    apart = home[a] != home[b]
    assert apart.sum() > 20 and may[low[apart], home[high[apart]]].all() and may.mean() < 0.5


@pytest.mark.parametrize("least", [0, 10])
def test_warc_round_trip(spark, least):
    big = "é" * 400_000
    rows = [(1, "http://a/1", "same page"), (2, None, "same page"), (3, "http://a/3\r\nX: y", None), (4, "http://a/4", ""), (5, "u", big), (6, "u", big), (7, "u", "WARC/1.1\r\n\r\n\r\n"), (7, "u", "x"), (None, "u", "same page")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    folder = common.scratch_path(spark, "warc")
    made = warc.with_kinds(df.select("page_id", "url", "html"), least)
    chunks = warc.read_archives(warc.write_archives(made, folder, chunk=100_000), folder, chunk=100_000).collect()
    by = {}
    for r in sorted(chunks, key=lambda r: r["chunk"]):
        by.setdefault((r["record_id"], r["declared_digest"]), []).append(r)
        assert len(r["data"]) <= 100_000
    for i, _, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        parts = by[f"<urn:page:{i}>", digest]
        first = min(k for k, _, h in rows if k is not None and (h or "").encode() == raw)
        revisit = len(raw) >= least and i is not None and i != first
        assert parts[0]["record_type"] == ("revisit" if revisit else "response") and parts[0]["payload_length"] == len(raw)
        if not revisit:
            assert b"".join(bytes(p["data"]) for p in parts) == raw and parts[-1]["digest_so_far"] == digest and parts[-1]["last"]


def test_warc_reader_bounds_what_it_holds():
    import zlib

    body = bytes(range(256)) * 40_000
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    record = warc.head("1", "http://x", "response", None, len(body), warc.bare_sha1(hashlib.sha1(body).digest())) + body + b"\r\n\r\n"
    got = list(warc.records(io.BytesIO(gz.compress(record) + gz.flush()), chunk=1 << 16))
    assert b"".join(r[-1] for r in got) == body and max(len(r[-1]) for r in got) <= 1 << 16 and got[-1][9] == warc.bare_sha1(hashlib.sha1(body).digest())


def test_warc_empty(spark):
    folder = common.scratch_path(spark, "warc")
    pages = warc.with_kinds(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read_archives(warc.write_archives(pages, folder), folder).count() == 0
