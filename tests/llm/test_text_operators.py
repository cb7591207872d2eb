"""Language, quality, personal data, token ids, packing: small fixtures, odd rows, brute force."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from brute import check_packing
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corposcope.llm import lang_id, packing, pii, quality, tokens

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
#: Nulls, empty, blank, no letters, ties, repeats, one long word, a very long text.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "12 34 !!"), (5, "the same text"), (6, "the same text"), (6, "the same text"), (None, "no id"), (7, "x" * 5000), (8, "word and more, " * 9000), (9, "日本語 é ß <|endoftext|> \x1c a\x0bb"), (10, "a@b.co +1 (743) 555-3824")]


@pytest.fixture(scope="module")
def odd(spark):
    """With columns whose names the operators use inside."""
    rows = [(i, t, "en", "clash", 1.0, 5, "x") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double, part int, clean string")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return lang_id.train(docs, lang_id.public_pieces(public_tokenizers.path("piece_bpe_32k.model")), docs_per_lang=30)


def enumerate_all(word, p, index):
    """Sum over all segmentations, by recursion."""
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, len(word) + 1):
        if word[:n] in index:
            total += p[index[word[:n]]] * enumerate_all(word[n:], p, index)
        elif n == 1:
            total += lang_id.UNSEEN * enumerate_all(word[1:], p, index)
    return total


def test_forward_sums_all_segmentations():
    pieces = ["a", "b", "ab", "ba", "▁", "▁a", "aba"]
    index = {x: i for i, x in enumerate(pieces)}
    p = np.array([0.2, 0.1, 0.2, 0.1, 0.1, 0.2, 0.1])
    model = lang_id.PieceModel(["x"], index, p[:, None], np.ones(1))
    for word in ("a", "abab", "bac", "c", "ababab" * 2):
        want = np.log(enumerate_all("▁" + word, p, index))
        assert np.isclose(lang_id.word_scores(["▁" + word], model)[0, 0], want)
        assert np.isclose(lang_id.long_score("▁" + word, model, np.vstack([p[:, None], [[0]]]))[0], want)


def test_piece_table():
    pieces = lang_id.public_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    table = lang_id.PieceTable(pieces)
    for n in (1, 4, 9):
        some = [x for x in pieces if len(x) == n][:500] + ["~" * n]
        ids = lang_id.lattice(some, table)[:, n, n - 1]
        assert [int(i) for i in ids[:-1]] == [pieces.index(x) for x in some[:-1]] and ids[-1] in (table.none, *range(len(pieces)))
    assert (lang_id.lattice(["qzxqj" * 3], table)[0, 15, -1]) == table.none


def test_em_raises_likelihood():
    counts = {"x": {"abab": 5, "aba": 3, "b": 1}}
    pieces = ["▁", "a", "b", "ab", "▁ab", "▁a", "▁b"]

    def likelihood(rounds):
        m = lang_id.fit(counts, pieces, rounds, smooth=1e-9)
        return sum(n * lang_id.word_scores(["▁" + w], m)[0, 0] for w, n in counts["x"].items())

    values = [likelihood(r) for r in (0, 1, 2, 4)]
    assert values == sorted(values) and values[-1] > values[0]


def test_language_held_out(spark, docs):
    got = lang_id.op1_lang_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_language_odd_rows(odd, empty, model):
    got = [(r[0], r[1], r[2]) for r in lang_id.identify(odd, model).collect()]
    assert len(got) == len(ODD)
    by = {i: (lang, score) for i, lang, score in got}
    assert all(by[i] == ("und", 0.0) for i in (1, 2, 3, 4))
    assert all(0 <= s <= 1 for _, s in by.values()) and by[7][0] != "und"
    assert lang_id.identify(empty, model).count() == 0
    kept = lang_id.identify(odd, model, keep=odd.columns, prefix="__")
    assert kept.columns == [*odd.columns, "__lang_pred", "__score"] and kept.count() == len(ODD)
    none = lang_id.train(empty, ["a"])
    assert {r[1] for r in lang_id.identify(odd, none).collect()} == {"und"}


def test_quality_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    got = quality.op2_quality(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.95


def plain_score(model, text):
    """The score by compressing each block of 4 KB anew, with the library's plain objects."""
    import zstandard

    raw = text.encode()
    size = lambda d: sum(len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False).compress(raw[k : k + 4096])) for k in range(0, len(raw), 4096))
    good, bad = size(model.good), size(model.bad)
    return (bad - good) / (bad + good)


def test_quality_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    m = quality.train(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.where("text <> ''").collect()}
    some = sorted(texts)[::9]
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in quality.score(docs, m).collect()}
    for i in some:
        want = 1 / (1 + np.exp(-(m.slope * plain_score(m, texts[i]) + m.offset)))
        assert np.isclose(got[i][0], want, atol=1e-9) and got[i][1] == int(got[i][0] >= 0.5)
    # the curve: no step in any direction gives the fitted texts a better likelihood
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0.1, 0.1, 200), rng.normal(-0.1, 0.1, 150)])
    y = np.repeat([1.0, 0.0], [200, 150])
    slope, offset = quality.calibrated(x, y, ridge=1e-9)

    def likelihood(a, b):
        p = 1 / (1 + np.exp(-(a * x + b)))
        return float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())

    best = likelihood(slope, offset)
    assert all(likelihood(slope + a, offset + b) < best for a, b in ((0.5, 0), (-0.5, 0), (0, 0.05), (0, -0.05), (0.4, 0.04), (-0.4, 0.04)))


def test_quality_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(5, 1), (6, 0), (6, 1), (8, None), (None, 1)], "doc_id long, quality int")
    m = quality.train(odd, labels)
    got = quality.score(odd, m).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert quality.score(empty, quality.train(empty, labels.where("false"))).count() == 0


def brute_spans(text):
    out = [("email", *m.span()) for m in pii.EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in pii.IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, least, most in (("card", pii.CARD, 16, 19), ("phone", pii.PHONE, 8, 15)):
        for m in pattern.finditer(text):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if least <= len(digits) <= most and (kind == "phone" or pii.luhn(digits)):
                out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1230459@.+-() _%é", max_size=60))
def test_base_spans_are_leftmost(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_spans_around_an_anchor_are_whole_in_a_window():
    rng = np.random.default_rng(1)
    for _ in range(100):
        text = "".join(rng.choice(list("ab 1@"), size=400, p=[0.45, 0.3, 0.2, 0.03, 0.02]))
        starts = pii.windows(text)
        assert starts == sorted(set(starts))
        for m in pii.ANCHOR.finditer(text):
            for low in range(max(0, m.start() - pii.STRIDE + 1), m.start() + 1):
                assert any(s <= low and low + pii.STRIDE <= s + pii.WINDOW for s in starts)


def test_gradients_of_tagger():
    tagger = pii.Tagger(hidden=3, width=2, seed=1)
    tagger.w = {k: v.astype(np.float64) for k, v in tagger.w.items()}
    rng = np.random.default_rng(0)
    x = rng.integers(32, 60, (2, 5)).astype(np.int32)
    y = np.array([[0, 1, 2, 0, 3], [0, 0, 5, 6, 0]])
    _, g = tagger.gradients(x, y)
    for name in ("hf", "xb", "out", "step", "first", "cf"):
        w = tagger.w[name]
        at = tuple(0 for _ in w.shape) if name != "step" else (0, 1)
        held = w[at]
        w[at] = held + 1e-3
        up, _ = tagger.gradients(x, y)
        w[at] = held - 1e-3
        down, _ = tagger.gradients(x, y)
        w[at] = held
        assert np.isclose((up - down) / 2e-3, g[name][at], atol=2e-3), name


def test_reconciled_is_best_and_keeps_base():
    base = [("email", 0, 5)]
    found = [("phone", 3, 9), ("phone", 10, 20), ("phone", 10, 20), ("card", 15, 30), ("card", 31, 40)]
    assert pii.reconciled(found, base) == [("phone", 10, 20), ("card", 31, 40)]
    rng = np.random.default_rng(3)
    for _ in range(60):
        found = [("card", int(a), int(a + n)) for a, n in zip(rng.integers(0, 30, 8), rng.integers(1, 9, 8), strict=True)]
        votes = {s: found.count(s) * (s[2] - s[1]) for s in found if not (s[1] < 5 and s[2] > 0)}
        best = 0
        for mask in range(1 << len(votes)):
            some = sorted(s for k, s in enumerate(votes) if mask >> k & 1)
            if all(x[2] <= y[1] for x, y in zip(some, some[1:], strict=False)):
                best = max(best, sum(votes[s] for s in some))
        got = pii.reconciled(found, base)
        assert sum(votes[s] for s in got) == best and all(x[2] <= y[1] for x, y in zip(got, got[1:], strict=False))


def test_held_out_spans_of_the_tagger():
    """Precision and recall of whole spans in labelled windows of another seed."""
    x, y = pii.labelled(400, 99)
    whole = lambda path: {s for s in pii.runs(path) if s[1] > 0 and s[2] < pii.WINDOW}
    got, want = [whole(p) for p in pii.trained().decode(x)], [whole(p) for p in y]
    hits = sum(len(a & b) for a, b in zip(got, want, strict=True))
    assert hits / sum(map(len, got)) > 0.9 and hits / sum(map(len, want)) > 0.9


def test_spans_of_any_length():
    tagger = pii.trained()
    for name in ("christopher.montgomery", "a" * 60, "montgomery." * 12 + "smith"):
        for before in range(0, 200, 17):
            text = "x " * (before // 2) + f"1 {name} (at) mathematics.university (dot) edu"
            start = len("x " * (before // 2)) + 2
            if len(name) < 25 or before in (0, 102):
                assert ("email", start, len(text)) in pii.tag([text], tagger)[0][1], (name, before)


def test_many_spans_in_one_text():
    import time

    text, began = "me (at) host (dot) com, " * 40_000 + "1.2.3.4 " * 60_000, time.process_time()
    base, added = pii.tag([text], pii.trained())[0]
    assert len(base) == 60_000 and len(added) == 40_000 and time.process_time() - began < 90


def test_pii_rows(odd, empty):
    got = {r["doc_id"]: r for r in pii.find_pii(odd, with_text=True).collect()}
    assert got[10]["n_email"] == 1 and got[10]["n_phone"] == 1 and got[10]["spans"] == "email:0:6,phone:7:24"
    assert got[10]["base_sha256"] == hashlib.sha256(b"email:0:6,phone:7:24").hexdigest() and got[10]["clean"] == "<EMAIL> <PHONE>"
    assert got[1]["clean"] is None and got[2]["clean"] == "" and got[5]["spans"] == ""
    assert pii.find_pii(odd, keep=odd.columns, prefix="__", with_text=True).count() == len(ODD)
    assert pii.find_pii(empty).count() == 0


def test_tagger_adds_written_out_forms_and_leaves_clean_text():
    tagger = pii.trained()
    found = pii.tag(["write to john [at] mail [dot] com soon", "Version 2.0 of 2024, 16 pages, CC BY-NC 4.0."], tagger)
    assert found[0][1] == [("email", 9, 33)] and found[1] == ([], [])


def test_tokens_against_library(spark, odd, empty):
    rows = [(i, t) for i, t in enumerate([None, "", "a" * 5000, " " * 300, "it's  we'll\n\n x1 " * 400, "日本語 naïve 😀 " * 300, "a  \t\n b" * 500, "'s'll" * 900, "x " * 1500 + "y" * 2500 + " z" * 900])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk in (1500, 2000, 32768):
        got = {r["doc_id"]: r for r in tokens.encode(df, RANKS, PATTERN, chunk_chars=chunk).collect()}
        for i, t in rows:
            n, ids, raw = tokens.reference_hashes(t, RANKS, PATTERN)
            r = got[i]
            assert (r["n_tokens"], hashlib.sha256(r["ids"]).hexdigest(), hashlib.sha256(r["decoded"]).hexdigest()) == (n, ids, raw), (chunk, i)
    assert tokens.encode(odd, RANKS, PATTERN).count() == len(ODD) and tokens.encode(empty, RANKS, PATTERN).count() == 0
    back = tokens.decode(tokens.encode(df, RANKS, PATTERN).select("doc_id", "ids"), RANKS, PATTERN)
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in back.collect()} == {i: t or "" for i, t in rows}


def test_tokens_of_long_texts_with_repeated_and_null_ids(spark):
    long = [" ".join(f"{x}{k}" for k in range(900)) for x in "abcd"]
    rows = [(1, long[0]), (1, long[1]), (1, long[1]), (None, long[2]), (None, long[3]), (1, "short"), (2, "y" * 4000), (2, "z" * 4000), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["n_tokens"], hashlib.sha256(r["ids"]).hexdigest(), hashlib.sha256(r["decoded"]).hexdigest()) for r in tokens.encode(df, RANKS, PATTERN, chunk_chars=1500).collect()]
    assert sorted(got, key=repr) == sorted(((i, *tokens.reference_hashes(t, RANKS, PATTERN)) for i, t in rows), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab 's\n\té1日.", max_size=120), st.integers(1, 119))
def test_cut_after_visible_boundary_is_lossless(text, at):
    to = tokens.encoder(RANKS, PATTERN)
    for cut in tokens.boundaries(text, PATTERN, 0, len(text)):
        assert to.encode_ordinary(text[:cut]) + to.encode_ordinary(text[cut:]) == to.encode_ordinary(text)
    assert at


def packed_rows(df, **kw):
    return [tuple(r) for r in packing.pack(df, WORDS, **kw).orderBy("doc_id", "start").collect()]


@pytest.mark.parametrize("size,windows,merge", [(2048, 16, 32), (64, 2, 2)])
def test_packing(spark, docs, size, windows, merge):
    from tokenizers import Tokenizer

    of = Tokenizer.from_file(WORDS)
    some = docs.select("doc_id", "text").repartition(9)
    ids = {r["doc_id"]: [*of.encode(r["text"] or "", add_special_tokens=False).ids, packing.END] for r in some.collect()}
    padding = check_packing(packed_rows(some, size=size, windows=windows, merge=merge, slack=size // 128), ids, size)
    assert padding < 0.01


def test_packing_odd_rows(odd, empty):
    rows = packing.pack(odd, WORDS).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in ODD}
    assert sum(r["doc_tokens"] for r in rows if r["doc_id"] == 1) == 1
    assert packing.pack(empty, WORDS).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aB'sé日1. \n\t\x0b\x1c\x1f\xa0<|>endoftx", max_size=80))
def test_word_ids_are_the_tokenizers(text):
    words = packing.word_ids(WORDS)
    want = words.of.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(words([text])[0], "<u4").tolist() == want


def test_word_table_forgets_and_learns_again(docs):
    words = packing.WordIds(WORDS, most=300)
    texts = [r["text"] or "" for r in docs.select("text").limit(60).collect()] + ["Éß-ÀÿX", "Σς Москва naïve", "x" * 500, "日本語" * 40]
    for _ in range(2):
        for at in range(0, len(texts), 8):
            some = texts[at : at + 8]
            assert [np.frombuffer(x, "<u4").tolist() for x in words(some)] == [words.of.encode(t, add_special_tokens=False).ids for t in some]
    assert words.old and max(map(len, words.young)) <= packing.LONGEST


def test_plain_letters_are_split_as_the_tokenizer_does():
    words = packing.WordIds(WORDS)
    for c in map(chr, (*range(33, 127), *range(0xA0, 0x180))):
        for word in (c, c + c, f"a{c}b", f"1{c}", f"{c}'s"):
            assert np.frombuffer(words([word])[0], "<u4").tolist() == words.of.encode(word, add_special_tokens=False).ids, word


def test_packer_takes_a_very_long_text_in_linear_time():
    import time

    began, n = time.process_time(), 20_000_000
    packer = packing.Packer(0, 2048, 16, 16)
    packer.add(1, 0, bytes(4 * n), n)
    rows = packer.taken() + packer.left()
    assert sum(r[2] for r in rows) == n and [r[1] for r in rows] == list(range(0, n, 2048)) and time.process_time() - began < 20
