"""The stages one after another, each against what it should do to its input."""

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from corposcope.llm import near_dedup, pii

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", None, None, 0), (9003, "123 456", "en", "s", 7), (None, "the one without an id of them all", "en", "s", 3)], base.schema)
    # other columns with names that the stages use inside
    return base.unionByName(odd).withColumn("score", F.lit(0.5)).withColumn("lang_pred", F.lit("x")).withColumn("n_removed", F.lit(1)).withColumn("clean", F.lit("y"))


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "repeated_lines", "near_duplicates", "personal_data", "packed"]


def test_language_keeps_clean_documents(spark, docs):
    out = corpus_pipeline.language(spark, docs, SF)
    assert out.columns == docs.columns
    gone = docs.join(out, "doc_id", "left_anti")
    assert {r["doc_id"] for r in gone.collect()} - {None} == {9001, 9002, 9003}


def test_language_without_labels_keeps_documents_with_letters(spark, docs):
    bare = docs.where("doc_id is null or doc_id < 20 or doc_id > 9000").withColumn("lang", F.lit(None).cast("string"))
    out = corpus_pipeline.language(spark, bare, SF)
    assert out.columns == docs.columns
    want = sorted(((r["doc_id"], r["text"]) for r in bare.collect() if any(c.isalpha() for c in r["text"] or "")), key=repr)
    assert want and sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == want


def test_lines(spark, docs):
    out = corpus_pipeline.repeated_lines(spark, docs, SF)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id is not null and length(text) < 20000").collect()}
    whole = {r["doc_id"]: r["text"] for r in docs.where("doc_id is not null").collect()}
    gone = brute.lines_to_delete(texts) if len(texts) == len(whole) else None
    got = {r["doc_id"]: r for r in out.collect()}
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in got.values())
    if gone is not None:
        for i, t in whole.items():
            want = t if i not in gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in set(gone[i]))
            if i in gone and not want.strip():
                assert i not in got
            else:
                assert got[i]["text"] == want


def test_near_duplicates(spark, docs):
    out = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    rows = docs.select("doc_id", "text").collect()
    want = {(c, next(r["text"] for r in rows if r["doc_id"] == c)) for c in brute.near_classes({r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}).values()}
    assert {(r["doc_id"], r["text"]) for r in out.collect()} == want | {(None, "the one without an id of them all")} and out.count() == len(want) + 1


def test_near_duplicates_null_and_repeated_ids(spark):
    base = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    near = base + " end"
    rows = [(1, base), (1, base), (1, near), (1, other), (2, near), (3, other), (4, "alone in all of them"), (4, "quite another text of one id"), (None, base), (None, "without an id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, df, SF).collect()), key=repr)
    first = [x for x in out if x[1] in (base, near) and x[0] is not None]
    assert len(first) == 1 and first[0][0] == 1
    want = [first[0], (1, other), (4, "alone in all of them"), (4, "quite another text of one id"), (None, base), (None, "without an id")]
    assert out == sorted(want, key=repr)


def test_personal_data(spark, docs):
    out = corpus_pipeline.personal_data(spark, docs, SF)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert not [r for r in out.collect() if pii.base_spans(r["text"] or "")]


def ids_of(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    of = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {i: [*of.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}


def test_packed(spark, docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = [tuple(r) for r in corpus_pipeline.packed(spark, docs, SF).orderBy("doc_id", "start").collect()]
    assert brute.check_packing(rows, ids_of(texts), 2048) < 0.01


def test_whole_run(spark, tmp_path):
    """Every row followed through all stages by plain versions of them; only the language is asked of the stage itself."""
    base = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 4000")
    copy = base.where("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 5000)
    repeated = base.where("doc_id = 30 or doc_id = 31").withColumn("doc_id", F.lit(7000).cast("long"))
    base.unionByName(copy).unionByName(repeated).coalesce(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.language(spark, docs, str(tmp_path)).collect()]
    assert len(kept) > 100
    # rows that repeat an id come in the order of a hash of their text
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    keyed = {(i, hashes[t]): t for i, t in kept}
    gone = brute.lines_to_delete(keyed)
    lines = {k: brute.without(t, gone.get(k, [])) for k, t in keyed.items()}
    lines = {k: t for k, t in lines.items() if k not in gone or t.strip()}
    classes = brute.near_classes(lines)
    best = {}
    for k in lines:
        best[classes[k]] = min(best.get(classes[k], k), k)
    left = {k[0]: lines[k] for k in best.values()}
    tagger = pii.trained()
    clean = {i: pii.masked(t, pii.ordered([s for part in pii.tag([t], tagger)[0] for s in part])) for i, t in left.items()}
    assert len(clean) == len(best) and any(clean[i] != left[i] for i in clean)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert brute.check_packing([tuple(r) for r in out.orderBy("doc_id", "start").collect()], ids_of(clean), 2048) < 0.05
