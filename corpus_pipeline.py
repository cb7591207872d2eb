"""The corpus pipeline: language, repeated lines, near duplicates, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corposcope.llm import lang_id, line_dedup, near_dedup, packing, pii
from corposcope.llm.common import dropped, scope, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without text or letters, and those whose language the model can't tell (score under 0.5).

    Where no row has text and a language, there is nothing to learn from, and documents with letters pass.
    """
    import public_tokenizers

    model = lang_id.train(docs, lang_id.public_pieces(public_tokenizers.path("piece_bpe_32k.model")))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = lang_id.identify(docs, model, keep=docs.columns, prefix="__lang_")
    return found.where("__lang_lang_pred <> 'und' and __lang_score >= 0.5").select(*docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes repeated runs of lines; n_chars follows. A document goes if nothing but white space is left of its lines."""
    out = line_dedup.without_lines(docs, line_dedup.repeated_lines(docs), count_col="__n_removed")
    out = out.where((F.col("__n_removed") == 0) | F.col("text").rlike(r"\S"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates, the one with the smallest doc_id; a row without doc_id links with nothing and stays.

    Rows are told apart by a key of their own, written with them, so rows that repeat a doc_id are grouped by their texts.
    """
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    named = rows.where("doc_id is not null")
    groups = near_dedup.near_groups(named, id_col="__row").select("__row", "class_id")
    first = named.select("__row", "doc_id").join(groups, "__row").groupBy("class_id").agg(F.min(F.struct("doc_id", "__row"))["__row"].alias("__row"))
    kept = named.join(first.select("__row"), "__row", "left_semi")
    return kept.unionByName(rows.where("doc_id is null")).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in every text; n_chars follows."""
    clean = pii.find_pii(docs, with_text=True, keep=docs.columns, prefix="__pii_")
    return clean.withColumn("text", F.col("__pii_clean")).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of token ids; a row for each piece."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("repeated_lines", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packed", packed),
]

#: None: the first, fourth and fifth stage can't be expressed in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each stage's rows are written and read again. What a stage wrote for
    itself goes when its rows are written, and those go when the next stage's are."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scope() as kept:
            after = written(stage(spark, docs, sf_dir), name)
            kept.append(after)
        dropped(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
