"""Markdown views of small results. Rows come to the driver, so each view names how many it shows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corposcope.operators.notes import markdown_escaped


def markdown_table(df: DataFrame, limit: int, title: str | None = None) -> str:
    """The first `limit` rows as a table; text is escaped, arrays are joined, numbers stay."""
    cells = [markdown_escaped(F.concat_ws(", ", F.col(f"`{c}`")) if t.startswith("array") else F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))).alias(c) for c, t in df.dtypes]
    rows = df.select(*cells).take(limit)
    lines = [f"| {' | '.join(df.columns)} |", f"|{'---|' * len(df.columns)}"]
    lines += [f"| {' | '.join(r)} |" for r in rows]
    return "\n".join([*([f"## {title}", ""] if title else []), *lines, ""])


def bullet_list(df: DataFrame, column: str, limit: int) -> str:
    return "".join(f"- {r[0]}\n" for r in df.select(markdown_escaped(F.coalesce(F.col(column).cast("string"), F.lit("")))).take(limit))


def transcript_summary(docs: DataFrame, key: str, terms: int = 30) -> DataFrame:
    """(key, chars, sentence_breaks, top_terms) of each text; a key names one text. Terms are counted by text and term, the first few of each text are kept before they are gathered."""
    from corposcope.functions import text

    body = F.coalesce("text", F.lit(""))
    words = docs.select(key, F.explode(text.tokens(body)).alias("term")).groupBy(key, "term").agg(F.count("*").alias("n")).where(text.is_term(F.col("term")))
    ranked = words.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "term"))).where(F.col("place") <= terms)
    best = F.array_sort(F.collect_list(F.struct("place", F.concat("term", F.lit(": "), F.col("n").cast("string")).alias("text"))))
    top = ranked.groupBy(key).agg(F.transform(best, lambda x: x["text"]).alias("top_terms"))
    sizes = docs.select(key, F.length(body).cast("long").alias("chars"), text.sentence_count(body).cast("long").alias("sentence_breaks"))
    return sizes.join(top, key, "left").withColumn("top_terms", F.coalesce("top_terms", F.array().cast("array<string>")))
