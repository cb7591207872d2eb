"""Measures of research notes and of a package's documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corposcope.functions.text import clean

URL = r"https?://[^\s)>\]]+"


def note_metrics(notes: DataFrame, key: str, markers: Sequence[str] = ("TODO", "FIXME", "XXX")) -> DataFrame:
    """(key, urls, distinct_urls, markers, long_quotes, bytes, big_enough) of each note (key, text): a projection."""
    t = F.coalesce("text", F.lit(""))
    urls = F.regexp_extract_all(t, F.lit(URL), F.lit(0))
    lines = F.split(t, "\n")
    size = F.octet_length(t).cast("long")
    return notes.select(
        key,
        F.size(urls).cast("long").alias("urls"),
        F.size(F.array_distinct(urls)).cast("long").alias("distinct_urls"),
        F.regexp_count(t, F.lit(r"\b(?:" + "|".join(markers) + r")\b")).cast("long").alias("markers"),
        F.size(F.filter(lines, lambda x: F.ltrim(x).startswith(">") & (F.length(x) > 120))).cast("long").alias("long_quotes"),
        size.alias("bytes"),
        (size >= 1200).alias("big_enough"),
    )


def sections(notes: DataFrame, key: str) -> DataFrame:
    """(key, section, bullets, characters): each line belongs to the last `## ` heading before it in its text.

    A fold over the lines of one text, so no shuffle carries lines; then one aggregate.
    """
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    state = F.struct(F.lit("").alias("section"), F.array().cast("array<struct<section: string, line: string>>").alias("rows"))

    def step(acc, line):
        head = line.rlike(r"^## +\S")
        section = F.when(head, F.trim(F.regexp_replace(line, "^## +", ""))).otherwise(acc["section"])
        row = F.struct(section.alias("section"), line.alias("line"))
        return F.struct(section.alias("section"), F.when(head, acc["rows"]).otherwise(F.array_append(acc["rows"], row)).alias("rows"))

    rows = notes.select(key, F.explode(F.aggregate(lines, state, step)["rows"]).alias("r"))
    bullet = F.col("r.line").rlike(r"^\s*[-*]\s+\S")
    return rows.groupBy(key, F.col("r.section").alias("section")).agg(F.count_if(bullet).alias("bullets"), F.sum(F.length("r.line")).cast("long").alias("characters"))


def missing_names(present: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """Expected names that a table lacks."""
    names = present.sparkSession.createDataFrame([(n,) for n in expected], f"{column} string")
    return names.join(present.select(column).distinct(), column, "left_anti")


def rule_checks(rows: DataFrame, gate: str, rules: dict[str, Column]) -> DataFrame:
    """(gate, check, passed) of rules, each an aggregate over the rows; all in one pass."""
    one = rows.agg(*[F.coalesce(c, F.lit(False)).alias(name) for name, c in rules.items()])
    checks = F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("passed")) for n in rules])
    return one.select(F.lit(gate).alias("gate"), F.explode(checks).alias("x")).select("gate", "x.check", "x.passed")


def representatives(rows: DataFrame, key: str, first: str, second: str, k: int) -> DataFrame:
    """(key, rank): the top k by one measure, then those of the top k by another that are new, in that order."""
    of = lambda column, n: rows.orderBy(F.desc(column), key).limit(k).select(key, F.struct(F.lit(n).alias("list"), F.negative(column).cast("double").alias("v"), F.col(key).cast("string").alias("k")).alias("place"))
    return of(first, 0).unionByName(of(second, 1)).groupBy(key).agg(F.min("place").alias("place"))


def author_id(url: Column) -> Column:
    """The author of a profile URL: a query parameter, else the path part after user."""
    u = clean(url)
    given = F.coalesce(F.nullif(F.regexp_extract(u, r"[?&](?:sec_user_id|sec_uid)=([^&#]+)", 1), F.lit("")), F.nullif(F.regexp_extract(u, r"^https?://[^/]+/(?:share/)?user/([^/?#]+)", 1), F.lit("")))
    return given


def error_code(detail: Column) -> Column:
    """A stable code of a detail: the bracketed one if there is one, in lower case, other characters as underscores."""
    inner = F.nullif(F.regexp_extract(detail, r"^\s*\[([^\]]+)\]", 1), F.lit(""))
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(inner, detail))), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def json_pointer(parts: Column) -> Column:
    return F.concat(F.lit("/"), F.array_join(F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))), "/"))


def markdown_escaped(text: Column) -> Column:
    """One line with control characters of Markdown as numeric entities."""
    marks = "\\|[]()`<>#:&!*_~{}"
    return F.array_join(F.transform(F.split(clean(text), ""), lambda c: F.when(F.contains(F.lit(marks), c) & (c != ""), F.concat(F.lit("&#"), F.ascii(c).cast("string"), F.lit(";"))).otherwise(c)), "")
