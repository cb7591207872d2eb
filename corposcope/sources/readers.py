"""Scans. Paths may be on any store that Spark reads."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corposcope.functions.text import iso_time

MAX_CHARS, MAX_TOTAL = 500_000, 5_000_000
# Where item lists stand, and the names of their fields.
LISTS = ("aweme_list", "videos", "items", "list")
IDS, TITLES, TIMES = ("aweme_id", "video_id", "item_id", "id"), ("desc", "title", "description", "caption"), ("create_time", "published_at", "createTime", "timestamp")
STATS = {"like": "digg_count", "favorite": "collect_count", "share": "share_count", "comment": "comment_count"}


class LimitExceeded(ValueError):
    """A text or the corpus has more characters than allowed; nothing is cut."""


def read_corpus(spark: SparkSession, folder: str, max_chars: int = MAX_CHARS, max_total: int | None = MAX_TOTAL, glob: str = "*.txt") -> DataFrame:
    """(artifact_id, text, chars, bytes, sha256, modified) of the text files of a folder; fails beyond the limits."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "^﻿", "")
    rows = files.select(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("artifact_id"), text.alias("text"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified")).withColumn("chars", F.length("text").cast("long"))
    worst = rows.agg(F.max("chars").alias("most"), F.sum("chars").alias("total")).first()
    if (worst["most"] or 0) > max_chars:
        raise LimitExceeded(f"a text has {worst['most']} characters; the limit is {max_chars}")
    if max_total is not None and (worst["total"] or 0) > max_total:
        raise LimitExceeded(f"the corpus has {worst['total']} characters; the limit is {max_total}; {limit_plan(worst['total'], max_total)['batches']} batches would do")
    return rows


def limit_plan(observed: int, limit: int, largest: int = 0, per_text: int | None = None) -> dict[str, int]:
    """Batches that a corpus over its limit needs, and segments that its largest text needs under the limit of a text."""
    return {"batches": max(2, -(-observed // limit)), "segments": max(1, -(-largest // per_text)) if per_text else 1}


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, value): each file one JSON document, without a byte order mark."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.regexp_replace("value", "^﻿", "").alias("value"))


def first_of(value, names: Sequence[str], root: str = "$"):
    """The first non-empty field of a JSON object by alias."""
    return F.coalesce(*[F.nullif(F.get_json_object(value, f"{root}.{n}"), F.lit("")) for n in names])


def page_items(pages: DataFrame, value: str = "value", page: str = "path") -> DataFrame:
    """(page, position, item): the items of the list that scores best for its first ten (id 2, title 1), the first of equal ones."""
    v = F.col(value)
    none = F.array().cast("array<string>")
    lists = [F.coalesce(F.from_json(F.get_json_object(v, f"$.{prefix}{n}"), "array<string>"), none) for prefix in ("data.", "") for n in LISTS]
    lists.append(F.coalesce(F.from_json(v, "array<string>"), none))
    score = lambda xs: F.aggregate(F.slice(xs, 1, 10), F.lit(0), lambda a, x: a + 2 * first_of(x, IDS).isNotNull().cast("int") + first_of(x, TITLES).isNotNull().cast("int"))
    ranked = F.array(*[F.struct(score(xs).alias("score"), F.lit(-k).alias("order"), xs.alias("items")) for k, xs in enumerate(lists)])
    return pages.select(F.col(page).alias("page"), F.posexplode(F.array_max(ranked)["items"]).alias("position", "item"))


def normalised_items(items: DataFrame) -> DataFrame:
    """Items of any known naming as one table; ids default to video-<n>, titles to the id, statistics that are no number to null."""
    x = F.col("item")
    ident = F.coalesce(first_of(x, IDS), F.concat(F.lit("video-"), (F.col("position") + 1).cast("string")))
    stats = [F.coalesce(F.get_json_object(x, f"$.statistics.{field}"), F.get_json_object(x, f"$.stats.{name}")).try_cast("decimal(38,0)").alias(name) for name, field in STATS.items()]
    return items.select("page", "position", ident.alias("platform_video_id"), F.coalesce(first_of(x, TITLES), ident).alias("title"), iso_time(first_of(x, TIMES)).alias("published_at"), F.struct(*stats).alias("stats"), F.coalesce(F.get_json_object(x, "$.video.play_addr.url_list[0]"), F.get_json_object(x, "$.download_url")).alias("download_url"), x.alias("raw"))


def merged_pages(items: DataFrame) -> DataFrame:
    """Items of all pages, the first of each id; items without id are told apart by their text."""
    key = F.coalesce(first_of(F.col("item"), IDS), F.sha2("item", 256))
    first = items.groupBy(key.alias("key")).agg(F.min_by(F.struct("page", "position", "item"), F.struct("page", "position")).alias("r"))
    return first.select("r.*")


def compact_items(items: DataFrame) -> DataFrame:
    from corposcope.operators.hygiene import redacted_url

    return items.drop("raw").withColumn("download_available", F.length(F.trim(F.coalesce("download_url", F.lit("")))) > 0).withColumn("download_url", redacted_url(F.coalesce("download_url", F.lit(""))))


def selected(items: DataFrame, limit: int) -> DataFrame:
    """The newest `limit` by published_at as text, in input order where equal."""
    return items.orderBy(F.desc(F.coalesce("published_at", F.lit(""))), "page", "position").limit(limit)


def table_rows(texts: DataFrame, key: str, aliases: dict[str, Sequence[str]]) -> DataFrame:
    """(key, ordinal, <columns>) of all Markdown tables of a text whose header names them (name -> aliases), in order."""
    kind = dict(texts.dtypes)[key]
    names = list(aliases)

    def cells(line: str) -> list[str] | None:
        bare = line.strip()
        return [c.strip() for c in bare.strip("|").split("|")] if "|" in bare else None

    def columns(head: list[str], rule: list[str] | None) -> list[int | None] | None:
        if not rule or not all(c and set(c) <= set(":-") for c in rule):
            return None
        heads = [h.casefold().replace(" ", "_").replace("-", "_") for h in head]
        where = [next((i for i, h in enumerate(heads) if h in aliases[n]), None) for n in names]
        return None if where[0] is None else where

    def scan(text: str) -> list[list[str | None]]:
        lines = [cells(x) for x in text.splitlines()]
        out: list[list[str | None]] = []
        where, skip = None, False
        for line, below in zip(lines, [*lines[1:], None], strict=False):
            found = columns(line, below) if line else None
            if line is None:
                where = None
            elif found:
                where, skip = found, True
            elif skip:
                skip = False
            elif where:
                out.append([line[i] if i is not None and i < len(line) else None for i in where])
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(ident, n, *r) for ident, text in zip(frame[key], frame["text"], strict=True) for n, r in enumerate(scan(text or ""), 1)]
            yield pd.DataFrame(rows, columns=[key, "ordinal", *names])

    return texts.select(key, "text").mapInPandas(run, f"{key} {kind}, ordinal int, " + ", ".join(f"{n} string" for n in names))


def status_rows(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Log rows by any of their ids, the first row of an id wins."""
    from corposcope.operators.status import keep_first

    ids = F.array_compact(F.array(*[F.nullif(F.col(k).cast("string"), F.lit("")) for k in keys]))
    return keep_first(rows.withColumn("id", F.explode(F.array_distinct(ids))), ["id"], [order])


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes, modified) of all files, from their listing alone."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def read_events(spark: SparkSession, folder: str, schema: str, streaming: bool = False) -> DataFrame:
    """The event log, as a table or (an extension) as a stream."""
    return (spark.readStream if streaming else spark.read).schema(schema).json(folder)


def final_documents(spark: SparkSession, folder: str, suffixes: Sequence[str] = ("md", "txt", "json", "yaml", "yml")) -> DataFrame:
    """(path, bytes, sha256, is_utf8, text) of the text files under a folder, at any depth; hidden files are left out.

    path is relative to the folder. text is null where the bytes are no UTF-8; a byte order mark is dropped.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}").load(folder)
    base = folder.rstrip("/").split("://")[-1].lstrip("/")
    sound = F.is_valid_utf8(F.col("content").cast("string"))
    path = F.regexp_replace(F.substring_index("path", base + "/", -1), "^/+", "")
    return files.select(path.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), sound.alias("is_utf8"), F.when(sound, F.regexp_replace(F.col("content").cast("string"), "^﻿", "")).alias("text"))


def manifests(spark: SparkSession, folder: str, names: Sequence[str], max_bytes: int = 1 << 20) -> DataFrame:
    """(path, state, value) of required JSON files of a folder: missing, too_large, invalid (no JSON object) or ok."""
    wanted = spark.createDataFrame([(n,) for n in names], "path string")
    # the length comes first, so that the content of a large file is never read
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder).select(F.substring_index("path", "/", -1).alias("path"), "length", F.when(F.col("length") <= max_bytes, F.col("content").cast("string")).alias("value"))
    is_object = F.get_json_object("value", "$").isNotNull() & F.ltrim(F.regexp_replace("value", "^﻿", "")).startswith("{")
    state = F.when(F.col("length").isNull(), "missing").when(F.col("length") > max_bytes, "too_large").when(F.coalesce(is_object, F.lit(False)), "ok").otherwise("invalid")
    rows = wanted.join(files, "path", "left").withColumn("state", state)
    return rows.select("path", "state", F.when(F.col("state") == "ok", F.col("value")).alias("value"))


IMPACTS = ("high", "medium", "low")


def entity_dictionary(spark: SparkSession, path: str, max_bytes: int = 1 << 20, max_entities: int = 1000, max_aliases: int = 50) -> DataFrame:
    """(canonical_term, aliases, category, impact, note) of a dictionary file; fails where it breaks its bounds or a rule of its fields."""
    import json

    size = spark.read.format("binaryFile").load(path).select("length").first()[0]
    if size > max_bytes:
        raise LimitExceeded(f"the dictionary has {size} bytes; the limit is {max_bytes}")
    payload = json.loads(spark.read.text(path, wholetext=True).first()[0].removeprefix("﻿"))
    entities = payload.get("entities") if isinstance(payload, dict) else None
    if not isinstance(entities, list) or len(entities) > max_entities:
        raise LimitExceeded(f"the dictionary needs a list of at most {max_entities} entities")
    rows = []
    for n, e in enumerate(entities):
        fields = [e.get(k) for k in ("canonical_term", "category", "impact")] if isinstance(e, dict) else [None]
        aliases = e.get("aliases") if isinstance(e, dict) else None
        fine = all(isinstance(x, str) and x.strip() for x in fields) and isinstance(aliases, list) and len(aliases) <= max_aliases and all(isinstance(x, str) and x.strip() for x in aliases)
        if not fine or not re.fullmatch("[a-z][a-z0-9]*(?:_[a-z0-9]+)*", fields[1]) or fields[2] not in IMPACTS or not isinstance(e.get("note", ""), str):
            raise ValueError(f"entities[{n}] breaks a rule of its fields")
        rows.append((fields[0].strip(), [x.strip() for x in aliases], fields[1], fields[2], e.get("note", "").strip()))
    return spark.createDataFrame(rows, "canonical_term string, aliases array<string>, category string, impact string, note string")


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt over all cores where their scan has fewer parts than there are cores, as one small file has; else as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows._jdf.queryExecution().toRdd().getNumPartitions() < cores else rows
