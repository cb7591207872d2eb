"""Small rules over rows: bounds, codes, cases, limits, timelines, diagnostics, and search in nested JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corposcope.operators.hygiene import is_bad_profile_value
from corposcope.sources.scratch import written

# Fixed values.
LANGUAGES = {"zh-cn": "zh", "zh_cn": "zh", "cn": "zh"}
METADATA_PREFIXES = ("metadata:", "metadata/", "metadata_", "元数据:", "元数据：", "元数据/")
TRANSCRIPT_FIELDS = ("script_templates", "expression_dna", "judgment_heuristics", "anti_patterns", "script_style")
BOUNDARY_SAFE = r"(?i)不得|不能|不会|拒绝|无法|不代表|不冒充|边界|安全|合规|cannot|refus|must\s+not"
NEGATIVE_TRACE = r"(?i)不可追溯|无法追溯|未通过|不通过|untraceable|not\s+traceable|fail"
POSITIVE_TRACE = r"(?i)可追溯|通过|成立|traceable|creator[_ -]?specific|pass"
CODES = (
    "NETWORK_TIMEOUT", "RATE_LIMIT", "PROVIDER_UNAVAILABLE", "INVALID_MEDIA", "ASR_PARSE_FAILED", "STALE_ARTIFACT", "INVALID_JSON", "INVALID_INPUT",
    "WORKFLOW_STATE_ERROR", "QUALITY_GATE_FAILED", "MISSING_TRANSCRIPTS", "DOWNLOAD_FAILED", "AUDIO_EXTRACTION_FAILED", "ASR_FAILED", "STEP_FAILED", "UNEXPECTED_ERROR",
)
DETAILS = {
    "NETWORK_TIMEOUT": ("NETWORK_CONNECTION_ERROR", "PROVIDER_CONNECT_TIMEOUT", "CONNECT_TIMEOUT", "READ_TIMEOUT", "CONNECTION_ERROR"),
    "PROVIDER_UNAVAILABLE": ("HTTP_SERVER_ERROR",),
    "INVALID_MEDIA": ("DOWNLOAD_EMPTY", "DOWNLOAD_TOO_LARGE", "DOWNLOAD_CONTENT_REJECTED"),
    "ASR_PARSE_FAILED": ("ASR_PARSE_ERROR", "TRANSCRIPT_MERGE_ERROR"),
    "STALE_ARTIFACT": ("ARTIFACT_STALE", "FINGERPRINT_MISMATCH"),
    "INVALID_JSON": ("JSON_DECODE_ERROR",),
    "INVALID_INPUT": ("INPUT_VALIDATION_ERROR", "ARGUMENT_TYPE_ERROR"),
    "WORKFLOW_STATE_ERROR": ("WORKFLOW_CORRUPT",),
}
URL_KEYS = ("url", "download_url", "play_url", "play_addr", "url_list", "uri", "src")
AUTHOR_KEYS = {
    "nickname": ("nickname", "owner_nickname", "author_name", "display_name", "name"),
    "handle": ("unique_id", "owner_handle", "short_id", "handle"),
    "author_id": ("uid", "user_id", "author_id", "owner_id"),
    "sec_uid": ("sec_uid", "sec_user_id"),
}
AUTHOR_HOLDERS = ("author", "user", "music", "account", "creator")


def language(name: Column) -> Column:
    """A language name in lower case, Chinese ones as zh."""
    low = F.lower(F.trim(name))
    return F.coalesce(*[F.when(low == k, v) for k, v in LANGUAGES.items()], low)


def bounded_int(value: Column, low: int, high: int) -> Column:
    """Whole numbers within bounds, null for anything else."""
    text = F.trim(value)
    n = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("long"))
    return F.when(n.between(low, high), n)


def bounded_float(value: Column, low: float, high: float) -> Column:
    """Finite numbers within bounds, null for anything else."""
    n = F.trim(value).try_cast("double")
    return F.when(~F.isnan(n) & n.between(low, high), n)


def is_metadata_role(role: Column) -> Column:
    plain = F.replace(F.lower(F.trim(F.coalesce(role, F.lit("")))), F.lit("-"), F.lit("_"))
    return reduce(Column.__or__, [plain.startswith(p) for p in METADATA_PREFIXES], plain.isin("metadata", "元数据"))


def needs_transcript(fields: Column) -> Column:
    """Whether any field name holds a mark of the fields that rest on transcripts."""
    return F.coalesce(F.exists(fields, lambda f: F.lower(f).rlike("|".join(TRANSCRIPT_FIELDS))), F.lit(False))


def nonempty(items: Column) -> Column:
    """An array of JSON texts without null, empty text, empty list and empty object."""
    return F.coalesce(F.filter(items, lambda x: x.isNotNull() & ~F.trim(x).isin("", "null", '""', "[]", "{}")), F.array().cast("array<string>"))


def is_final_reference(path: Column) -> Column:
    """A path under skill/ without steps up, back slashes or a drive, with a place after # that isn't empty."""
    return path.rlike(r"^(?!.*/\.\.?(?:/|#))skill/[^\\#:]+#\S") & ~F.contains(path, F.lit("//"))


def trace_verdict(text: Column) -> Column:
    """negative, positive or unclear; a negative word decides."""
    return F.when(text.rlike(NEGATIVE_TRACE), "negative").when(text.rlike(POSITIVE_TRACE), "positive").otherwise("unclear")


def detail_code(value: Column) -> Column:
    """The bracketed code of a message, else the message as a code: upper case, words joined, 64 characters; empty where none comes out."""
    text = F.trim(F.coalesce(value, F.lit("")))
    inner = F.regexp_extract(text, r"^\[([A-Z][A-Z0-9_]{2,63})\]", 1)
    words = F.regexp_replace(F.regexp_replace(text, "(?<=[a-z0-9])(?=[A-Z])", "_"), "[^A-Za-z0-9]+", "_")
    token = F.left(F.upper(F.regexp_replace(words, "^_+|_+$", "")), F.lit(64))
    return F.when(inner != "", inner).when(token.rlike("^[A-Z][A-Z0-9_]{2,63}$"), token).otherwise("")


def stable_code(value: Column) -> Column:
    """One of 16 codes for any message."""
    code = detail_code(value)
    late = F.contains(code, F.lit("DEADLINE")) | code.endswith("_TIMEOUT")
    out = F.when(code.isin(*CODES), code).when(late, "NETWORK_TIMEOUT").when(code.startswith("MEDIA_"), "INVALID_MEDIA")
    for stable, details in DETAILS.items():
        out = out.when(code.isin(*details), stable)
    return out.otherwise("UNEXPECTED_ERROR")


def manifest_status(rows: DataFrame, key: str, status: str = "status") -> DataFrame:
    """(key, state) of manifests: complete if all objects are deleted or retained, action_required if any failed or is due, else active."""
    settled, due = F.col(status).isin("deleted", "retained"), F.col(status).isin("cleanup_failed", "pending_expiry")
    state = F.when(F.bool_and(F.coalesce(settled, F.lit(False))), "complete").when(F.bool_or(F.coalesce(due, F.lit(False))), "action_required").otherwise("active")
    return rows.groupBy(key).agg(state.alias("state"))


def case_problems(cases: DataFrame, required: Sequence[str], name: str = "name") -> DataFrame:
    """(name, n) of required cases that are not there exactly once."""
    wanted = cases.sparkSession.createDataFrame([(x,) for x in required], f"{name} string")
    counts = cases.groupBy(name).agg(F.count("*").alias("n"))
    return wanted.join(counts, name, "left").select(name, F.coalesce("n", F.lit(0)).alias("n")).where("n <> 1")


def covered_count(selected: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """One row: how many are selected, and of them how many have a text that isn't empty."""
    held = texts.where("trim(text) <> ''").select(key).distinct().withColumn("held", F.lit(1))
    return selected.select(key).distinct().join(held, key, "left").agg(F.count("*").alias("selected"), F.count("held").alias("covered"))


def unordered(rows: DataFrame, key: str, order: Sequence[str], start: str) -> DataFrame:
    """(key, faults): timed rows that start before the one before them."""
    before = F.lag(start).over(Window.partitionBy(key).orderBy(*order))
    return rows.where(F.col(start).isNotNull()).select(key, (F.col(start) < before).alias("fault")).groupBy(key).agg(F.count_if("fault").alias("faults"))


def first_over(rows: DataFrame, order: str, size: str, limit: int) -> DataFrame:
    """(order, total): the first row, in order, at which the running total passes the limit; no row if none does.

    Rows are dealt by ranges of the order; the totals of the ranges tell which one holds it, and only that one is gone through.
    """
    dealt = written(rows.select(order, size).repartitionByRange(order).withColumn("part", F.spark_partition_id()), "ranges")
    before = 0
    for part, total in sorted((r["part"], r["total"] or 0) for r in dealt.groupBy("part").agg(F.sum(size).alias("total")).collect()):
        if before + total > limit:
            running = F.lit(before) + F.sum(size).over(Window.partitionBy("part").orderBy(order))
            return dealt.where(F.col("part") == part).select(order, running.alias("total")).where(F.col("total") > limit).orderBy("total", order).limit(1)
        before += total
    return dealt.select(order, F.col(size).cast("long").alias("total")).where("false")


def truncated(rows: DataFrame, key: str, pointer: str, limit: int = 50) -> DataFrame:
    """(key, pointers, n, truncated): the first `limit` pointers of each key, and how many there are; cut before the shuffle."""
    some = rows.select(key, pointer).withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(pointer))).where(F.col("place") <= limit)
    lists = some.groupBy(key).agg(F.sort_array(F.collect_list(pointer)).alias("pointers"))
    return rows.groupBy(key).agg(F.count("*").alias("n")).join(lists, key).select(key, "pointers", "n", (F.col("n") > limit).alias("truncated"))


def by_document(phrases: DataFrame, ids: str, order: Sequence) -> DataFrame:
    """(video_id, phrases): the phrases of each document, in the order of their rank, from rows with a list of documents."""
    placed = phrases.withColumn("place", F.row_number().over(Window.orderBy(*order)))
    each = placed.select("place", "phrase", F.explode(ids).alias("video_id"))
    return each.groupBy("video_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "phrase"))), lambda x: x["phrase"]).alias("phrases"))


# --- nested JSON ------------------------------------------------------------------------------------


def _url(value) -> str | None:
    """The first web address in a value: a text itself, a list in order, an object's usual keys, then all its values."""
    if isinstance(value, str):
        return value if value.startswith(("http://", "https://")) else None
    inner = [value[k] for k in URL_KEYS if k in value] + list(value.values()) if isinstance(value, dict) else value if isinstance(value, list) else []
    return next(filter(None, map(_url, inner)), None)


def _key(value, names: Sequence[str]):
    """The value of the first name, in their order, at the least depth of each branch, that is not empty."""
    if isinstance(value, dict):
        hit = next((value[n] for n in names if value.get(n) not in (None, "")), None)
        if hit is not None:
            return (_url(hit) or hit) if isinstance(hit, dict | list) else hit
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return next((x for x in (_key(v, names) for v in inner) if x not in (None, "")), None)


def _authors(value) -> Iterator[dict]:
    """Objects with any key of an author, with repeats: those under usual names come once more before all values."""
    if isinstance(value, dict):
        if any(k in value for names in AUTHOR_KEYS.values() for k in names):
            yield value
        for inner in [value[k] for k in AUTHOR_HOLDERS if isinstance(value.get(k), dict)] + list(value.values()):
            yield from _authors(inner)
    elif isinstance(value, list):
        for inner in value:
            yield from _authors(inner)


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _over_json(rule, kind) -> Column:
    """A rule over JSON texts as a column function; texts that are no JSON give null."""

    def safe(raw):
        try:
            return rule(json.loads(raw))
        except ValueError:
            return None

    @F.pandas_udf(kind)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(safe, na_action="ignore")

    return run


def json_url(value: Column) -> Column:
    return _over_json(_url, StringType())(value)


def json_key(value: Column, names: Sequence[str]) -> Column:
    names = tuple(names)
    return _over_json(lambda v: _text(_key(v, names)), StringType())(value)


def creator_profile(items: DataFrame, value: str = "raw", order: str = "position") -> DataFrame:
    """One row: the author object with the best score over all items; the first of equal ones.

    A name counts 4, a handle 3, an id 2 and a second id 2; values that are no names count nothing.
    """
    fields = list(AUTHOR_KEYS)
    found = _over_json(lambda v: json.dumps([{f: str(_key(a, AUTHOR_KEYS[f]) or "").strip() for f in fields} for a in _authors(v)]), StringType())
    schema = "array<struct<" + ",".join(f"{f}:string" for f in fields) + ">>"
    each = items.select(F.col(order).alias("place"), F.posexplode(F.from_json(found(F.col(value)), schema)).alias("n", "a")).select("place", "n", *[F.when(~is_bad_profile_value(F.col(f"a.{f}")), F.col(f"a.{f}")).otherwise("").alias(f) for f in fields])
    score = sum((F.when(F.col(f) != "", n).otherwise(0) for f, n in zip(fields, (4, 3, 2, 2), strict=True)), F.lit(0))
    best = F.max_by(F.struct(*fields), F.struct(score.alias("score"), F.negative("place").alias("p"), F.negative("n").alias("n")))
    return each.agg(best.alias("best")).select(*[F.coalesce(f"best.{f}", F.lit("")).alias(f) for f in fields])


def dotted(value: Column, path: str) -> Column:
    """The value at a dotted path of a JSON text; a number is a place in a list, or a name where there is no list."""
    for part in path.split("."):
        named = F.get_json_object(value, f"$['{part}']")
        value = F.coalesce(F.get_json_object(value, f"$[{part}]"), named) if part.isdigit() else named
    return value


def layered(layers: DataFrame) -> DataFrame:
    """(key, value, source) of settings (rank, source, key, value): the value of the highest rank that is set, and where it is from."""
    one = F.max_by(F.struct("value", "source"), "rank")
    return layers.where("value is not null").groupBy("key").agg(one.alias("one")).select("key", "one.value", "one.source")


# Names of lists of items, and of the fields that tell an item, with what each counts.
ITEM_LISTS = ("aweme_list", "videos", "items", "list", "data")
ITEM_FIELDS = (
    (("platform_video_id", "aweme_id", "video_id", "item_id", "id"), 2),
    (("title", "desc", "description", "caption"), 1),
    (("download_url", "play_url", "play_addr", "download_addr", "play_addr_h264", "play_addr_265", "video_url", "url_list", "url", "src"), 2),
)


def _lists(value) -> Iterator[list]:
    """Lists under a usual name, and lists of objects alone, at any depth, in the order of the document."""
    for name, inner in value.items() if isinstance(value, dict) else ((None, x) for x in value) if isinstance(value, list) else ():
        if isinstance(inner, list) and (name in ITEM_LISTS or (inner and all(isinstance(x, dict) for x in inner))):
            yield inner
        yield from _lists(inner)


def _items(value) -> str:
    """The objects of the list whose first ten look most like items, the first of equal ones."""
    found = [value, *_lists(value)] if isinstance(value, list) and value and all(isinstance(x, dict) for x in value) else list(_lists(value))
    worth = lambda items: sum(n for x in items[:10] if isinstance(x, dict) for names, n in ITEM_FIELDS if _key(x, names))
    best = max(found, key=worth, default=[])
    return json.dumps([json.dumps(x, ensure_ascii=False) for x in best if isinstance(x, dict)])


def inferred_items(pages: DataFrame, value: str = "value", page: str = "path") -> DataFrame:
    """(page, position, item) of the item list of each page, wherever it stands in the document."""
    found = F.from_json(_over_json(_items, StringType())(F.col(value)), "array<string>")
    return pages.select(F.col(page).alias("page"), F.posexplode(found).alias("position", "item"))
