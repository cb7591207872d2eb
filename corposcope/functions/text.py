"""Text columns: cleaning, sentences, fragments, tokens, keyword labels, ids."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must be these for right results.
STOPWORDS = (
    "的", "了", "是", "在", "和", "与", "也", "都", "就", "而", "或", "把", "被", "让", "给", "再", "并", "及", "时", "到", "从", "向",
    "对", "中", "上", "下", "里", "后", "前", "会", "要", "还", "为", "以", "这", "那", "其", "它", "我", "你", "他", "她", "们", "个",
    "这是", "这个", "那个", "一个", "一些", "一种", "我们", "你们", "他们", "大家", "今天", "现在", "然后", "所以", "但是", "因为", "如果",
    "例如", "比如", "可以", "需要", "应该", "可能", "已经", "就是", "这样", "怎么", "如何", "为什么", "首先", "最后", "接着", "人工", "构造",
    "测试", "语料", "视频", "内容", "the", "and", "for", "with", "this", "that", "use",
)
FUNCTION_CHARS = "的一了是在和与也都就而或把被让给再并及时到从向对中上下里后前这那个们"
TIMESTAMP = r"\[?\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?\]?"
SENTENCE = r"[^。！？!?；;\r\n]+"
SENTENCE_END = r"[。！？!?；;\r\n]+"
TOKEN = r"[a-z0-9]+(?:\.[0-9]+)?|[\x{4e00}-\x{9fff}]+"

#: Stated in outputs that depend on it; another tokenizer is any function from a text column to an array column.
TOKENIZER = "ascii-words+cjk-runs"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(text: Column | str) -> Column:
    """White space of any kind to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(_col(text), r"(?U)\s+", " "))


def without_times(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), TIMESTAMP, "")


def clean_fragment(text: Column | str) -> Column:
    return clean(without_times(text))


def has_fragment(text: Column | str) -> Column:
    """Whether anything but time stamps, sentence ends and white space is in a text."""
    return without_times(F.coalesce(_col(text), F.lit(""))).rlike(r"(?U)[^。！？!?；;\s]")


def sentences(text: Column | str) -> Column:
    """Non-empty cleaned runs between sentence ends and line ends."""
    parts = F.split(F.coalesce(_col(text), F.lit("")), SENTENCE_END)
    return F.filter(F.transform(parts, clean_fragment), lambda x: x != "")


def sentences_with_ends(text: Column | str) -> Column:
    """Sentences with their closing mark."""
    return F.filter(F.transform(F.split(clean(text), r"(?<=[。！？!?])\s*"), F.trim), lambda x: x != "")


def sentence_count(text: Column | str) -> Column:
    return F.regexp_count(_col(text), F.lit("[。！？!?]"))


def tokens(text: Column | str) -> Column:
    """Lexical tokens, lower case: ASCII words that start with a letter, and CJK runs."""
    found = F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN), F.lit(0))
    return F.filter(found, lambda x: ~F.left(x, F.lit(1)).between("0", "9"))


def vocabulary_tokens(words: Sequence[str]) -> Callable[[Column | str], Column]:
    """A tokenizer that splits CJK runs by forward longest match over `words`; other characters are tokens of their own.

    For corpora without spaces between words, where tokens() gives whole runs. The words are one alternation, longest
    first, so nothing leaves the JVM; some thousands are fine.
    """
    known = "|".join(sorted((w.lower() for w in set(words) if re.fullmatch("[\u4e00-\u9fff]{2,}", w)), key=lambda w: (-len(w), w)))
    pattern = r"[a-z0-9]+(?:\.[0-9]+)?|" + (known + "|" if known else "") + r"[\x{4e00}-\x{9fff}]"

    def split(text: Column | str) -> Column:
        found = F.regexp_extract_all(F.lower(_col(text)), F.lit(pattern), F.lit(0))
        return F.filter(found, lambda x: ~F.left(x, F.lit(1)).between("0", "9"))

    return split


def is_term(token: Column) -> Column:
    cjk = token.rlike(r"^[\x{4e00}-\x{9fff}]")
    chars = F.length(token)
    varied = F.size(F.array_distinct(F.split(token, ""))) > 1
    content = F.length(F.translate(token, FUNCTION_CHARS, "")) > 0
    return ~token.isin(*STOPWORDS) & F.when(cjk, chars.between(2, 12) & varied & content).otherwise(chars.between(2, 64))


def joined_phrase(words: Column) -> Column:
    """CJK tokens without a space between, others with one."""
    cjk = F.forall(words, lambda x: x.rlike(r"^[\x{4e00}-\x{9fff}]"))
    return F.when(cjk, F.array_join(words, "")).otherwise(F.array_join(words, " "))


def windows(words: Column, low: int = 2, high: int = 6) -> Column:
    """All runs of `low` to `high` tokens."""

    def of(n: int) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.slice(words, i, F.lit(n)))
        return F.when(F.size(words) >= n, runs).otherwise(F.array().cast("array<array<string>>"))

    return F.concat(*[of(n) for n in range(low, high + 1)])


def holds_any(low: Column, keywords: Sequence[str]) -> Column:
    """Whether any keyword is in a text that is lower case."""
    return reduce(Column.__or__, [F.contains(low, F.lit(k.lower())) for k in keywords], F.lit(False))


def has_any(text: Column, keywords: Sequence[str]) -> Column:
    """Whether any keyword is in the text, case aside."""
    return holds_any(F.lower(text), keywords)


def labels(text: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """Labels of all groups with a keyword in the text, in the order of the groups."""
    return labels_in(F.lower(text), groups)


def labels_in(low: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """labels() of a text that is lower case."""
    return F.array_compact(F.array(*[F.when(holds_any(low, ks), F.lit(name)) for name, ks in groups.items()]))


def first_with(parts: Column, keywords: Sequence[str], limit: int = 180) -> Column:
    """The first part with a keyword, else the first part; cut to `limit` characters."""
    hit = F.filter(parts, lambda x: has_any(x, keywords))
    return F.left(F.coalesce(F.get(hit, F.lit(0)), F.get(parts, F.lit(0))), F.lit(limit))


def short_id(prefix: str, identity: Column) -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.left(F.sha2(identity, 256), F.lit(12)))


def excerpt(text: Column | str, chars: int) -> Column:
    """The whole text, or its head, middle and tail thirds."""
    t, third = _col(text), chars // 3
    middle = F.substring(t, F.floor(F.length(t) / 2 - chars / 6).cast("int") + 1, F.lit(third))
    return F.when(F.length(t) <= chars, t).otherwise(F.concat_ws("\n...\n", F.left(t, F.lit(third)), middle, F.right(t, F.lit(third))))


def overlap_text(text: Column | str) -> Column:
    """Letters and digits only, lower case, without timestamps."""
    bare = F.regexp_replace(_col(text), r"[\[(]?(?:(?:\d{1,3}:)?\d{1,2}:\d{2})(?:[.,]\d{1,3})?[\])]?", "")
    return F.lower(F.regexp_replace(bare, r"[^\p{L}\p{N}]", ""))


def clock(ms: Column) -> Column:
    """[HH:MM:SS] of milliseconds; hours don't wrap."""
    s = F.floor(ms / 1000)
    return F.format_string("[%02d:%02d:%02d]", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def iso_time(value: Column) -> Column:
    """Epoch seconds or milliseconds as ISO text in UTC; other text unchanged."""
    n = F.expr("null").cast("double") if value is None else F.try_to_number(value, F.lit("9999999999999999")).cast("double")
    seconds = F.when(n > 1e10, n / 1000).otherwise(n)
    return F.coalesce(F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss+00:00"), value)


def safe_name(text: Column | str, fallback: str, limit: int = 80) -> Column:
    slim = F.regexp_replace(F.regexp_replace(_col(text), r"[^A-Za-z0-9._-]+", "-"), r"^[-.]+|[-.]+$", "")
    return F.when(F.length(slim) > 0, F.left(slim, F.lit(limit))).otherwise(F.lit(fallback))
