"""Transcript segments: response shapes, ordering, boundary merge, subtitles and rendering."""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corposcope.functions.text import clean, clock

SEGMENT = "text string, start_ms long, end_ms long, source_index int, provider string"
#: The three response shapes (fixed values).
CHAT = "struct<choices: array<struct<index: int, message: struct<role: string, content: string>>>>"
SEGMENTS = "array<struct<id: int, start: double, `end`: double, text: string>>"
AUDIO = f"struct<text: string, segments: {SEGMENTS}, result: struct<segments: {SEGMENTS}>>"
SENTENCES = "struct<transcripts: array<struct<channel_id: int, sentences: array<struct<sentence_id: int, begin_time: long, end_time: long, text: string>>>>>"


def milliseconds(value: Column, seconds: bool) -> Column:
    v = value.cast("double")
    return F.when((v >= 0) & ~F.isnan(v) & (v < 1e15), F.bround(v * (1000 if seconds else 1), 0).cast("long"))


def parse_responses(rows: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, text, start_ms, end_ms, source_index, provider) of JSON responses of any of the three shapes.

    Chat: the first choice with content, without times. Segments: those of the response, then those of its result
    that equal none before, seconds; the plain text if there are none. Sentences: milliseconds, numbered before
    empty ones go. Empty texts are dropped.
    """
    raw = F.col(payload)
    has = lambda path: F.get_json_object(raw, path).isNotNull()
    chat = F.from_json(raw, CHAT)
    contents = F.filter(F.transform(chat["choices"], lambda c: clean(c["message"]["content"])), lambda t: t != "")
    empty = F.lit(None).cast("long")
    row = lambda t, a, b, i, p: F.struct(t.alias("text"), a.alias("start_ms"), b.alias("end_ms"), i.cast("int").alias("source_index"), F.lit(p).alias("provider"))
    of_chat = F.transform(F.slice(contents, 1, 1), lambda t: row(t, empty, empty, F.lit(0), "chat"))
    audio = F.from_json(raw, AUDIO)
    none = F.array().cast(SEGMENTS)
    first, second = F.coalesce(audio["segments"], none), F.coalesce(audio["result"]["segments"], none)
    same = lambda x, y: x["text"].eqNullSafe(y["text"]) & x["start"].eqNullSafe(y["start"]) & x["end"].eqNullSafe(y["end"])
    every = F.concat(first, F.filter(second, lambda x: ~F.exists(first, lambda y: same(x, y))))
    of_audio = F.transform(every, lambda x, i: row(clean(x["text"]), milliseconds(x["start"], True), milliseconds(x["end"], True), i, "segments"))
    of_audio = F.when(F.size(every) > 0, of_audio).otherwise(F.array(row(clean(audio["text"]), empty, empty, F.lit(0), "segments")))
    said = F.flatten(F.transform(F.from_json(raw, SENTENCES)["transcripts"], lambda t: t["sentences"]))
    of_sentences = F.transform(said, lambda x, i: row(clean(x["text"]), milliseconds(x["begin_time"], False), milliseconds(x["end_time"], False), i, "sentences"))
    found = F.when(has("$.transcripts"), of_sentences).when(has("$.choices"), of_chat).otherwise(of_audio)
    return rows.select(key, F.explode(found).alias("s")).select(key, "s.*").where(F.coalesce("text", F.lit("")) != "")


def ordered_segments(segments: DataFrame, key: str) -> DataFrame:
    """Each media's segments as a sorted array: start, those without one last, then source index."""
    order = F.struct(F.col("start_ms").isNull().alias("untimed"), "start_ms", "source_index", "text", "end_ms")
    return segments.groupBy(key).agg(F.array_sort(F.collect_list(order)).alias("segments"))


def rendered(segments: DataFrame, key: str) -> DataFrame:
    """(key, transcript): a line for each segment, with [HH:MM:SS] where it has a start."""
    line = lambda s: F.when(s["start_ms"].isNull(), s["text"]).otherwise(F.concat(clock(s["start_ms"]), F.lit(" "), s["text"]))
    return ordered_segments(segments, key).select(key, F.array_join(F.transform("segments", line), "\n").alias("transcript"))


def merge_chunks(segments: DataFrame, key: str, window_ms: int = 2000, least_chars: int = 4, alike: float = 0.92) -> DataFrame:
    """(key, segment_index, chunk_index, text, start_ms, end_ms) in global time and order, without the repeats at chunk boundaries.

    Rows (key, chunk_index, chunk_start_ms, chunk_end_ms, text, start_ms, end_ms, source_index), times local to the
    chunk. Segments come by their start, untimed ones at the start of their chunk, after those timed there. A segment goes
    if one kept of the chunk before says nearly the same, both texts have `least_chars` characters, that one ends within
    `window_ms` of its chunk's end, this one starts within `window_ms` of its chunk's start, and as near to each other.
    Empty segments go too. Each media is one group, as what is kept depends on what was kept before; it holds the
    segments of one recording.
    """
    kind = dict(segments.dtypes)[key]

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        chunks = frame[["chunk_start_ms", "chunk_index"]].drop_duplicates().sort_values(["chunk_start_ms", "chunk_index"])
        frame = frame.assign(
            text=frame["text"].fillna("").map(lambda x: " ".join(x.split())),
            place=frame["chunk_index"].map({c: n for n, c in enumerate(chunks["chunk_index"])}),
            begin=frame["chunk_start_ms"] + frame["start_ms"],
            until=frame["chunk_start_ms"] + frame["end_ms"],
        )
        frame = frame[frame["text"] != ""].assign(when=lambda f: f["begin"].fillna(f["chunk_start_ms"]), loose=lambda f: f["begin"].isna())
        tails: dict[int, list[tuple[str, float]]] = {}
        stay = []
        for r in frame.sort_values(["when", "loose", "chunk_index", "source_index"], kind="stable").itertuples():
            said, at_edge = r.text.casefold(), not r.loose and abs(r.begin - r.chunk_start_ms) <= window_ms
            if at_edge and len(r.text) >= least_chars:
                near = [x for x, end in tails.get(r.place - 1, []) if abs(r.begin - end) <= window_ms]
                if any(difflib.SequenceMatcher(None, x, said).ratio() >= alike for x in near):
                    continue
            stay.append(r.Index)
            if not pd.isna(r.until) and abs(r.chunk_end_ms - r.until) <= window_ms and len(r.text) >= least_chars:
                tails.setdefault(r.place, []).append((said, r.until))
        kept = frame.loc[stay].reset_index(drop=True)
        out = pd.DataFrame({key: kept[key], "segment_index": range(len(kept)), "chunk_index": kept["chunk_index"], "text": kept["text"], "start_ms": kept["begin"], "end_ms": kept["until"]})
        return out.astype({"start_ms": "Int64", "end_ms": "Int64"})

    return segments.groupBy(key).applyInPandas(merge, f"{key} {kind}, segment_index int, chunk_index int, text string, start_ms long, end_ms long")


def subtitle_text(texts: DataFrame, key: str, paragraph: int = 240) -> DataFrame:
    """(key, text): subtitles without headers, cue numbers, times, tags and consecutive repeats, in paragraphs that
    close at a sentence end or `paragraph` characters. One text is one value, so this is a map over rows."""
    kind = dict(texts.dtypes)[key]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({key: frame[key], "text": [_paragraphs(t or "", paragraph) for t in frame["text"]]})

    return texts.select(key, "text").mapInPandas(run, f"{key} {kind}, text string")


def _paragraphs(content: str, limit: int) -> str:
    lines: list[str] = []
    skipping = False
    for raw in content.replace("﻿", "").splitlines():
        line = re.sub(r"\s+", " ", re.sub(r"<[^>]+>|\{[^}]*\}", "", raw)).strip()
        if re.match(r"(WEBVTT|NOTE|STYLE|REGION)\b", line):
            skipping = True
        elif not line:
            skipping = False
        if skipping or not line or line.isdigit() or "-->" in line or (lines and lines[-1] == line):
            continue
        lines.append(line)
    out, now = [], ""
    for line in lines:
        now = f"{now} {line}".strip()
        if len(now) >= limit or now[-1] in "。！？!?.":
            out.append(now)
            now = ""
    return "\n\n".join([*out, *[now] * bool(now)])


def with_transcripts(items: DataFrame, corpus: DataFrame) -> DataFrame:
    """Items (artifact_id, platform_video_id, ...) with text of the corpus (artifact_id, text): by artifact id, else by raw id, else empty."""
    named, raw = corpus.selectExpr("artifact_id", "text named_text"), corpus.selectExpr("artifact_id platform_video_id", "text raw_text")
    out = items.join(named, "artifact_id", "left").join(raw, "platform_video_id", "left")
    return out.withColumn("text", F.coalesce("named_text", "raw_text", F.lit(""))).drop("named_text", "raw_text")
