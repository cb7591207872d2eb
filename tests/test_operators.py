"""Operators on small inputs, against plain Python where there is a rule to hold."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from corposcope import streaming
from corposcope.functions import ratios, text
from corposcope.operators import checks, coverage, entities, evidence, hygiene, ids, notes, overlap, phrases, retention, schemas, status, terms, transcripts
from corposcope.plans import presets
from corposcope.sources import readers, reports, scratch, writers


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_sentences_and_timestamps(spark):
    df = spark.createDataFrame([("[00:01] 第一句。 第二句！\n[00:02:03.5]  third;fourth",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(text.sentences("t")).collect()]
    assert got == [["第一句", "第二句", "third", "fourth"], [], []]


def test_term_filter(spark):
    df = spark.createDataFrame([(x,) for x in ("the", "a", "ab", "的的", "火候", "火火", "了了是", "x" * 65)], "t string")
    assert [r[0] for r in df.where(text.is_term(F.col("t"))).collect()] == ["ab", "火候"]


def test_phrase_keeps_longest(spark):
    docs = spark.createDataFrame([("1", None, "alpha beta gamma. other words here"), ("2", None, "so alpha beta gamma"), ("3", None, "alpha beta delta")], "video_id string, title string, text string")
    got = {r["phrase"]: r["document_frequency"] for r in terms.repeated_phrases(docs).collect()}
    assert got["alpha beta gamma"] == 2 and got["alpha beta"] == 3 and "beta gamma" not in got


def test_distinct_terms_is_greedy(spark):
    def greedy(xs, limit=6):
        out = []
        for x in xs:
            if len(out) < limit and not any(x in y or y in x for y in out):
                out.append(x)
        return out

    rng = random.Random(4)
    cases = [["".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(8)] for _ in range(50)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, xs array<string>")
    got = {r[0]: r[1] for r in df.select("i", terms.distinct_terms(F.col("xs"))).collect()}
    assert all(got[i] == greedy(c) for i, c in enumerate(cases))


def test_periods_round_half_even(spark):
    for n, sizes in ((4, [1, 2, 1]), (5, [2, 1, 2]), (1, [0, 1, 0]), (9, [3, 3, 3])):
        df = coverage.periods(spark.range(n).withColumnRenamed("id", "k"), ["k"])
        got = {r[0]: r[1] for r in df.groupBy("period").count().collect()}
        assert [got.get(i, 0) for i in (1, 2, 3)] == sizes, (n, got)


def test_ratios_of_nothing(spark):
    zero = F.lit(0)
    row = spark.range(1).select(ratios.ratio_or_one(zero, zero), ratios.ratio_or_zero(zero, zero), ratios.ratio_or_null(zero, zero), ratios.floored_ratio(zero, zero)).first()
    assert tuple(row) == (1.0, 0.0, None, 0.0)


def test_gate_counts_null_as_failed(spark):
    df = spark.createDataFrame([("g", "a", True), ("g", "b", None), ("h", "c", True)], "gate string, check string, passed boolean")
    assert rows(evidence.gate(df), "gate", "passed", "failed") == [("g", False, "b"), ("h", True, "")]


def test_integrity(spark):
    refs = spark.createDataFrame([("/a/0", "1", "transcript"), ("/a/1", "9", "metadata"), ("/a/2", "2", "transcript"), ("/a/3", "3", "metadata")], "pointer string, video_id string, required_type string")
    corpus = spark.createDataFrame([("1", 10), ("2", 0), ("3", 5)], "video_id string, transcript_chars int")
    state = coverage.decision_state(coverage.evidence_decisions(spark.createDataFrame([("1", "Accepted"), ("2", "used"), ("3", "not-used")], "video_id string, status string")))
    assert rows(evidence.integrity_violations(refs, corpus, state), "pointer", "category") == [("/a/1", "orphan"), ("/a/2", "type"), ("/a/3", "rejected")]


def test_ledger(spark):
    got = evidence.synced_ledger(spark.createDataFrame([("a",), ("b",)], "candidate_id string"), spark.createDataFrame([("a", 1, "kept"), ("a", 2, "kept"), ("z", 3, "kept")], "candidate_id string, ordinal int, status string"))
    assert rows(got, "candidate_id", "state") == [("a", "duplicate"), ("a", "kept"), ("b", "pending"), ("z", "orphaned")]


def test_steps(spark):
    df = spark.createDataFrame([("a", "skipped", True), ("b", "failed", None), ("b", "completed", None), ("c", "skipped", None), ("d", "failed", None)], "step_id string, status string, verified boolean")
    got = status.step_rollup(df)
    assert rows(got, "step_id", "status") == [("a", "succeeded"), ("b", "partial"), ("c", "skipped"), ("d", "failed")]
    assert tuple(status.pipeline_status(got).first()) == (4, "failed", 1)


def test_overlap_brute_force(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    docs = [(i, word(rng.randint(0, 90))) for i in range(12)]
    goals = [(i, word(10) + docs[i][1][5:] + word(10)) for i in range(10)]
    run = 12
    got = {r["item_id"]: (r["matched_chars"], r["longest"]) for r in overlap.overlap(spark.createDataFrame(goals, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string"), run=run).collect()}
    for i, t in goals:
        covered, longest = set(), 0
        for _, s in docs:
            for a in range(len(t)):
                for n in range(run, len(t) - a + 1):
                    if t[a : a + n] not in s:
                        break
                    covered.update(range(a, a + n))
                    longest = max(longest, n)
        assert got[i] == (len(covered), longest)


def test_entities(spark):
    df = spark.createDataFrame([(1, "Use Open-AI and open ai, openais no, O.p.e.n AI. The Vision Pro Max, VisionPro"), (2, None)], "doc_id int, text string")
    found = entities.entity_spans(df, {"OpenAI": (), "Vision Pro": ("Vision Pro Max", "Pro Max VisionPro")}, "doc_id")
    # the earliest match wins, then the longest
    assert rows(found, "canonical", "surface") == [("OpenAI", "O.p.e.n AI"), ("OpenAI", "Open-AI"), ("OpenAI", "open ai"), ("Vision Pro", "Vision Pro Max"), ("Vision Pro", "VisionPro")]
    assert rows(entities.registered_candidates(found, "doc_id"), "canonical", "document_frequency", "occurrences", "entity_key") == [("OpenAI", 1, 3, "openai"), ("Vision Pro", 1, 2, "visionpro")]


SEGMENT = "media string, chunk_index int, chunk_start_ms long, chunk_end_ms long, text string, start_ms long, end_ms long, source_index int"


def test_chunk_merge_drops_boundary_repeats(spark):
    df = spark.createDataFrame(
        [("m", 0, 0, 10000, "hello there", 0, 3000, 0), ("m", 0, 0, 10000, "at the boundary now", 8500, 10000, 1), ("m", 1, 10000, 20000, "at the boundary now!", 200, 900, 0), ("m", 1, 10000, 20000, "later text", 5000, 6000, 1)],
        SEGMENT,
    )
    got = rows(transcripts.merge_chunks(df, "media"), "chunk_index", "text", "start_ms")
    assert got == [(0, "at the boundary now", 8500), (0, "hello there", 0), (1, "later text", 15000)]


def test_chunk_merge_in_global_order(spark):
    df = spark.createDataFrame(
        [
            ("m", 1, 120000, 240000, "second chunk", 5000, 6000, 0), ("m", 0, 0, 120000, "no time", None, None, 1), ("m", 0, 0, 120000, "past the start", 0, 900, 0),
            ("m", 0, 0, 120000, "runs over", 121000, 122000, 2), ("m", 1, 120000, 240000, " ", 1, 2, 1), ("m", 1, 120000, 240000, "abc", 100, 200, 2), ("m", 0, 0, 120000, "abc", 119000, 120000, 3), ("m", 1, 120000, 240000, "untimed too", None, None, 3),
        ],
        SEGMENT,
    )
    got = [(r["text"], r["start_ms"]) for r in transcripts.merge_chunks(df, "media").orderBy("segment_index").collect()]
    # three characters are too few to be a repeat
    assert got == [("past the start", 0), ("no time", None), ("abc", 119000), ("untimed too", None), ("abc", 120100), ("runs over", 121000), ("second chunk", 125000)]
    assert [t for t, s in got if s is not None] == ["past the start", "abc", "abc", "runs over", "second chunk"] and got[1] == ("no time", None)


def test_responses(spark):
    df = spark.createDataFrame(
        [
            ("c", '{"choices":[{"message":{"content":""}},{"message":{"content":" hi  there "}}]}'),
            ("s", '{"text":"x","segments":[{"start":0.5,"end":1,"text":"a"}],"result":{"segments":[{"start":0.5,"end":1,"text":"a"},{"start":2,"end":3,"text":"b"}]}}'),
            ("t", '{"transcripts":[{"sentences":[{"begin_time":0,"end_time":5,"text":"p"},{"text":""},{"begin_time":7,"text":"q"}]}]}'),
            ("e", '{"text":"only"}'),
        ],
        "id string, payload string",
    )
    got = rows(transcripts.parse_responses(df, "id", "payload"), "id", "text", "start_ms", "source_index")
    assert got == [("c", "hi there", None, 0), ("e", "only", None, 0), ("s", "a", 500, 0), ("s", "b", 2000, 1), ("t", "p", 0, 0), ("t", "q", 7, 2)]


def test_subtitles(spark):
    df = spark.createDataFrame([("a", "WEBVTT\n\nNOTE x\n\n1\n00:00:01.000 --> 00:00:02.000\n<b>Hello</b>\n\n2\n00:00:02.000 --> 00:00:03.000\nHello\nworld.\n")], "id string, text string")
    assert transcripts.subtitle_text(df, "id").first()["text"] == "Hello world."


def test_redaction(spark):
    df = spark.createDataFrame([("HTTPS://u:p@Ex.com/a?token=1&x=2&sig=3#f",), ("ftp://x/y",), ("http://h/p?api_key=9",)], "u string")
    assert [r[0] for r in df.select(hygiene.redacted_url(F.col("u"))).collect()] == ["https://ex.com/a?x=2", "<redacted-url>", "http://h/p"]
    row = spark.createDataFrame([('Authorization: Bearer abc password="q w" key /home/me/x',)], "t string").select(hygiene.scrubbed(F.col("t"))).first()[0]
    assert "abc" not in row and "q w" not in row and "/home/me" not in row


def test_scrub_rules(spark):
    cases = {
        "see https://u:p@Ex.com/a?token=1&x=a+b#f, and more": "see https://ex.com/a?x=a+b, and more",
        "API_KEY='a b c' rest": "API_KEY=<redacted> rest",
        '"my-secret": "x y"': '"my-secret": "<redacted>"',
        "--access-token=abc&z": "--access-token=<redacted>&z",
        "at C:\\Users\\me\\x.txt; ok": "at <redacted-path>; ok",
        "in /home/me/x, ok a/home/me": "in <redacted-path>, ok a/home/me",
        "Authorization: Bearer abc": "Authorization: <redacted>",
        "no secrets here": "no secrets here",
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", hygiene.scrubbed(F.col("t"))).collect()} == cases
    assert df.select(hygiene.scrubbed(F.lit("ab known cd"), known=("known",), limit=6)).first()[0] == "ab <re"


def test_scrub_is_linear_in_long_words(spark):
    import time

    df = spark.createDataFrame([("a" * 200_000 + " " + "b-" * 100_000 + "key",)], "t string")
    began = time.time()
    assert df.select(F.length(hygiene.scrubbed(F.col("t")))).first()[0] == 400_004 and time.time() - began < 20


def test_fences(spark):
    df = spark.createDataFrame([("a\n```py\n????\n```\nb\n~~~\nopen",)], "t string")
    assert df.select(hygiene.without_fenced_code("t")).first()[0] == "a\nb\n~~~\nopen"


def test_ids(spark):
    got = {r[0]: r[1] for r in spark.createDataFrame([("ok-1",), ("a/b",), ("..",), ("",), ("con",), ("x.",)], "i string").select("i", hygiene.id_problem(F.col("i"))).collect()}
    assert got == {"ok-1": None, "a/b": "separator", "..": "traversal", "": "empty", "con": "reserved", "x.": "trailing"}


def test_pages_and_items(spark):
    pages = spark.createDataFrame([("p1", '{"data":{"aweme_list":[{"aweme_id":"1","desc":"a","create_time":1700000000},{"aweme_id":"2","desc":"b","statistics":{"digg_count":"unknown"}}]}}'), ("p2", '{"items":[{"id":"1","title":"again"},{"title":"no id"}]}')], "path string, value string")
    items = readers.merged_pages(readers.page_items(pages))
    got = rows(readers.normalised_items(items), "platform_video_id", "title", "published_at")
    assert got == [("1", "a", "2023-11-14T22:13:20+00:00"), ("2", "b", None), ("video-2", "no id", None)]


def test_markdown_table(spark):
    df = spark.createDataFrame([("f", "x\n\n| Video ID | Status | Reason |\n|---|:-:|---|\n| 1 | used | |\n| 2 | rejected | dup |\n\nend")], "id string, text string")
    got = rows(readers.table_rows(df, "id", {"video_id": ("video_id",), "status": ("status", "decision"), "reason": ("reason",)}), "ordinal", "video_id", "status", "reason")
    assert got == [(1, "1", "used", ""), (2, "2", "rejected", "dup")]


def test_corpus_limits(spark, tmp_path):
    (tmp_path / "a.txt").write_text("hello")
    (tmp_path / "b.txt").write_bytes(b"\xef\xbb\xbfhi\xff")
    got = rows(readers.read_corpus(spark, str(tmp_path)), "artifact_id", "text")
    assert got == [("a", "hello"), ("b", "hi�")]
    try:
        readers.read_corpus(spark, str(tmp_path), max_chars=4)
    except readers.LimitExceeded:
        return
    raise AssertionError


def test_certified_table(spark, tmp_path):
    path = str(tmp_path / "t")
    made = writers.write_certified(spark.range(5), path, "numbers", {"a": "1"}, {"k": 2})
    assert made["certified"] and writers.is_fresh(spark, path, "numbers", {"a": "1"}, {"k": 2}) and not writers.is_fresh(spark, path, "numbers", {"a": "2"}, {"k": 2})
    assert not writers.write_certified(spark.range(0), str(tmp_path / "e"), "numbers", {}, {})["certified"]


def test_upsert_and_freshness(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "2")], "artifact string, fingerprint string")
    b = spark.createDataFrame([("y", "3"), ("z", "4")], "artifact string, fingerprint string")
    assert rows(status.upserted(a, b, "artifact"), "artifact", "fingerprint") == [("x", "1"), ("y", "3"), ("z", "4")]
    assert rows(evidence.freshness(a, b), "artifact", "state") == [("x", "missing"), ("y", "stale")]


def test_reports(spark):
    df = spark.createDataFrame([("a|b", ["x", "y"], 1), (None, [], 2)], "name string, tags array<string>, n int")
    assert reports.markdown_table(df, 5, "T").splitlines() == ["## T", "", "| name | tags | n |", "|---|---|---|", "| a&#124;b | x, y | 1 |", "|  |  | 2 |"]
    docs = spark.createDataFrame([("1", "Cats and cats. Dogs!"), ("2", None)], "id string, text string")
    assert rows(reports.transcript_summary(docs, "id"), "chars", "top_terms") == [(0, []), (20, ["cats: 2", "dogs: 1"])]


def test_transcripts_by_either_id(spark):
    items = spark.createDataFrame([("a1", "r1"), ("a2", "r2"), ("a3", "r3")], "artifact_id string, platform_video_id string")
    corpus = spark.createDataFrame([("a1", "one"), ("r2", "two")], "artifact_id string, text string")
    assert rows(transcripts.with_transcripts(items, corpus), "artifact_id", "text") == [("a1", "one"), ("a2", "two"), ("a3", "")]


def test_artifact_ids(spark):
    df = spark.createDataFrame([("A b", 1), ("a-b", 2), ("//", 3)], "k string, n int")
    got = {r["n"]: r["artifact_id"] for r in ids.assigned(df, "k", "n").collect()}
    assert got[1] == "a-b" and got[2].startswith("a-b--") and len(got[2]) == 15 and got[3] == "video"


def test_sections(spark):
    df = spark.createDataFrame([("f", "intro\n## One\n- a\n* b\ntext\n## Two\n- c")], "id string, text string")
    assert rows(notes.sections(df, "id"), "section", "bullets") == [("", 0), ("One", 2), ("Two", 1)]


def test_retention(spark):
    df = spark.createDataFrame([("skill/a.md", 1), ("video/b.mp4", 9)], "path string, bytes long")
    assert rows(retention.totals(retention.plan(df, "final")), "keep", "files", "bytes") == [(False, 1, 9), (True, 1, 1)]
    assert retention.listing_digest(df).first()["files"] == 2


def all_shuffled(spark, run):
    """Bytes that all stages of run() write into shuffles."""
    sc, jvm = spark.sparkContext, spark._jvm
    stages = lambda: sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    begun = max((stages().apply(i).stageId() for i in range(stages().size())), default=-1)
    run()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    found = stages()
    return sum(found.apply(i).shuffleWriteBytes() for i in range(found.size()) if found.apply(i).stageId() > begun)


def test_top_phrases_shuffle_no_packed_windows(spark, monkeypatch):
    """The first phrases stand in many documents; the windows of one are only counted in a table of fixed size."""
    monkeypatch.setattr(phrases, "BUCKET_WINDOWS", 20_000)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("bcdfgst") + rng.choice("aeiou") for _ in range(3))
    common = [" ".join(word() for _ in range(4)) for _ in range(60)]
    rows = [(str(i), None, "\n".join([" ".join(word() for _ in range(12)) for _ in range(150)] + rng.sample(common, 30))) for i in range(60)]
    df, got = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "video_id string, title string, text string"), []
    assert all_shuffled(spark, lambda: got.extend(terms.top_phrases(df).collect())) < 2 * sum(len(r[2]) for r in rows)
    assert len(got) == 40 and {r["phrase"] for r in got} <= {" ".join(c.split()[a:z]) for c in common for a in range(3) for z in range(a + 2, 5)}


@pytest.mark.parametrize(("likely", "sent", "bits"), [(25, 200_000, 22), (1, 200_000, 22), (1, 200_000, 9), (1, 0, 22)])
def test_top_phrases_by_brute_force(spark, monkeypatch, likely, sent, bits):
    """Found at once, after several tries, in slots that many phrases share, and by counting all; rows that repeat an id, and an id that is null."""
    for name, value in (("LIKELY", likely), ("MORE", 2), ("SENT", sent), ("SLOT_BITS", bits), ("BLOCK_TOKENS", 60)):
        monkeypatch.setattr(phrases, name, value)
    rng = random.Random(8)
    words = ["an", "than", "the", "then", "other", "aa", "a", "alpha", "beta", "火候", "控制", "控制火候", "保持"]
    docs = [(str(i), "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))) for _ in range(4))) for i in range(30)]
    docs += [("c1", docs[3][1]), ("c2", docs[3][1] + "\nthan other 火候"), ("r", "alpha beta then 控制"), ("r", "the alpha beta then 控制 火候"), ("r", "")]
    df = spark.createDataFrame([(v, None, t) for v, t in docs], "video_id string, title string, text string").repartition(3)
    want = phrases_by_rule(docs, str.split)
    order = lambda p: (-want[p][0], -want[p][2], -want[p][1], p)
    for limit in (3, 40, len(want) + 5):
        got = terms.top_phrases(df, limit).select("phrase", "document_frequency", "total_frequency", "n_tokens").collect()
        assert {r[0]: tuple(r[1:]) for r in got} == {p: want[p] for p in sorted(want, key=order)[:limit]}
    none = spark.createDataFrame([(None, None, "alpha beta gamma"), ("1", None, "alpha beta gamma")], df.schema)
    assert [tuple(r) for r in terms.top_phrases(none).select("phrase", "document_frequency", "representative_video_ids").collect()] == [("alpha beta gamma", 2, ["1"])]
    assert terms.top_phrases(none.where("false")).count() == 0


def test_sentences_between_ends(spark):
    said = ["", "a.b! c？\r\n\n;d；", "！！", "  x  y 12:30 \u2003z。", None, "no end"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in said], "t string").select(text.sentences("t")).collect()]
    clean = lambda x: " ".join(re.sub("12:30", "", x).split())
    assert got == [[c for x in re.findall(text.SENTENCE, t or "") if (c := clean(x))] for t in said]


def test_overlay_and_range_anti_join(spark):
    preset = spark.createDataFrame([("k", "Kay", "x"), ("p", "Pea", "x")], "entity_key string, canonical string, category string")
    project = spark.createDataFrame([("k", "K!", "y")], "entity_key string, canonical string, category string")
    assert rows(entities.overlaid_definitions(preset, project), "entity_key", "canonical", "alias", "origin") == [("k", "K!", "Kay", "project"), ("p", "Pea", None, "preset")]
    found = spark.createDataFrame([(1, 2, 4), (1, 8, 12)], "d int, start int, end int")
    assert rows(entities.outside_spans(found, spark.createDataFrame([(1, 0, 5)], "d int, start int, end int"), "d"), "start") == [(8,)]


def test_chinese_text_by_a_vocabulary(spark):
    docs = spark.createDataFrame(
        [("v1", "炒菜要点", "先控制火候保持口感。控制火候保持口感最重要！"), ("v2", None, "老师傅说控制火候保持口感；API 2.0 也行"), ("v3", "别的", "完全不同的话题")],
        "video_id string, title string, text string",
    )
    split = text.vocabulary_tokens(("控制", "火候", "保持", "口感", "老师傅", "话题"))
    plain = {r["term"]: (r["document_frequency"], r["total_frequency"]) for r in terms.term_evidence(docs, split).collect()}
    assert plain["火候"] == (2, 3) and plain["话题"] == (1, 1) and plain["api"] == (1, 1) and "菜" not in plain
    top = {r["phrase"]: r for r in terms.top_phrases(docs, tokenizer=split).collect()}["控制火候保持口感"]
    assert (top["document_frequency"], top["total_frequency"], top["n_tokens"]) == (2, 3, 4)
    assert top["representative_video_ids"] == ["v1", "v2"] and top["source_fragment_ids"] == ["v1#transcript:0001", "v1#transcript:0002", "v2#transcript:0001"]


def test_signals_of_the_chinese_preset(spark):
    docs = spark.createDataFrame([("a", "新手教程", "为什么要慢？第一步先放盐。其实原理简单。记住不要违规。"), ("b", None, None)], "video_id string, title string, text string")
    got = {r["video_id"]: r for r in coverage.signals(docs, presets.GENERAL_ZH).collect()}
    assert got["a"]["themes"] == ["教程 / 方法"] and got["a"]["hooks"] == ["问题 / 悬念入口", "反差 / 转折入口", "直接任务 / 方法入口"]
    assert got["a"]["arguments"] == ["步骤说明", "机制解释"] and got["a"]["endings"] == ["行动建议", "风险提醒"]
    assert got["a"]["contributions"] == ["topic_model:method_tutorial", "judgment_heuristic:mechanism"] and got["a"]["boundary"] and got["a"]["judgment_sentence"] == "为什么要慢？"
    assert got["b"]["contributions"] == ["evidence:general_style"] and not got["b"]["boundary"] and got["b"]["hooks"] == []


def test_tables_of_a_text(spark):
    text = "| Video ID | Status |\n|---|---|\n| 1 | used |\n\nwords\n\n| other | x |\n|--|--|\n| 9 | 9 |\n\n| status | video-id |\n| :-- | --: |\n| no | 2 |\n| yes | 3 |"
    df = spark.createDataFrame([(1, text), (2, None)], "d int, text string")
    got = readers.table_rows(df, "d", {"video_id": ("video_id", "id"), "status": ("status",)})
    assert rows(got, "ordinal", "video_id", "status") == [(1, "1", "used"), (2, "2", "no"), (3, "3", "yes")]


def test_fences_with_an_info_string(spark):
    df = spark.createDataFrame([("a ?\n```sh\n????\n```\nb",), ("``` x ` y\n????",), ("~~~ a ` b\n????\n~~~",)], "t string")
    got = [tuple(r) for r in df.select(*[c.alias(k) for k, c in hygiene.encoding_columns(F.col("t")).items()]).select("question_marks", "longest_run", "passed").collect()]
    assert got == [(1, 1, True), (4, 4, False), (0, 0, True)]


def test_nested_json(spark):
    raw = ['{"a": {"video": {"url_list": ["x", "https://v/1"]}}, "author": {"nickname": "null", "uid": "7"}}', '{"user": {"nickname": "Ann", "unique_id": "ann"}, "items": [{"desc": "", "title": "T"}]}', "no json", None]
    df = spark.createDataFrame(list(enumerate(raw)), "position int, raw string")
    assert [r[0] for r in df.orderBy("position").select(checks.json_url(F.col("raw"))).collect()] == ["https://v/1", None, None, None]
    assert [r[0] for r in df.orderBy("position").select(checks.json_key(F.col("raw"), ("title", "desc", "uid"))).collect()] == ["7", "T", None, None]
    assert tuple(checks.creator_profile(df).first()) == ("Ann", "ann", "", "")
    assert tuple(checks.creator_profile(df.where("position > 1")).first()) == ("", "", "", "")


def test_small_rules(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    lit = F.lit
    assert [one(checks.bounded_int(lit(x), 1, 9)) for x in (" +7 ", "1e1", "10", "")] == [7, None, None, None]
    assert [one(checks.bounded_float(lit(x), 0, 2)) for x in ("1.5", "nan", "inf", "x", "3")] == [1.5, None, None, None, None]
    assert [one(checks.is_metadata_role(lit(x))) for x in ("Metadata", "metadata-source", "元数据：x", "transcript", None)] == [True, True, True, False, False]
    assert [one(checks.needs_transcript(F.array(*map(lit, x)))) for x in (("a.Script_Style", "b"), ("c",))] == [True, False]
    assert one(checks.nonempty(F.array(lit("1"), lit(" null"), lit("[]"), lit('"x"'), lit("{}")))) == ["1", '"x"']
    assert [one(checks.is_final_reference(lit(x))) for x in ("skill/a/b.md#p", "skill/../x#p", "skill/a.md", "other/a#p", "skill/a\\b#p")] == [True, False, False, False, False]
    assert [one(checks.trace_verdict(lit(x))) for x in ("not traceable", "creator-specific", "hm")] == ["negative", "positive", "unclear"]
    assert [one(checks.stable_code(lit(x))) for x in ("[ASR_FAILED] x", "ConnectTimeout", "", None)] == ["ASR_FAILED", "NETWORK_TIMEOUT", "UNEXPECTED_ERROR", "UNEXPECTED_ERROR"]


def test_limits_in_order(spark):
    df = spark.createDataFrame([(k, 10) for k in range(40)], "k int, n int").repartition(5)
    assert [tuple(r) for r in checks.first_over(df, "k", "n", 205).collect()] == [(20, 210)]
    assert checks.first_over(df, "k", "n", 400).count() == 0
    assert readers.limit_plan(10, 4) == {"batches": 3, "segments": 1} and readers.limit_plan(10, 4, 9, 2)["segments"] == 5


def test_schema_errors(spark):
    schema = {
        "type": "object", "required": ["id", "tags"], "additionalProperties": False,
        "properties": {"id": {"type": "integer", "minimum": 1}, "tags": {"type": "array", "items": {"type": "string", "pattern": "^t"}, "uniqueItems": True}, "kind": {"enum": ["a", 1]}, "x": {"oneOf": [{"type": "null"}, {"$ref": "#/$defs/y"}]}},
        "$defs": {"y": {"type": "object", "required": ["z"]}},
    }
    texts = ['{"id": 2, "tags": ["t1"], "kind": "a", "x": null}', '{"id": 0, "tags": ["t", "u", "t"], "kind": true, "a/b": 1}', '{"id": "1", "x": {}}', "[]", "{", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, value string")
    got = rows(schemas.schema_errors(df, schema, "k"), "k", "pointer", "keyword")
    want = [(1, "/a~1b", "additionalProperties"), (1, "/id", "minimum"), (1, "/kind", "enum"), (1, "/tags", "uniqueItems"), (1, "/tags/1", "pattern"), (2, "/id", "type"), (2, "/tags", "required"), (2, "/x/z", "required"), (3, "", "type"), (4, "", "json"), (5, "", "json")]
    assert got == sorted(want, key=repr)
    many = spark.createDataFrame([(1, json.dumps({"id": 1, "tags": ["x"] * 3 + [f"u{k}" for k in range(70)]})), (2, texts[0])], "k int, value string")
    report = {r["k"]: r for r in schemas.schema_report(many, schema, "k").collect()}
    assert (report[1]["errors"], len(report[1]["pointers"]), report[1]["truncated"]) == (74, 50, True) and report[2]["valid"] and report[2]["pointers"] == []


def test_files_of_a_run(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.md").write_text("\ufeffhello")
    (tmp_path / "deep" / "b.txt").write_bytes(b"\xff\xfe")
    (tmp_path / "c.bin").write_text("no")
    (tmp_path / "input.json").write_text('{"a": 1}')
    (tmp_path / "list.json").write_text("[1]")
    (tmp_path / "big.json").write_text("{" + " " * 200 + "}")
    found = {r["path"]: (r["is_utf8"], r["text"]) for r in readers.final_documents(spark, str(tmp_path)).collect()}
    assert found["a.md"] == (True, "hello") and found["deep/b.txt"] == (False, None) and "c.bin" not in found
    states = rows(readers.manifests(spark, str(tmp_path), ["input.json", "list.json", "big.json", "none.json"], max_bytes=100), "path", "state")
    assert states == [("big.json", "too_large"), ("input.json", "ok"), ("list.json", "invalid"), ("none.json", "missing")]


def test_entity_dictionary(spark, tmp_path):
    entity = {"canonical_term": " OpenAI ", "aliases": ["Open AI"], "category": "ai_lab", "impact": "high"}
    path = tmp_path / "d.json"
    path.write_text(json.dumps({"schema_version": 1, "entities": [entity]}))
    assert tuple(readers.entity_dictionary(spark, str(path)).first()) == ("OpenAI", ["Open AI"], "ai_lab", "high", "")
    for bad in ({**entity, "impact": "huge"}, {**entity, "category": "A b"}, {**entity, "aliases": ["x"] * 51}, {**entity, "canonical_term": " "}):
        path.write_text(json.dumps({"entities": [bad]}))
        with pytest.raises(ValueError):
            readers.entity_dictionary(spark, str(path))
    with pytest.raises(readers.LimitExceeded):
        readers.entity_dictionary(spark, str(path), max_bytes=10)


def test_paths_and_layers(spark):
    raw = F.lit('{"a": [{"b": 1}, {"b": {"0": "x"}}]}')
    assert [spark.range(1).select(checks.dotted(raw, p)).first()[0] for p in ("a.1.b.0", "a.0.b", "a.5.b", "z")] == ["x", "1", None, None]
    layers = spark.createDataFrame([(0, "default", "k", "1"), (1, "file", "k", None), (2, "env", "k", "3"), (0, "default", "m", "x")], "rank int, source string, key string, value string")
    assert rows(checks.layered(layers), "key", "value", "source") == [("k", "3", "env"), ("m", "x", "default")]


def test_items_anywhere(spark):
    pages = ['{"log": [{"n": 1}], "r": {"x": {"videos": [{"id": "1", "desc": "a"}, 3, {"id": "2", "video": {"play_addr": "http://v"}}]}}}', '[{"title": "t"}]', '{"list": []}', "{"]
    df = spark.createDataFrame(list(enumerate(pages)), "path int, value string")
    got = [(r["page"], r["position"], json.loads(r["item"]).get("id")) for r in checks.inferred_items(df).orderBy("page", "position").collect()]
    assert got == [(0, 0, "1"), (0, 1, "2"), (1, 0, None)]


def test_event_stream(spark, tmp_path):
    schema = "event_id long, ts timestamp, event_type string"
    first = [(1, "2026-01-01 00:10:00", "view"), (2, "2026-01-01 00:50:00", "click"), (1, "2026-01-01 00:10:00", "view")]
    last = [(9, "2026-01-01 03:00:00", "view"), (10, "2026-01-01 06:00:00", "view")]
    source = f"{tmp_path}/in"
    for rows_ in (first, last):
        spark.createDataFrame(rows_, "event_id long, ts string, event_type string").selectExpr("event_id", "to_timestamp(ts) ts", "event_type").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    once = streaming.without_repeated_events(stream).writeStream.format("memory").queryName("once").option("checkpointLocation", f"{tmp_path}/a").trigger(availableNow=True).start()
    once.awaitTermination(120)
    assert sorted(r["event_id"] for r in spark.table("once").collect()) == [1, 2, 9, 10]
    counts = streaming.counts_by_window(stream).writeStream.format("memory").queryName("counts").outputMode("append").option("checkpointLocation", f"{tmp_path}/b").trigger(availableNow=True).start()
    counts.awaitTermination(120)
    got = {(r["window"]["start"].hour, r["event_type"]): r["n"] for r in spark.table("counts").collect()}
    # windows that the watermark hasn't passed stay open
    assert got == {(0, "view"): 2, (0, "click"): 1, (3, "view"): 1}


def test_scratch_tables_go_with_their_scope(spark):
    import os

    def there(df):
        return os.path.exists(df._scratch.removeprefix("file:"))

    with scratch.scope() as kept:
        a, b = (scratch.written(spark.range(3), "x") for _ in range(2))
        kept.append(b)
        assert there(a) and there(b)
    assert not there(a) and there(b) and b.count() == 3
    scratch.dropped(b)
    assert not there(b)


def phrases_by_rule(docs, tokens):
    """repeated_phrases() by sets and substrings: {phrase: (documents, occurrences, tokens)}."""
    at = {}
    for vid, said in docs:
        for n, part in enumerate(text_parts(said)):
            words = tokens(part)
            for k in range(2, 7):
                for i in range(len(words) - k + 1):
                    run = words[i : i + k]
                    phrase = ("" if all("一" <= w[0] <= "鿿" for w in run) else " ").join(run)
                    if sum(map(phrases._is_term, run)) >= 2 and 4 <= len(phrase.replace(" ", "")) <= 32 and len(set(phrase)) > 2:
                        at.setdefault(phrase, []).append((vid, n, k))
    seen = {p: frozenset(v for v, _, _ in x) for p, x in at.items()}
    rank = {p: (-len(seen[p]), -max(x)[2], -len(x), p) for p, x in at.items() if len(seen[p]) > 1}
    return {p: (-r[0], -r[2], -r[1]) for p, r in rank.items() if not any(p in q and seen[q] == seen[p] and rank[q] < r for q in rank)}


def text_parts(said):
    return [p for p in re.split("[。.!?\n]", said) if p.strip()]


def test_phrases_in_rounds_by_brute_force(spark, monkeypatch):
    """Several rounds and buckets, copies, an id of three rows, runs of characters that other tokens give too."""
    monkeypatch.setattr(phrases, "BUCKET_WINDOWS", 300)
    rng = random.Random(8)
    words = ["an", "than", "the", "then", "other", "aa", "a", "alpha", "beta", "火候", "控制", "控制火候", "保持"]
    docs = [(str(i), "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))) for _ in range(4))) for i in range(30)]
    docs += [("c1", docs[3][1]), ("c2", docs[3][1] + "\nthan other 火候"), ("r", "alpha beta then 控制"), ("r", "the alpha beta then 控制 火候"), ("r", "")]
    df = spark.createDataFrame([(v, None, t) for v, t in docs], "video_id string, title string, text string").repartition(3)
    want = phrases_by_rule(docs, str.split)
    got = {r[0]: tuple(r[1:4]) for r in terms.repeated_phrases(df).select("phrase", "document_frequency", "total_frequency", "n_tokens").collect()}
    assert len(want) > 100 and got == want


def test_phrases_inside_earlier_ones(monkeypatch):
    rng = random.Random(3)
    many = list(dict.fromkeys("".join(rng.choice("ab ") for _ in range(rng.randint(4, 9))) for _ in range(400)))
    want = [any(p in q for q in many[:i]) for i, p in enumerate(many)]
    assert phrases._inside_earlier(many) == want
    monkeypatch.setattr(phrases, "FEW", 0)
    assert phrases._inside_earlier(many) == want


def most_shuffled(spark, run):
    """Bytes that the stage of run() with the largest shuffle writes."""
    sc, jvm = spark.sparkContext, spark._jvm
    stages = lambda: sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    begun = max((stages().apply(i).stageId() for i in range(stages().size())), default=-1)
    run()
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    found = stages()
    return max(found.apply(i).shuffleWriteBytes() for i in range(found.size()) if found.apply(i).stageId() > begun)


def made_up(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("bcdfgst") + rng.choice("aeiou") for _ in range(3)) for _ in range(3000)]
    rows = [(str(i), None, "\n".join(" ".join(rng.choices(words, k=12)) for _ in range(150))) for i in range(60)]
    return rows, spark.createDataFrame(rows, "video_id string, title string, text string").repartition(2)


def test_phrases_are_never_dealt_as_rows(spark, monkeypatch):
    """Windows are five a token; a round deals a small part of them."""
    monkeypatch.setattr(phrases, "BUCKET_WINDOWS", 20_000)
    rows, df = made_up(spark)
    assert most_shuffled(spark, lambda: terms.repeated_phrases(df).collect()) < 3 * sum(len(r[2]) for r in rows)


def test_top_phrases_are_never_dealt_as_rows(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BUCKET_WINDOWS", 20_000)
    rows, df = made_up(spark)
    assert most_shuffled(spark, lambda: terms.top_phrases(df).collect()) < 3 * sum(len(r[2]) for r in rows)
