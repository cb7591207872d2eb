"""Every catalogue query against its SQL on the smallest tables."""

import re
from collections import defaultdict

import duckdb
import pytest

from corposcope.functions import text
from corposcope.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_same_rows(spark, db, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted([tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect()], key=repr)
    found = db.execute(catalogue.SQL[name])
    names = [d[0] for d in found.description]
    theirs = sorted([tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()], key=repr)
    assert sorted(names) == columns
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


LINES = {
    1: "the red brick house stands, alone in green fields\nred brick house again; art trees",
    2: "red brick house stands. smart trees and green fields",
    3: "a red brick wall\nsmart trees and green fields. red brick house stands",
    4: None,
    5: "green fields",
}


@pytest.fixture
def small(spark, tmp_path):
    spark.createDataFrame(list(LINES.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def sentence_terms():
    for i, t in LINES.items():
        for part in re.findall(text.SENTENCE, t or ""):
            yield str(i), re.findall(r"[a-z]+", part)


def good(word):
    return word not in text.STOPWORDS and 2 <= len(word) <= 64


def test_phrases_of_documents(spark, small):
    seen = defaultdict(list)
    for i, words in sentence_terms():
        for n in range(2, 7):
            for k in range(len(words) - n + 1):
                run = words[k : k + n]
                if sum(map(good, run)) >= 2 and 4 <= len("".join(run)) <= 32 and len(set(" ".join(run))) > 2:
                    seen[" ".join(run)].append((i, n))
    rank = {p: (-len({i for i, _ in at}), -max(n for _, n in at), -len(at), p) for p, at in seen.items() if len({i for i, _ in at}) >= 2}
    docs = {p: {i for i, _ in seen[p]} for p in rank}
    want = {p: (-r[0], -r[2]) for p, r in rank.items() if not any(p in q and q != p and docs[q] == docs[p] and rank[q] < r for q in rank)}
    got = {r["phrase"]: (r["document_frequency"], r["total_frequency"]) for r in catalogue.QUERIES["document_phrases"](spark, small).collect()}
    assert len(want) > 2 and got == want


def test_distinct_terms_of_documents(spark, small):
    at = defaultdict(list)
    for i, words in sentence_terms():
        for w in filter(good, words):
            at[w].append(i)
    groups = defaultdict(list)
    for w, ids in at.items():
        if len(set(ids)) >= 2:
            groups[frozenset(ids)].append((-len(ids), -len(w), w))
    want = []
    for ids, found in groups.items():
        picked = []
        for *_, w in sorted(found):
            if len(picked) < 6 and not any(w in x or x in w for x in picked):
                picked.append(w)
        want.append((min(ids), len(ids), ",".join(picked)))
    got = [tuple(r) for r in catalogue.QUERIES["distinct_terms"](spark, small).select("first_id", "document_frequency", "picked").collect()]
    assert len(want) > 1 and sorted(got) == sorted(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 100
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
