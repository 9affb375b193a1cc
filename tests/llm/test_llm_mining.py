"""Collocations, periodic runs and the metric tree: edges, and brute force at other settings."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from lakeward.llm import collocations, metric_tree, runs
from test_llm_edges import make_docs, rows  # noqa: F401


# ------------------------------------------------------------------ collocations

def phrases_text(rng, n, words):
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "\x0b"]) for _ in range(n))


@pytest.mark.parametrize("shard_bytes, support", [(1 << 20, 30), (12_000, 30), (2_000, 40), (50, 25)])
def test_collocations_at_any_shard_size(spark, shard_bytes, support):
    """Local supports from the whole one down to 1."""
    rng = random.Random(shard_bytes)
    words = ["New", "york", "city", "hall", "\u00e9t\u00e9", "a", "B", "of", "the", "rare"]
    data = [(rng.choice(["en", "en", "en", "fr", None]), phrases_text(rng, rng.randint(0, 60), words)) for _ in range(500)]
    docs = spark.createDataFrame(data, "lang string, text string").repartition(3)
    got = collocations.collocations(docs, support=support, top=40, shard_bytes=shard_bytes).collect()
    want = brute.collocations(data, support=support, top=40)
    assert want and sorted(map(tuple, got)) == want


def test_collocations_edges(spark, rows):  # noqa: F811
    docs = make_docs(spark, rows)
    got = collocations.collocations(docs, support=3, shard_bytes=1000).collect()
    want = brute.collocations([(lang, t) for _, t, lang in rows], support=3)
    assert sorted(map(tuple, got)) == want and {r.lang for r in got} >= {"en", "fr"}
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(docs.where("text IS NULL")).collect() == []


def test_und_is_one_language(spark):
    data = [(None, "one two three"), ("und", "one two four")] * 20
    docs = spark.createDataFrame(data, "lang string, text string")
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == brute.collocations(data)


def test_scores_beyond_64_bits(spark, monkeypatch):
    big = 9 * 10 ** 15
    counts = [("en", "", 10 ** 17), ("en", "x", big + 7), ("en", "y", big + 1), ("en", "x y", big)]
    monkeypatch.setattr(collocations, "frequent_phrases",
                        lambda *a: spark.createDataFrame(counts, "lang string, phrase string, n long"))
    row, = collocations.collocations(spark.createDataFrame([], "lang string, text string")).collect()
    assert row.score == 2_000_000 * big // (2 * big + 8) and (row.l, row.r) == (big + 7, big + 1)


def test_a_full_bitmap_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FILTER_BITS", 7)
    rng = random.Random(3)
    data = [("en", phrases_text(rng, 40, ["a", "b", "c", "d e", "f"])) for _ in range(60)]
    docs = spark.createDataFrame(data, "lang string, text string")
    got = collocations.frequent_phrases(docs, 8, 4, 500).where("phrase <> ''").collect()
    by = {}
    for _, t in data:
        for piece in re.split("[.,;:!?\x0A-\x0D]", t):
            w = piece.split()
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    by[" ".join(w[i:i + k])] = by.get(" ".join(w[i:i + k]), 0) + 1
    assert {r.phrase: r.n for r in got} == {p: n for p, n in by.items() if n >= 8}


# ------------------------------------------------------------------ periodic runs

word_lists = st.lists(st.lists(st.integers(0, 2), max_size=70), min_size=1, max_size=4)


@settings(max_examples=200, deadline=None)
@given(word_lists, st.integers(2, 30))
def test_runs_of_any_least_length(lists, least):
    got = runs.find_runs(np.array([x for w in lists for x in w], np.int64), [len(w) for w in lists], least)
    assert [tuple(map(int, r)) for r in got] == [(d, *r) for d, w in enumerate(lists) for r in brute.runs(w, least)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(2, 9), st.integers(0, 39), st.integers(0, 30))
def test_planted_periods(unit, times, more, before):
    w = [9 + i for i in range(before)] + unit * times + unit[:more % len(unit)]
    got = runs.find_runs(np.array(w, np.int64), [len(w)])
    assert [tuple(map(int, r[1:])) for r in got] == brute.runs(w)


def test_a_long_text_of_one_word_is_one_run():
    assert runs.find_runs(np.zeros(100_000, np.int64), [100_000]).tolist() == [[0, 0, 100_000, 1]]


def test_run_edges(spark, rows):  # noqa: F811
    docs = make_docs(spark, [r for r in rows if r[0] is None or r[0] not in (9, 13)] + [(13, "word " * 60, "en")])
    for got in runs.run_digests(docs).collect():
        texts = [t for i, t, _ in rows if i == got.doc_id] if got.doc_id != 13 else ["word " * 60]
        assert got.doc_id is None or tuple(got)[1:] in [brute.run_columns(got.doc_id, t) for t in texts]
    assert runs.run_digests(docs.limit(0)).collect() == []


def test_with_runs_keeps_columns(spark):
    docs = make_docs(spark, [(1, "a b c " * 6 + "d", "en"), (2, None, "en"), (3, " x  y ", None)]).withColumn("runs", F.lit("mine"))
    out = {r.doc_id: r for r in runs.with_runs(docs).collect()}
    assert [tuple(x) for x in out[1].runs] == [(0, 18, 3)] and out[1].collapsed == "a b c d"
    assert (out[2].runs, out[2].collapsed, out[3].collapsed, out[3].key) == ([], "", "x y", "x1")


# ------------------------------------------------------------------ metric tree

def vectors(rng, n, dim, kinds=None):
    if kinds:
        base = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(kinds)]
        return [[x + rng.gauss(0, 0.02) for x in rng.choice(base)] for _ in range(n)]
    return [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(n)]


@pytest.mark.parametrize("dim, kinds, chunk", [(3, None, 40), (16, 6, 64), (2, 4, 7)])
def test_top_scores_through_many_pages(spark, dim, kinds, chunk):
    rng = random.Random(dim)
    data = list(enumerate(vectors(rng, 500, dim, kinds)))
    data += [(1000 + i, data[7][1]) for i in range(200)]  # one vector is a third of the rows
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(3)
    got = metric_tree.top_scores(df, F.col("id") % 50 == 0, routes=9, chunk_rows=chunk, page=8, block=5).collect()
    assert sorted(map(tuple, got)) == brute.top_scores(data)


def test_pages_and_bounds_hold_their_rows():
    rng = random.Random(4)
    rows = [[int(256 * x) for x in v] for v in vectors(rng, 300, 4, 9)]
    made = metric_tree._pages(pd.DataFrame({"id": range(300), "vector": rows, "dim": 4, "route": 0, "chunk": 0}), 10)
    assert sorted(i for ids in made["ids"] for i in ids) == list(range(300)) and made["ids"].map(len).max() <= 10
    chunk = metric_tree.Chunk(made)
    query = np.array([100, -50, 25, 7])
    best = sorted(chunk.best(-1, query, 5, None), reverse=True)
    assert best == sorted(((int(np.dot(query, v)), -i) for i, v in enumerate(rows)), reverse=True)[:5]


def test_metric_tree_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [0.5, -0.5]), (50, [0.5, -0.5]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [1.0, inf]),
            (None, [1.0, 1.0]), (5, [1.0, 1.0, 1.0]), (100, [1.0, 2.0, 3.0]), (6, []), (150, []), (7, [0.1, 0.2]),
            (7, [0.1, 0.2]), (8, [-0.001, 0.0]), (9, [0.5, -0.5]), (-50, [3.0, 4.0]), (10, [0.5, 0.5]), (200, None)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    for c in ("id", "dim", "vector", "rank", "score", "route", "chunk"):
        df = df.withColumn(c, F.lit("x"))
    got = metric_tree.top_scores(df, F.col("id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == brute.top_scores(data)
    assert metric_tree.top_scores(df.limit(0), F.col("id") % 50 == 0).collect() == []
    one = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<double>")
    assert metric_tree.top_scores(one, F.col("id") % 50 == 0).collect() == []
    with pytest.raises(Exception, match="64-bit"):
        metric_tree.top_scores(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>"),
                               F.col("id") % 50 == 0).collect()
