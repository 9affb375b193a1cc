"""The corpus pipeline, stage by stage against brute force."""

import pytest

import brute
import corpus_pipeline
from oracle_harness import duck

SF = "/root/testdata/sf0.001"


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "bpe_encoding"]


def test_pipeline_against_brute_force(spark):
    con = duck(SF)
    keep = brute.kept_by_rules(con, "documents")
    docs = [r for r in con.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall() if keep[r[0]]]
    cut = [(i, brute.without_lines(t, gone)) for (i, t), gone in zip(docs, brute.line_dedup(docs))]
    docs = [(i, t) for (i, t), (_, old) in zip(cut, docs) if t == old or t.strip(" \t\n\x0b\f\r")]
    docs = [(i, t) for (i, t), (n, c, _) in zip(docs, brute.jaccard(docs)) if not n or c == i]
    items = con.sql("SELECT item_id, text FROM benchmark").fetchall()
    grams = [set(zip(*[w[k:] for k in range(4)])) for w in (brute.norm(t) for _, t in items)]
    out = {}
    for i, t in docs:
        w = brute.norm(t)
        own = set(zip(*[w[k:] for k in range(4)]))
        near = [item for item, g in zip(items, grams) if own & g]  # every overlap shares four words
        if not brute.contaminated(t, near):
            out[i] = brute.tokenizer_once().encode(t or "", add_special_tokens=False).ids
    got = {r.doc_id: list(r.token_ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == out
    assert 0 < len(out) < 200


def test_stages_keep_columns_and_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name


@pytest.mark.parametrize("extra", ["kept", "key", "n", "shard", "words"])
def test_stages_keep_clashing_columns(spark, extra):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn(extra, F.lit("mine"))
    out = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert out.columns == docs.columns and {r[extra] for r in out.select(extra).distinct().collect()} == {"mine"}


def test_no_exact_copy_leaves_the_pipeline(spark):
    from pyspark.sql import functions as F
    con = duck(SF)
    keep = brute.kept_by_rules(con, "documents")
    rows = [r for r in con.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall() if keep[r[0]]]
    firsts = {}
    copies = [i for i, t in rows if firsts.setdefault(t, i) != i and t.strip()]
    assert len(copies) >= 6
    left = corpus_pipeline.run(spark, SF).where(F.col("doc_id").isin(copies))
    assert left.count() == 0
