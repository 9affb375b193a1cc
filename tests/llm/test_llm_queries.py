"""Registered queries against DuckDB or brute force on the smallest tables."""

import hashlib
import zlib

import numpy as np
import pytest

import brute
from lakeward.llm import registry
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module")
def docs(con):
    return con.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_against_sql(spark, con, name):
    res = compare(spark, con, name, SF, registry.QUERIES[name], registry.SQL[name])
    assert res["ok"], res


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in registry.QUERIES} == set(range(1, 14))


def test_shards_are_balanced_and_gapless(spark, docs):
    rows = registry.QUERIES["op6_hash_ring"](spark, SF).collect()
    assert len(rows) == len(docs)
    texts = dict(docs)
    by_shard = {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "rows")
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert set(by_shard) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [len(s) for s in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1


def test_personal_data_against_brute_force(spark, docs):
    rows = {r.doc_id: r for r in registry.QUERIES["op7_pii_disclosure"](spark, SF).collect()}
    terms = brute.term_spans([t for _, t in docs])
    assert sum(map(len, terms)) > 0
    kinds = [k for k, _ in brute.BASE]
    for (doc_id, text), more in zip(docs, terms):
        base = brute.base_spans(text)
        r = rows[doc_id]
        assert [r[f"n_{k}"] for k in kinds] == [sum(s[1] == i for s in base) for i in range(4)]
        written = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b, _ in base)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        every = sorted([(a, k, b) for a, k, b, _ in base] + [(a, 4, b) for a, b in more])
        assert r.spans == ",".join(f"{[*kinds, 'term'][k]}:{a}:{b}" for a, k, b in every)


def test_bpe_against_the_tokenizers_library(spark, docs):
    rows = {r.doc_id: r for r in registry.QUERIES["op9_bpe_roundtrip"](spark, SF).collect()}
    ref = brute.tokenizer()
    for doc_id, text in docs:
        ids = ref.encode(text or "", add_special_tokens=False).ids
        back = ref.decode(ids, skip_special_tokens=False)
        assert rows[doc_id].n_tokens == len(ids)
        assert rows[doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[doc_id].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_periodic_runs_against_brute_force(spark, docs):
    rows = {r.doc_id: r for r in registry.QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(rows) == len(docs) and sum(r.n_runs > 0 for r in rows.values()) >= 10
    for doc_id, text in docs:
        assert tuple(rows[doc_id])[1:] == brute.run_columns(doc_id, text), doc_id
