"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from lakeward.llm import (bpe, chat, components, decontam, line_dedup, ngram_join, phrases, pii,
                          quality, sharding, warc)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHES = ["n", "key", "node", "words", "token", "doc", "stratum", "f", "kept", "shard", "size", "wh",
           "at", "seed", "text_key", "spans", "found", "starts", "m_doc", "removed", "g_row", "k_id",
           "bad_id", "token_ids2", "line", "lines", "cut_symbols", "base_failed", "component", "w"]


def make_docs(spark, rows):
    df = spark.createDataFrame([(i, t, lang, "s", None) for i, t, lang in rows], SCHEMA)
    for k, c in enumerate(CLASHES):
        df = df.withColumn(c, F.lit(f"x{k}"))
    return df


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = sentence(rng, 120)
    near = base.split(" ")
    near[60] = "changed"
    long = sentence(rng, 30_000)
    return [(1, base, "en"), (2, base, "en"), (2, base, "en"), (3, " ".join(near), None),
            (4, None, "en"), (5, "", "fr"), (6, " \n\t\x0b ", None), (7, "one two", "en"),
            (8, "one  two", "en"), (9, long, "de"), (10, "\n".join([sentence(rng, 9)] * 3), "en"),
            (None, sentence(rng, 60), "en"), (None, None, None), (11, "x" * 200_000, "en"),
            (12, "é日本😀 " * 30, "fr"), (13, "word " * 500, "en")]


def columns_of(df):
    return df.columns


def test_ngram_join_edges(spark, rows):
    got = ngram_join.jaccard_components(make_docs(spark, rows)).collect()
    want = brute.jaccard([(i, t) for i, t, _ in rows])
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0, r[3])
    assert sorted([(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got], key=key) == sorted(
        [(rows[k][0], n, c if n else rows[k][0], links) for k, (n, c, links) in enumerate(want)], key=key)


def test_one_row_of_each_component_stays(spark, rows):
    docs = make_docs(spark, rows)
    kept = ngram_join.one_per_component(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13]


def test_texts_without_an_id_meet_like_others(spark):
    """Near copies without an id, of documents with one and of each other, and repeated ids."""
    rng = random.Random(15)

    def family(k):
        base = sentence(rng, 100).split(" ")
        return [" ".join([*base[:50 + j], f"new{j}", *base[51 + j:]]) for j in range(k)]

    a, b, c, d = family(4), family(4), family(3), family(2)
    rows = [(5, a[0], "en"), (None, a[1], "en"), (None, a[2], "en"), (6, a[3], "en")]    # one: 5
    rows += [(None, t, "en") for t in [*b, b[0], b[1].upper(), b[1].replace(" ", "  ")]]  # one of them
    rows += [(7, c[0], "en"), (7, c[1], "en"), (7, c[1], "en"), (8, c[2], "en")]         # one of id 7
    rows += [(9, d[0], "en"), (9, sentence(rng, 40), "en"), (4, d[1], "en")]             # 4 and the other 9
    rows += [(None, None, "en"), (None, " ", "en"), (None, sentence(rng, 30), "en"), (10, "", "en")]
    docs = make_docs(spark, rows)
    got = ngram_join.jaccard_components(docs).collect()
    want = brute.jaccard([(i, t) for i, t, _ in rows])
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0, r[3])
    assert sorted([(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got], key=key) == sorted(
        [(rows[k][0], n, x if n else rows[k][0], links) for k, (n, x, links) in enumerate(want)], key=key)
    kept = [(r.doc_id, r.text) for r in ngram_join.one_per_component(docs).collect()]
    ids = [i for i, _ in kept if i is not None]
    assert sorted(ids) == [4, 5, 7, 9, 10] and dict(kept)[9] == rows[-6][1]
    without = [t for i, t in kept if i is None]
    assert sum(t in {r[1] for r in rows[4:11]} for t in without) == 1
    assert sum(t in set(a) for t in without) == 0 and len(without) == 4


def test_blocks_and_long_runs_lose_no_link(spark):
    """Tiny blocks and pair runs drive cells through bands, block pairs and stars."""
    rng = random.Random(9)
    out = []
    for g in range(4):
        base = sentence(rng, 80 + 30 * g).split(" ")
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = sentence(rng, 1)
            out.append(" ".join(w[rng.randint(0, 8):]))
    docs = [(k, t) for k, t in enumerate(out)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want = {i: w for (i, _), w in zip(docs, brute.jaccard(docs))}
    old = ngram_join.PAIR_RUN
    for block in (150, 1000, 10**6):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links)
               for r in ngram_join.jaccard_components(frame, block=block).collect()}
        assert got == want, block
    assert old == ngram_join.PAIR_RUN


def test_divide_skip_finds_what_counting_finds():
    import numpy as np
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, size=rng.integers(5, 40)).astype(np.uint64)) for _ in range(60)]
    sets.sort(key=len)
    index = ngram_join.BlockIndex(sets)
    for i in range(len(sets)):
        found, overlap = index.query(i)
        need = ngram_join.least_overlap(len(sets[i]))
        want = {j: len(np.intersect1d(sets[i], sets[j])) for j in range(i)}
        assert dict(zip(found.tolist(), overlap.tolist())) == {j: o for j, o in want.items() if o >= need}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges, "a", "b", "t").collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}
    assert components.components(edges.where("a < 0"), "a", "b", "t").count() == 0


def test_quality_edges(spark, rows):
    docs = make_docs(spark, rows)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0)],
                                   "doc_id long, quality int, toxic int")
    kept = quality.kept_documents(docs, labels)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id or -1 for r in kept.select("doc_id").collect())
    assert ids == [-1, 1, 2, 2, 3, 9]  # no rule can be certified; the base rules decide
    none = quality.kept_documents(docs.limit(0), labels.limit(0))
    assert none.count() == 0 and none.columns == docs.columns


def test_quality_thresholds_hold_their_bound(spark):
    """A rule that good documents break too often is never certified; a clean one is."""
    n = 4000
    counts = spark.createDataFrame(
        [("en", "symbols", 0, n, 10), ("en", "symbols", 9, 0, 300),
         ("en", "repeats", 0, n - 200, 100), ("en", "repeats", 12, 200, 250)],
        "stratum string, rule string, above int, good long, bad long")
    got = quality.thresholds(counts).first()
    assert got.cut_symbols == 150 and got.cut_repeats is None  # 9 cutoffs lie below the bad scores


def test_binomial_tail_is_exact(spark):
    import math
    cases = [(10, 0), (200, 0), (1000, 3), (5000, 12), (300000, 1400)]
    df = spark.createDataFrame(cases, "n long, k long")
    got = df.select("n", "k", quality.binomial_tail(F.col("n"), F.col("k"), 0.005).alias("p")).collect()
    for r in got:
        want = sum(math.exp(math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1)
                            + i * math.log(0.005) + (r.n - i) * math.log(0.995)) for i in range(r.k + 1))
        assert r.p == pytest.approx(want, rel=1e-6)


def test_chat_layouts_and_unmapped(spark):
    records = [
        ("a", "0", '{"messages":[{"role":"user","content":"hi"},{"role":"assistant","content":null}]}'),
        ("b", "0", '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"r"}],"id":7}'),
        ("c", "0", '{"instruction":"do","input":"this","output":"done"}'),
        ("d", "0", '{"system":"s","prompt":"p","completion":"c"}'),
        ("e", "0", '{"something":"else"}'), ("f", "0", "not json"), ("g", "0", None), ("h", "0", "[]"),
        ("i", "0", '{"messages":[]}')]
    df = spark.createDataFrame(records, "conv string, turn string, record string")
    got = {}
    for r in chat.canonical_turns(df).orderBy("conv", "pos").collect():
        got.setdefault(r.conv, []).append((r.role, r.text, r.layout))
    assert got["a"] == [("user", "hi", "messages"), ("assistant", "", "messages")]
    assert got["b"] == [("user", "q", "from_value"), ("assistant", "r", "from_value")]
    assert got["c"] == [("user", "do\n\nthis", "instruction"), ("assistant", "done", "instruction")]
    assert [x[0] for x in got["d"]] == ["system", "user", "assistant"]
    assert all(got[k][0][2] == "unmapped" for k in "efgh") and "i" not in got


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>|/s[]INST\\turnex\n ", max_size=60))
def test_escapes_are_reversible(text):
    esc, unesc, piece = chat.Template().patterns()
    t = chat.Template()
    made = chat.escape(text, esc)
    assert chat.unescape(made, unesc) == text
    assert not any(m in made for m in (t.turn, t.text, t.end, *t.reserved))
    m = piece.fullmatch(t.turn + made + t.text + made + t.end)
    assert (m[1], m[2]) == (made, made)


def test_chat_edges(spark):
    rows = [(1, 1, "assistant", "</s><|turn|>"), (1, 0, "user", None), (None, 0, None, "x"),
            (2, 0, "gpt", "<\\/s>"), (2, 0, "gpt", "<\\/s>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv: r for r in chat.chat_digests(df).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got["1"].turns_sha256 == sha("user\n\nassistant\n</s><|turn|>\n")
    assert (got["1"].loss_chars, got["1"].loss_sha256) == (12, sha("</s><|turn|>"))
    assert got[None].turns_sha256 == sha("\nx\n")
    assert got["2"].turns_sha256 == sha("gpt\n<\\/s>\n" * 2) and got["2"].loss_chars == 0
    assert chat.chat_digests(df.limit(0)).count() == 0


def test_warc_round_trip_in_small_chunks(spark, workdir):
    big = "é" * 5000 + "\r\n\r\nWARC/1.0\r\n"
    rows = [(1, "http://a\r\nX: y", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "x" * 999),
            (6, "u", "x" * 999), (7, "u", big), (7, "u", big), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha1", F.lit(1))
    manifest = warc.archive_pages(pages, workdir)
    chunks = warc.read_chunks(manifest, workdir, chunk=700).collect()
    records = {}
    for r in sorted(chunks, key=lambda r: (r.file, r.range_start, r.record_no, r.chunk_no)):
        records.setdefault((r.file, r.range_start, r.record_no), []).append(r)
    seen = []
    for parts in records.values():
        last = parts[-1]
        assert [p.chunk_no for p in parts] == list(range(len(parts))) and last.is_last
        page = warc.uri_page(last.uri)
        payload = b"".join(bytes(p.data or b"") for p in parts)
        if last.record_type == "response":
            assert payload == (dict((r[0], r[2]) for r in rows)[int(page)] or "").encode()
            assert hashlib.sha1(payload).hexdigest() == last.payload_sha1
            assert all(len(p.data) <= 700 for p in parts)
        seen.append((page, last.record_type, warc.uri_page(last.refers_uri), last.payload_bytes))
    n = len(big.encode())
    assert sorted(seen, key=str) == sorted([
        ("1", "revisit", "7", n), ("2", "revisit", "7", n), ("3", "response", None, 0),
        ("4", "response", None, 0), ("5", "response", None, 999), ("6", "response", None, 999),
        ("7", "response", None, n), ("7", "response", None, n), (None, "revisit", "7", n)], key=str)
    assert warc.read_chunks(warc.archive_pages(pages.limit(0), workdir + "x"), workdir + "x").count() == 0
    table = spark.createDataFrame(chunks, warc.read_chunks(manifest, workdir, chunk=700).schema)
    assert warc.records(table).count() == sum(r.is_last for r in chunks)
    for lost in ("chunk_no <> 1", "NOT is_last", "chunk_no <> 0 OR is_last"):
        with pytest.raises(Exception, match="missing or repeated"):
            warc.records(table.where(lost)).collect()


@pytest.mark.parametrize("frame", [1, 16])
def test_line_dedup_against_brute_force(spark, frame):
    """A frame of one neighbour drives near lines through the rest of long token groups."""
    rng = random.Random(frame)
    base = [sentence(rng, rng.randint(4, 25)) for _ in range(12)]
    docs = []
    for k in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            w = rng.choice(base).split(" ")
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice("pqrstuvw") * rng.randint(1, 3)
            lines.append(" ".join(w))
        docs.append((k, "\n".join(lines)))
    frame_docs = spark.createDataFrame(docs, "doc_id long, text string")
    gone = {r.doc_row: r.removed for r in line_dedup.removed_lines(frame_docs, frame).collect()}
    got = [(r.doc_id, gone.get(r.doc_row, [])) for r in line_dedup._doc_rows(frame_docs).collect()]
    assert dict(got) == {i: g for (i, _), g in zip(docs, brute.line_dedup(docs))}


def test_similar_sets_share_a_token_pair(spark):
    """The prefix of token pairs misses no similar sets, whatever their sizes."""
    rng = random.Random(11)
    pairs = []
    for _ in range(600):
        n = rng.randint(4, 40)
        x = set(rng.sample(range(200), n))
        y = set(x)
        for _ in range(rng.randint(0, 1 + n // 5)):
            if rng.random() < 0.6 and len(y) > 4:
                y.remove(rng.choice(sorted(y)))
            if rng.random() < 0.6:
                y.add(rng.randrange(200))
        if 10 * len(x & y) >= 8 * len(x | y):
            pairs.append((sorted(x), sorted(y)))
    assert len(pairs) > 150
    frame = spark.createDataFrame(pairs, "x array<long>, y array<long>")
    shared = F.arrays_overlap(line_dedup.pair_prefix(F.col("x")), line_dedup.pair_prefix(F.col("y")))
    assert frame.where(~shared).count() == 0


def test_line_dedup_pairs_do_not_grow_with_common_words(spark):
    """Lines of the same few words are in each other's token groups only where they resemble each other."""
    rng = random.Random(12)
    names = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(120)]
    docs = spark.createDataFrame([(k, " ".join(rng.sample(names, 30))) for k in range(400)], "doc_id long, text string")
    ranks = line_dedup.bucket_ranks(docs)
    lines = line_dedup.line_table(docs, ranks)
    tokens = lines.select("key", F.explode("prefix").alias("token"))
    met = tokens.alias("a").join(tokens.alias("b"), "token").where("a.key < b.key").select("a.key", "b.key").distinct()
    assert met.count() < 400 * 399 // 2 // 2  # by single rare words nearly all of the pairs met
    assert line_dedup.removed_lines(docs).count() == 0


def test_bitmaps_lose_no_similar_sets(spark):
    """Sets on both sides of ``SHORT`` words: similar ones stay plausible, others seldom are; short sets hold one long."""
    rng = random.Random(13)
    alike, apart = [], []
    for _ in range(500):
        n = rng.choice([rng.randint(4, 30), rng.randint(60, 120)])
        x = [rng.getrandbits(63) for _ in range(n)]
        y = x[rng.randint(0, n // 10):] + [rng.getrandbits(63) for _ in range(rng.randint(0, n // 10))]
        assert 10 * len(set(x) & set(y)) >= 8 * len(set(x) | set(y)) and y
        alike.append((x, y))
        apart.append((x, [rng.getrandbits(63) for _ in range(n)]))

    def judged(pairs):
        frame = spark.createDataFrame(pairs, "x array<long>, y array<long>")
        sides = [{"n": F.size(c), **dict(zip(line_dedup._BITS, line_dedup._parity(F.col(c))))} for c in ("x", "y")]
        held = F.size(F.filter(F.array(*[sides[0][b] for b in line_dedup._BITS]), lambda b: b.isNotNull()))
        return frame.select(F.size("x").alias("n"), held.alias("held"),
                            line_dedup._plausible(*sides).alias("ok")).collect()

    similar, other = judged(alike), judged(apart)
    assert all(r.ok for r in similar)
    assert sum(r.ok for r in other if r.n > 12) <= 2
    assert all(r.held == (1 if r.n <= line_dedup.SHORT else 4) for r in similar)


def test_rank_order_by_one_xor(spark):
    """A set's keys are its words' hashes with rarer buckets first, and the ranks are whole."""
    docs = spark.createDataFrame([(k, "the of " + f"w{k} w{k % 7}") for k in range(300)], "doc_id long, text string")
    ranks = line_dedup.bucket_ranks(docs)
    held = spark.range(1).select(ranks.alias("ranks"))
    size, kept = held.select(F.size("ranks"), F.size(F.array_distinct(F.transform("ranks", lambda t, i: (
        F.shiftrightunsigned(t, 64 - line_dedup.BUCKET_BITS).bitwiseXOR(i.cast("long"))))))).first()
    assert size == kept == line_dedup.BUCKETS
    row = held.select(line_dedup.line_set(F.lit("the w250 of"), F.col("ranks")).alias("s"),
                      line_dedup.line_set(F.lit("w250"), F.col("ranks")).alias("rare")).first()
    assert len(row.s) == 3 and row.s[0] == row.rare[0]


def test_bitmaps_in_plans_are_small(spark):
    """Bitmaps pass the driver inside plans: 2 MB at most, and no key is missed."""
    keys = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    bits = line_dedup._bits_held(F.col("id"), line_dedup.SHARED_BITS, spark.range(3000))
    assert spark.range(1).select(F.size(bits)).first()[0] * 8 <= 2 << 20
    assert keys.where(~line_dedup._maybe_held(F.col("k"), keys, F.col("k"))).count() == 0


def test_line_dedup_edges(spark, rows):
    docs = make_docs(spark, rows)
    kept = line_dedup.drop_later_lines(docs)
    assert kept.columns == docs.columns
    got = {(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()}
    texts = {i: t for i, t, _ in rows}
    assert (1, texts[1]) in got and (4, None) in got and (5, "") in got and (6, texts[6]) in got
    assert (10, texts[10].split("\n")[0]) in got
    assert not any(i in (2, 3) for i, _ in got)  # their only line repeats that of 1
    assert line_dedup.drop_later_lines(docs.limit(0)).count() == 0


def test_no_copy_lives_on_in_its_short_lines(spark):
    """Every line with a word takes part: equal short sets, and sets of four in sets of five."""
    rng = random.Random(8)
    texts = ["\n".join([sentence(rng, 12), "Tion was.", sentence(rng, 9), f"Es {k}.", "Oued for."]) for k in range(9)]
    texts += texts[:6] + ["a b c d e", "d c b a", "a b c", "c b a c", "", None, " \n ", "Es 0.\n\nnew"]
    docs = make_docs(spark, [(k, t, "en") for k, t in enumerate(texts)])
    got = {r.doc_id: r.text for r in line_dedup.drop_later_lines(docs).collect()}
    want, earlier = {}, []
    for k, text in enumerate(texts):
        kept = []
        for line in (text or "").split("\n"):
            s = set(brute.words(line))
            if not s or not any(18 * len(s & e) >= 8 * (len(s) + len(e)) for e in earlier):
                kept.append(line)
            earlier += [s] if s else []
        left = "\n".join(kept)
        if left == (text or "") or left.strip():
            want[k] = text if left == (text or "") else left
    assert got == want
    assert not set(range(9, 15)) & set(got) and 16 not in got and 18 not in got and got[22] == "\nnew"


def test_sharding_edges(spark, rows):
    docs = make_docs(spark, rows)
    placed = sharding.shard_documents(docs).collect()
    assert len(placed) == len(rows)
    assert sorted((r.shard, r.slot) for r in placed) == sorted({(r.shard, r.slot) for r in placed})
    sizes = [sum(r.shard == s for r in placed) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_sharding_moves_few_rows(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    moved = {}
    for load in (1.0, 1.25):
        a = {r.doc_id: r.shard for r in sharding.shard_documents(rows, 16, load).collect()}
        b = {r.doc_id: r.shard for r in sharding.shard_documents(rows, 17, load).collect()}
        moved[load] = sum(a[k] != b[k] for k in a) / len(a)
        assert max(map(list(a.values()).count, range(16))) <= -(-load * 20_000 // 16)
    assert moved[1.25] < 0.12 and moved[1.0] < 0.2  # 1/17 is the least


def test_ring_plan_follows_a_sequential_ring():
    """With room everywhere every key stays at its first shard; full shards pass keys on."""
    counts = {s: 3 for s in range(0, sharding.RING, 7)}
    route = sharding.routes(16)
    for slot, lo, hi, shard, _ in sharding.plan(counts, 16, load_factor=100):
        assert (lo, hi) == (0, 3) and shard == route[slot][0]
    tight = sharding.plan(counts, 16)
    held = {}
    for slot, lo, hi, shard, base in sorted(tight, key=lambda x: (x[3], x[4])):
        assert base == held.get(shard, 0)
        held[shard] = base + hi - lo
    assert max(held.values()) - min(held.values()) <= 1


def test_personal_data_terms_against_brute_force(spark):
    rng = random.Random(2)
    texts = [sentence(rng, 30) for _ in range(60)]
    texts += [f"{sentence(rng, 12)} Quentin lives at q@x.org, {sentence(rng, 12)}" for _ in range(3)]
    texts += [f"{sentence(rng, 15)} call Zoltan on +1 (743) 555-3824 or 10.1.2.{k % 2} {sentence(rng, 9)}" for k in range(4)]
    texts += [texts[-1]] * 3 + [None, "", "solo@y.org next to Uniqueterm", "solo@y.org next to Uniqueterm",
              "4111 1111 1111 1111", "a@b.co+x@y.z 1.2.3.4.5.6.7.8 256.1.1.1"]
    docs = make_docs(spark, [(k, t, "en") for k, t in enumerate(texts)])
    got = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    want = brute.term_spans(texts)
    assert sum(map(len, want)) >= 7
    for k, t in enumerate(texts):
        assert [(s.start, s.kind, s.end, s.value) for s in got[k].spans] == brute.base_spans(t)
        assert [(s.start, s.end) for s in got[k].terms or []] == want[k], t
    wide = {r.text_key: r.terms for r in pii.disclosing_spans(docs, pii._with_spans(docs), 0)
            .withColumnRenamed("t_key", "text_key").collect()}
    assert {got[k].text_key: got[k].terms for k in got if got[k].terms} == wide
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(texts)
    said = " ".join(r.text for r in clean.select("text").collect() if r.text)
    assert not any(x in said for x in ("Quentin", "q@x.org", "solo@y.org", "Uniqueterm"))
    assert "next to" in said or "[term]" in said
    assert pii.find_personal_data(docs.limit(0)).count() == 0


def test_terms_of_entities_that_occur_once(spark):
    """Exact values count from one text on, groups and kinds by what many different ones share."""
    rng = random.Random(8)
    common = ["alpha", "beta", "gamma", "delta"]
    filler = lambda n: " ".join(rng.choices(common, k=n))
    texts = [filler(30) for _ in range(200)]
    texts += [f"{filler(9)} hotline +1 (555) 555-{1000 + k} {filler(9)}" for k in range(40)]
    texts += [f"{filler(9)} intranet 10.7.{k}.9 {filler(9)}" for k in range(30)]
    texts += [f"{filler(9)} Zebulon u{k}@mail.example.com {filler(9)}" for k in range(25)]
    texts += [f"{filler(9)} u{k}@other.example.com {filler(9)}" for k in range(60)]
    once = len(texts)
    texts += [f"{filler(9)} Perpetua writes from pp@z.org {filler(9)}", f"{filler(9)} Perpetua {filler(9)}"]
    docs = make_docs(spark, [(k, t, "en") for k, t in enumerate(texts)])
    got = {r.doc_id: [t[s.start:s.end] for s in r.terms or []]
           for r in pii.find_personal_data(docs).collect() for t in [texts[r.doc_id]]}
    want = [[t[a:b] for a, b in found] for t, found in zip(texts, brute.term_spans(texts))]
    assert [got[k] for k in range(len(texts))] == want
    assert got[200] == ["hotline"] and got[240] == ["intranet"] and got[270] == ["Zebulon"]
    assert got[once] == ["Perpetua", "writes", "from"] and got[once + 1] == [] and got[0] == []


def test_windows_are_cut_from_the_text(spark):
    """Neighbouring and invalid matches, glued letters, piece borders and wide characters."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdeé𝓐", k=rng.randint(1, 9)))
    entity = lambda: rng.choice([
        "x@y.org", "éx@y.org", "10.0.0.1", "10.0.0.256", "1999", "+1 (555) 555-0000", "4111 1111 1111 1111",
        "x@y.orgé", "a@b.co/c@d.co"])
    texts = ["".join(rng.choice([word, word, word, entity])() + rng.choice([" ", " ", "", "\n", ", "])
                     for _ in range(n)) for n in [3, 10, 40, 200, 800] * 6]
    texts += ["a" * 49 + " bb x@y.org " + "c" * 49 + " dd", "a" * 50 + "x@y.org" + "c" * 50,
              " " + "aé" * 24 + " x@y.org " + "c" * 50, "aé" * 25 + " x@y.org " + "cé" * 24]
    docs = make_docs(spark, [(k, t, "en") for k, t in enumerate(texts)])
    got = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    want = brute.term_spans(texts)
    assert sum(map(len, want)) > 100
    for k, t in enumerate(texts):
        assert [(s.start, s.kind, s.end, s.value) for s in got[k].spans] == brute.base_spans(t)
        assert [(s.start, s.end) for s in got[k].terms or []] == want[k], t


def test_long_runs_of_matches(spark):
    text = " ".join(f"u{k}@h{k}.com 10.0.{k % 256}.1" for k in range(700)) + " " + "9" * 4000 + " 1 2" * 3000
    docs = make_docs(spark, [(1, text, "en")])
    got = pii.find_personal_data(docs).first()
    assert [(s.start, s.kind, s.end, s.value) for s in got.spans] == brute.base_spans(text)


def test_phrases_edges(spark, rows):
    rng = random.Random(1)
    passage = sentence(rng, 40)
    more = [(20 + k, f"{sentence(rng, 5)} {passage} {sentence(rng, 7)}", "en") for k in range(5)]
    more += [(30, "a b " * 40, "en"), (31, "a b " * 25, "en"), (32, sentence(rng, 12), "en")]
    every = [r for r in rows if r[0] is not None] + more
    docs = make_docs(spark, every)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in phrases.repeat_digests(docs).collect())
    want = sorted((i, n, gone, hashlib.sha256(" ".join(kept).encode()).hexdigest())
                  for (i, _, _), (n, gone, kept) in zip(every, brute.repeats([(i, t) for i, t, _ in every])))
    assert got == want
    rewritten = phrases.without_repeats(docs)
    assert rewritten.columns == docs.columns and rewritten.count() == len(every)
    assert phrases.repeat_digests(docs.limit(0)).count() == 0
    with_null = phrases.repeat_digests(make_docs(spark, rows))
    assert with_null.count() == len(rows)


def test_heavy_grams_are_dealt_by_window(spark, monkeypatch):
    """No shard gets more words of one gram than ``SHARD_WORDS``, and the result is the same."""
    rng = random.Random(6)
    phrase = sentence(rng, 6)
    tails = [sentence(rng, 9) for _ in range(4)]
    every = [(k, f"{sentence(rng, 8)} {phrase} {rng.choice(tails)} {sentence(rng, 3)}", "en") for k in range(40)]
    every += [(50 + k, f"{tails[k % 4]} {sentence(rng, 20)} {tails[k % 4]}", "en") for k in range(4)]
    every += [(60, every[0][1] + " " + every[1][1], "en")]
    docs = make_docs(spark, every)
    asked = []
    find = phrases.owned_segments
    monkeypatch.setattr(phrases, "SHARD_WORDS", 100)
    monkeypatch.setattr(phrases, "owned_segments", lambda d: find(asked.append(d) or d))
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in phrases.repeat_digests(docs).collect())
    assert got == sorted((i, n, gone, hashlib.sha256(" ".join(kept).encode()).hexdigest()) for (i, _, _), (n, gone, kept)
                         in zip(every, brute.repeats([(i, t) for i, t, _ in every])))
    most = asked[0].groupBy("gram").agg(F.sum(F.length("segment") / 6).alias("words")).agg(F.max("words")).first()[0]
    assert (most or 0) <= 100 and sum(r[2] for r in got) > 100


def test_small_automata_find_the_same(monkeypatch):
    import numpy as np
    rng = random.Random(4)
    words = sentence(rng, 30).split(" ")
    segments = [" ".join(words[k:k + 18]) for k in range(12)] + [sentence(rng, 18)]
    lo, hi = np.arange(13), np.arange(13)
    whole = phrases.find_owners(segments, lo, hi)
    monkeypatch.setattr(phrases, "AUTOMATON_PHRASES", 3)
    for a, b in zip(whole, phrases.find_owners(segments, lo, hi)):
        assert a.tolist() == b.tolist()
    assert (whole[-1] == phrases.NO_ID).all() and whole[5][0] == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=50), max_size=4))
def test_bpe_equals_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + ["<|endoftext|>a<|endoftext|>", "a" * 50]
    mine = bpe.load(bpe.default_vocab()).encode_batch(texts)
    for t, ids in zip(texts, mine):
        assert ids.tolist() == brute.tokenizer_once().encode(t, add_special_tokens=False).ids
        assert bpe.load(bpe.default_vocab()).decode(ids) == t


def test_bpe_edges(spark, rows):
    docs = make_docs(spark, rows)
    got = bpe.encode_frame(docs)
    assert got.columns == [*docs.columns, "token_ids"] and got.count() == len(rows)
    empty = [r.token_ids for r in got.where("doc_id in (4, 5)").collect()]
    assert empty == [[], []]
    assert bpe.encode_frame(docs.limit(0)).count() == 0
    small = bpe.ByteBpe(bpe.default_vocab())
    small_cache = bpe.CACHE_WORDS
    try:
        bpe.CACHE_WORDS = 300  # forget the words again and again
        texts = [t or "" for _, t, _ in rows]
        assert [x.tolist() for t in texts for x in small.encode_batch([t])] == [
            x.tolist() for x in bpe.load(bpe.default_vocab()).encode_batch(texts)]
    finally:
        bpe.CACHE_WORDS = small_cache


def test_masks_lose_no_tolerated_overlap():
    """Every placement of the allowed substitutions leaves some mask window untouched."""
    from itertools import combinations
    for n in range(decontam.MIN_WORDS, decontam.SPAN + 1):
        windows = [{at + k for k in mask} for mask in decontam.MASKS for at in range(n - decontam.MASK_SPAN + 1)]
        for wrong in combinations(range(n), n // 8):
            assert any(not w & set(wrong) for w in windows), (n, wrong)


def test_decontamination_against_brute_force(spark, rows):
    rng = random.Random(8)
    items = [(k, sentence(rng, n)) for k, n in enumerate([5, 9, 12, 16, 17, 40, 40, 8, 3])] + [(50, None), (51, "")]
    more = []
    for k, (item_id, text) in enumerate(items[:9]):
        w = text.split(" ")
        for edits in (0, 1, 2, 4):
            v = list(w)
            for p in rng.sample(range(len(v)), min(edits, len(v))):
                v[p] = "Other" + str(p)
            more.append((100 + 10 * k + edits, f"{sentence(rng, 20)}, {' '.join(v).upper()}! {sentence(rng, 9)}", "en"))
        more.append((200 + k, " ".join(w[len(w) // 3:]), "en"))
    every = [r for r in rows if r[0] != 9] + more
    docs = make_docs(spark, every)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {i for i, t, _ in every if brute.contaminated(t, items)}
    for limit in (0, decontam.BROADCAST_HASHES):  # shuffle join and broadcast join
        assert {r.doc_id for r in decontam.overlaps(docs, bench, limit).collect()} == want
    clean = decontam.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted(i or -1 for i, _, _ in every if i not in want)
    assert decontam.clean_documents(docs, bench.limit(0)).count() == len(every)
    assert decontam.clean_documents(docs.limit(0), bench).count() == 0


def test_short_benchmark_items_in_query_and_sql(spark, workdir):
    """Items of one to eight words, found word for word only; the SQL agrees."""
    texts = ["Alpha, beta gamma delta. Epsilon zeta eta theta iota", "alpha beta gamma delta epsilon zeta eta other",
             "kappa; LAMBDA", "kappa mu lambda", "solo", "sol o", None, "", "kappa lambda", "beta gamma"]
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, "Kappa lambda!"), (3, "solo"), (4, None),
             (5, " "), (6, "beta gamma delta epsilon zeta"), (7, "kappa lambda")]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        f"{workdir}/short/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{workdir}/short/benchmark.parquet")
    got = {r.doc_id: (r.contaminated, r.item_ids, r.longest_overlap)
           for r in decontam.op10_spaced_seeds(spark, f"{workdir}/short").collect()}
    hits = {0: ("1,6", 8), 1: ("6", 5), 2: ("2,7", 2), 4: ("3", 1), 8: ("2,7", 2)}
    assert got == {k: (k in hits, *hits.get(k, ("", 0))) for k in range(len(texts))}
    con = brute.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{workdir}/short/{name}.parquet/*.parquet'")
    assert {r[0]: (r[1], r[3], r[4]) for r in con.sql(decontam.SQL).fetchall()} == got


def test_every_document_counts_for_the_order_of_words(spark):
    """A word of more documents stands later in the sets, whichever documents hold it."""
    names = [f"w{k}" for k in range(1, 21)]
    texts = [f"{w}\n\talone" if j % 2 else f"{w} " for k, w in enumerate(names, 1) for j in range(k)]
    docs = spark.createDataFrame(list(enumerate([*texts, None, ""])), "doc_id long, text string")
    ranks = line_dedup.bucket_ranks(docs)
    lines = spark.createDataFrame([(w,) for w in [" ".join(names), *names]], "raw string")
    sets = {r.raw: list(r.s) for r in lines.select("*", ranks.alias("ranks")).select(
        "raw", line_dedup.line_set(F.col("raw"), F.col("ranks")).alias("s")).collect()}
    assert sets[" ".join(names)] == [sets[w][0] for w in names]
