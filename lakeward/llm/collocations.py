"""Operator 11: phrase collocation mining by SON partitioning.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into
words; phrases are contiguous words of a piece, counted per language.

1. Shards: every task cuts its documents into shards of about ``SHARD_BYTES`` of text. A
   phrase that occurs ``SUPPORT`` times in all occurs at least ``SUPPORT * bytes of the
   shard / bytes of all`` times in some shard, so each shard is mined completely at that
   lowered support (at least 1) and reports what reaches it, as hash and local count.
2. The union of the reports names the candidates. Where every local support is 1
   (more text than ``SUPPORT`` shards hold) the reports leave nothing out, and hashes whose
   counts add up to less than ``SUPPORT`` are no candidates; hash collisions only add some.
   Candidates become a bitmap of ``2 ** FILTER_BITS`` bits (8 MB, whatever the corpus; where it
   fills up, more phrases are counted, and never one too few).
3. All candidates are counted exactly, by their words, in one more pass over all shards
   with a sum per phrase over them.

One and two words are mined first; the pass that counts them mines the longer phrases,
of which every pair of neighbours must be a candidate (no phrase is more frequent than
its parts), and a third pass counts those.

Scores: a phrase cut after its first k words has ``floor(2000000 * a / (l + r))`` with its
count a and those of both parts; the lowest cut counts, in decimals of 38 digits. A
candidate contained in a longer one that occurs at least ``ABSORB_PCT`` % as often is dropped.

Defined results: null or empty text has no words, a null language is ``und`` (one group
with documents that say so); repeated rows count again; ties go by score, count, phrase
(bytes); languages without a candidate, and an empty table, give no rows; other columns,
of any name, are ignored. A text of any length is in one shard whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeward.llm.common import cut, read_table

SUPPORT = 30
MAX_WORDS = 4
SHARD_BYTES = 1 << 20
FILTER_BITS = 26
SCALE = 2_000_000
ABSORB_PCT = 80
TOP = 2000
SPREAD = 64            # parts of a language that are ranked before the language is
NO_LANG = "und"

_BLANK, _END = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
ROWS = "hash bigint, lang string, phrase string, n bigint"


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def _mixed(seed: np.ndarray, word: np.ndarray) -> np.ndarray:
    z = (seed * _ODD) ^ word
    z = (z ^ (z >> np.uint64(29))) * _MIX
    return z ^ (z >> np.uint64(32))


@dataclass
class Shard:
    """The words of some documents in order, as numbers."""
    word: np.ndarray       # number of each word in vocab
    piece: np.ndarray      # the piece each word lies in, ascending
    lang: np.ndarray       # number of each word's language in langs
    vocab: pa.Array
    langs: pa.Array

    @classmethod
    def of(cls, langs: pa.Array, texts: pa.Array) -> Shard:
        langs = pc.fill_null(langs, NO_LANG).dictionary_encode()
        texts = pc.fill_null(texts, "")
        data = np.frombuffer("\n".join(texts.to_pylist()).encode(), np.uint8)
        first = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64) + 1)[:-1]))
        kind = _KIND[data]
        inside = kind == 0
        edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
        words = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[inside]])).dictionary_encode()
        doc = np.searchsorted(first, starts, side="right") - 1
        return cls(words.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(kind == _END)[starts],
                   langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[doc], words.dictionary,
                   langs.dictionary)

    def whole(self, k: int) -> np.ndarray:
        """Does a phrase of k words start at each place?"""
        out = np.zeros(len(self.word), bool)
        if len(out) >= k:
            out[:len(out) - k + 1] = self.piece[k - 1:] == self.piece[:len(out) - k + 1]
        return out

    def gram_hashes(self, most: int) -> list[np.ndarray]:
        """Hashes of the 1, 2 .. ``most`` words from each place on (the last places: of fewer)."""
        own = _hashes(self.vocab)[self.word]
        out = [_mixed(_hashes(self.langs)[self.lang], own)]
        for k in range(1, most):
            longer = out[-1].copy()
            longer[:-k] = _mixed(longer[:-k], own[k:])
            out.append(longer)
        return out

    def counted(self, k: int, at: np.ndarray) -> pa.RecordBatch:
        """Exact counts of the phrases of k words that start at the places ``at``."""
        size = max(len(self.vocab), 1)
        key = self.lang[at] * size + self.word[at]
        for j in range(1, k):
            key = np.unique(key, return_inverse=True)[1] * size + self.word[at + j]
        _, one, n = np.unique(key, return_index=True, return_counts=True)
        at = at[one]
        words = [self.vocab.take(pa.array(self.word[at + j])) for j in range(k)]
        return _batch(lang=self.langs.take(pa.array(self.lang[at])).cast(pa.string()),
                      phrase=pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())).cast(pa.string()),
                      n=n)

    def totals(self) -> pa.RecordBatch:
        """The number of words of each language, under the empty phrase."""
        n = np.bincount(self.lang, minlength=len(self.langs))
        return _batch(lang=self.langs.cast(pa.string()), phrase=pa.array([""] * len(n), pa.string()), n=n)


def _batch(n: np.ndarray, hash=None, lang=None, phrase=None) -> pa.RecordBatch:
    none = lambda kind: pa.nulls(len(n), kind)
    return pa.record_batch([none(pa.int64()) if hash is None else pa.array(hash.view(np.int64)),
                            none(pa.string()) if lang is None else lang,
                            none(pa.string()) if phrase is None else phrase,
                            pa.array(n.astype(np.int64))], names=["hash", "lang", "phrase", "n"])


def _mined(hashes: np.ndarray, least: int) -> pa.RecordBatch:
    kinds, n = np.unique(hashes, return_counts=True)
    return _batch(hash=kinds[n >= least], n=n[n >= least])


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(65 - (64 * len(bits)).bit_length())
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def shard_pass(docs: DataFrame, total: int, support: int, longest: int, mine: range, count: range,
               bits=None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Rows ``ROWS`` of every shard: hashes of mined phrases, counted phrases, word totals.

    ``mine`` and ``count`` are the phrase lengths to mine and to count; ``bits`` is the
    broadcast bitmap of the candidates so far.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.binary_length(pc.fill_null(batch["text"], "")).to_numpy().astype(np.int64)
            no = np.cumsum(size) // shard_bytes
            bounds = [0, *(np.flatnonzero(np.diff(no)) + 1), len(size)]
            for a, b in zip(bounds, bounds[1:]):
                shard = Shard.of(batch["lang"].slice(a, b - a), batch["text"].slice(a, b - a))
                if not len(shard.word):
                    continue
                # The lowered support, rounded up; text beyond a shard's size cannot raise it.
                least = max(1, -(-support * min(int(size[a:b].sum()), shard_bytes) // max(total, 1)))
                hashes = shard.gram_hashes(longest)
                known = None if bits is None else _held(bits.value, hashes[1])
                if bits is None:
                    yield shard.totals()
                for k in mine:
                    at = shard.whole(k)
                    if known is not None:  # every pair of neighbours is a candidate
                        for j in range(k - 1):
                            at[:len(at) - j] &= known[j:]
                    yield _mined(hashes[k - 1][at], least)
                for k in count:
                    yield shard.counted(k, np.flatnonzero(shard.whole(k) & _held(bits.value, hashes[k - 1])))

    narrow = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, ROWS)


def _bitmap(mined: DataFrame):
    """Broadcast bitmap of the hashes of ``mined``: 2 ** (FILTER_BITS - 6) longs."""
    place = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    longs = mined.groupBy(F.floor(place / 64).cast("int").alias("i")).agg(F.bit_or(bit).alias("b")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[longs["i"].to_numpy()] = longs["b"].to_numpy().view(np.uint64)
    return mined.sparkSession.sparkContext.broadcast(bits)


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, max_words: int = MAX_WORDS,
                     shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``lang, phrase, n`` of all phrases of 1 to ``max_words`` words that occur ``support`` times.

    The empty phrase has the number of all words of its language.
    """
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    # With every local support at 1 the reports are complete and can be summed.
    complete = support if support * shard_bytes <= total else 1
    kept = (F.col("hash").isNotNull() & (F.col("n") >= complete)) | (F.col("n") >= support) | (F.col("phrase") == "")

    def passed(mine: range, count: range, bits, name: str) -> DataFrame:
        longest = max([2, *mine, *count])
        rows = shard_pass(docs, total, support, longest, mine, count, bits, shard_bytes)
        return cut(rows.groupBy("hash", "lang", "phrase").agg(F.sum("n").alias("n")).where(kept), name)

    short, long = range(1, min(max_words, 2) + 1), range(3, max_words + 1)
    first = passed(short, range(0), None, "collocations-mined")
    second = passed(long, short, _bitmap(first.where("hash IS NOT NULL")), "collocations-short")
    rows = first.where("phrase = ''").unionByName(second.where("phrase IS NOT NULL"))
    if long:
        known = first.unionByName(second).where("hash IS NOT NULL")
        third = passed(range(0), long, _bitmap(known), "collocations-long")
        rows = rows.unionByName(third)
    return rows.select("lang", "phrase", "n")


def collocations(docs: DataFrame, support: int = SUPPORT, max_words: int = MAX_WORDS, top: int = TOP,
                 absorb_pct: int = ABSORB_PCT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of each language."""
    every = frequent_phrases(docs, support, max_words, shard_bytes)
    counts = every.where("phrase <> ''")
    words = F.split("phrase", " ")
    phrases = counts.where(F.size(words) > 1).select("lang", "phrase", F.col("n").alias("a"), words.alias("words"))

    def part(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    size = F.size("words")
    cuts = phrases.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"),
                       part(F.col("k") + 1, size - F.col("k")).alias("tail"))
    head = counts.select(F.col("lang").alias("h_lang"), F.col("phrase").alias("h_phrase"), F.col("n").alias("l"))
    tail = counts.select(F.col("lang").alias("t_lang"), F.col("phrase").alias("t_phrase"), F.col("n").alias("r"))
    cuts = (cuts.join(head, (F.col("lang") == F.col("h_lang")) & (F.col("head") == F.col("h_phrase")))
            .join(tail, (F.col("lang") == F.col("t_lang")) & (F.col("tail") == F.col("t_phrase"))))
    # Whole quotient of decimals: a product of more than 64 bits stays exact.
    score = F.expr(f"(CAST(a AS DECIMAL(20, 0)) * {SCALE}) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice("words", i, n), " "))))
    longer = (phrases.where(size > 2).select(F.col("lang").alias("i_lang"), F.explode(inner).alias("i_phrase"), "a")
              .groupBy("i_lang", "i_phrase").agg(F.max("a").alias("longer_a")))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    left = lowest.join(longer, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("i_phrase")), "left").where(
        F.col("longer_a").isNull() | (wide("longer_a") * 100 < wide("a") * absorb_pct))

    # A language may hold most phrases: its parts are ranked first, then their best ones.
    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    apart = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))).orderBy(*order)
    best = left.withColumn("place", F.row_number().over(apart)).where(F.col("place") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    total = every.where("phrase = ''").select(F.col("lang").alias("n_lang"), "n")
    return (ranked.where(F.col("rank") <= top).join(total, F.col("lang") == F.col("n_lang"))
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
                    F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents").select("lang", "text"))


SQL = f"""
WITH p AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)),
f AS (SELECT lang, k, g, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= {SUPPORT}),
s AS (SELECT c.lang, c.k, c.g, c.a, j, h.a AS l, t.a AS r,
             (CAST(c.a AS HUGEINT) * {SCALE}) // (CAST(h.a AS HUGEINT) + t.a) AS score
      FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
      JOIN f h ON h.lang = c.lang AND h.g = c.g[1:j] JOIN f t ON t.lang = c.lang AND t.g = c.g[j + 1:]
      QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, j) = 1),
i AS (SELECT lang, s, max(a) AS longer FROM (SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: g[i:i + m - 1])) AS s
      FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k) GROUP BY ALL),
b AS (SELECT s.lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM s LEFT JOIN i ON i.lang = s.lang AND i.s = s.g
      WHERE longer IS NULL OR 100 * longer < {ABSORB_PCT} * a)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM b JOIN n USING (lang) QUALIFY rank <= {TOP}"""
