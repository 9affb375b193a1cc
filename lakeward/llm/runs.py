"""Operator 12: periodic run detection by seeds on diagonals.

A run is a stretch of words with smallest period q and length at least
``max(MIN_LENGTH, 2 * q)`` that no neighbouring word extends. On the diagonal of lag q
(pairs of places i, i + q) a run of length L is a stretch of L - q equal pairs, so at least
``max(MIN_LENGTH - q, q)`` of them: the guaranteed overlap.

* Index: lags are taken in bands. A band's gram length k is the largest power of two with
  ``2 * k - 1`` at most the guaranteed overlap of all its lags, so every run holds a
  k-gram that starts at a multiple of k. Grams get exact numbers per document by
  doubling (a gram of 2k words is a pair of grams of k); grams that occur once in their
  document are dropped at once, so the long levels are short lists.
* Occurrence pairs: each gram at a multiple of k meets the later occurrences of its
  document at the lags of the band, at most 2k of them, so a document of n words gives at
  most about 2n pairs per band, also one of a single repeated word.
* Furthest covered: the pairs of a lag come in order of place; a pair at which the last one
  of its lag has already ended is covered and is not extended again. What is left are
  heads and tails of stretches, and each is extended by less than k words.
* A stretch with a period that is a multiple of a smaller one has the same ends at both;
  the smaller is kept.

Spark deals the rows; each task works on batches of about ``BATCH_BYTES`` of text as flat
arrays. No shuffle, nothing is collected; a document is whole in one batch, however long.

Defined results: null, empty or blank text has no words and no runs; repeated rows give
repeated results; a null id gets no planted period; an empty table gives no rows; other
columns, of any name, are ignored by the query and kept by ``with_runs``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeward.llm.common import read_table

MIN_LENGTH = 12
BATCH_BYTES = 2 << 20


def bands(longest: int, min_length: int = MIN_LENGTH) -> Iterator[tuple[int, int, int]]:
    """``first lag, last lag, gram length`` for documents of up to ``longest`` words."""
    def gram(q: int) -> int:  # the largest power of two with 2 * k - 1 <= overlap
        return 1 << ((max(min_length - q, q) + 1) // 2).bit_length() - 1

    low = 1
    while 2 * low <= longest:
        k = gram(low)
        if 2 * low >= min_length:  # from here on the overlap is the lag
            high = 4 * k - 2
        else:
            high = low
            while 2 * (high + 1) < min_length and gram(high + 1) == k:
                high += 1
        yield low, min(high, longest // 2), k
        low = high + 1


def gram_numbers(word: np.ndarray, doc: np.ndarray, last: np.ndarray, most: int) -> dict[int, np.ndarray]:
    """Numbers of the grams of 1, 2, 4 .. ``most`` words from each place (-1: once in its document).

    ``last`` is the end of each place's document.
    """
    place = np.arange(len(word))

    def numbered(key: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.full(len(word), -1, np.int64)
        if len(at):
            _, inverse, n = np.unique(key, return_inverse=True, return_counts=True)
            again = n[inverse] > 1
            out[at[again]] = inverse[again]
        return out

    out = {1: numbered(doc * (word.max(initial=0) + 1) + word, place)}
    k = 1
    while 2 * k <= most:
        whole = place[place + 2 * k <= last]
        low, high = out[k][whole], out[k][whole + k]
        met = (low >= 0) & (high >= 0)
        out[2 * k] = numbered(low[met] * len(word) + high[met], whole[met])
        k *= 2
    return out


def _seeds(gram: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """``place, lag`` of equal grams of which the first starts at a multiple of k, by lag and place."""
    at = np.flatnonzero(gram >= 0)
    order = at[np.argsort(gram[at], kind="stable")]
    size = len(gram) + high + 1
    keys = gram[order] * size + order
    first = at[at % k == 0]
    a = np.searchsorted(keys, gram[first] * size + first + low)
    b = np.searchsorted(keys, gram[first] * size + first + high, side="right")
    n = b - a
    start = np.repeat(first, n)
    found = order[np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
    lag = found - start
    by = np.lexsort((start, lag))
    return start[by], lag[by]


def _extended(grams: dict[int, np.ndarray], at: np.ndarray, lag: np.ndarray, k: int, step: int) -> np.ndarray:
    """How many of fewer than k words before (step -1) or from (step 1) each place match at its lag."""
    done, size = np.zeros(len(at), np.int64), len(grams[1])
    width = k // 2
    while width:
        x = at + done if step > 0 else at - done - width
        ok = (x >= 0) & (x + lag + width <= size)
        y = np.where(ok, x, 0)
        own, other = grams[width][y], grams[width][np.where(ok, y + lag, 0)]
        done += width * (ok & (own >= 0) & (own == other))
        width //= 2
    return done


def find_runs(word: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Runs of documents laid end to end: rows ``document, start, length, period`` in this order.

    ``word`` are word numbers; ``sizes`` the documents' numbers of words.
    """
    sizes = np.asarray(sizes, np.int64)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    plan = list(bands(int(sizes.max(initial=0)), min_length))
    found = [np.zeros((0, 4), np.int64)]
    if plan:
        grams = gram_numbers(np.asarray(word, np.int64), doc, ends[doc], max(k for _, _, k in plan))
        for low, high, k in plan:
            at, lag = _seeds(grams[k], k, low, high)
            if not len(at):
                continue
            # Covered: the place where the last pair of this lag ended.
            covered = np.zeros(len(at), bool)
            covered[1:] = (lag[1:] == lag[:-1]) & (at[1:] == at[:-1] + k) & (doc[at[1:]] == doc[at[:-1]])
            head = np.flatnonzero(~covered)
            tail = np.concatenate((head[1:] - 1, [len(at) - 1]))
            q = lag[head]
            start = at[head] - _extended(grams, at[head], q, k, -1)
            end = at[tail] + k + _extended(grams, at[tail] + k, q, k, 1) + q
            long = end - start >= np.maximum(min_length, 2 * q)
            found.append(np.stack([doc[at[head]], start, end - start, q], axis=1)[long])
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    keep = np.ones(len(rows), bool)  # of equal ends the smallest period
    keep[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[keep]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    rows[:, 1] -= (ends - sizes)[rows[:, 0]]
    return rows


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the period that the query plants in a tenth of the documents."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that any run (``start, length, period``) repeats."""
    if not len(runs):
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [w for w, k in zip(words, keep) if k]


def slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BATCH_BYTES`` of text; a longer text is in one range whole."""
    part = np.cumsum(sizes) // BATCH_BYTES
    bounds = [0, *(np.flatnonzero(np.diff(part)) + 1), len(sizes)]
    yield from ((a, b) for a, b in zip(bounds, bounds[1:]) if a < b)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().split() if text is not None else []  # splits at space and \x09 to \x0D


def batch_runs(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[np.ndarray]:
    """The runs ``start, length, period`` of each word list."""
    flat = [w for t in texts for w in t]
    number = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy()
    rows = find_runs(number, [len(t) for t in texts], min_length)
    return np.split(rows[:, 1:], np.searchsorted(rows[:, 0], np.arange(1, len(texts))))


def with_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with ``runs`` (an array of start, length, period) and ``collapsed`` (the text without repeats)."""
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType([f for f in docs.schema.fields if f.name not in ("runs", "collapsed")]
                          + [T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a, b in slices(pdf[text_col].str.len().fillna(0).to_numpy(np.int64)):
                part = pdf.iloc[a:b]
                words = [words_of(t) for t in part[text_col]]
                found = batch_runs(words, min_length)
                yield part.assign(
                    runs=[[dict(zip(("start", "length", "period"), map(int, r))) for r in rs] for rs in found],
                    collapsed=[b" ".join(collapsed(w, rs)).decode() for w, rs in zip(words, found)])

    return docs.drop("runs", "collapsed").mapInPandas(work, schema)


def run_digests(docs: DataFrame) -> DataFrame:
    """The columns of the query, from the documents with their planted periods."""
    schema = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
              "runs_sha256 string, collapsed_sha256 string")

    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2

    def described(doc_id, words: list[bytes], runs: np.ndarray) -> tuple:
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        s, n, q = map(int, min(runs, key=lambda r: (-r[1], r[0], r[2]))) if len(runs) else (None, None, None)
        return (doc_id, len(runs), s, n, q, 1000 * n // q if q else None, hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in slices(pc.binary_length(pc.fill_null(whole["text"], "")).to_numpy().astype(np.int64)):
                batch = whole.slice(a, b - a)
                ids = batch["doc_id"].to_pylist()
                words = [planted(words_of(t), i) for i, t in zip(ids, batch["text"].to_pylist())]
                rows = [described(*row) for row in zip(ids, words, batch_runs(words))]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text").mapInArrow(work, schema)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(read_table(spark, sf_dir, "documents"))
