"""Operator 8: substring deduplication with repeated-phrase automata.

A window is ``WINDOW`` consecutive words. A word goes when some window over it also
starts in a document with a smaller id.

1. Documents with the same text are one text with its smallest id; the others lose
   every word under a window, and only the first goes through the rest.
   Every window has a representative gram: the ``GRAM``-word gram with the smallest
   hash among its ``WINDOW - GRAM + 1`` grams (a minimizer), so equal windows have
   equal grams. Grams that occur in one text only are dropped; no window with such a
   gram can recur in another text.
2. Runs of windows with the same recurring gram are cut out as segments (their
   words, at most ``2 * WINDOW - GRAM`` of them). Equal segments of different
   documents become one row with their smallest id before they are dealt.
3. Segments are dealt by gram to shards. A shard confirms the windows that occur in
   segments of more than one document, compiles them into an Aho-Corasick automaton
   (pyahocorasick, over word numbers as two characters) and streams its segments through it: every
   occurrence gets the smallest id of its window. A shard with very many segments
   works through several automata, each of at most ``AUTOMATON_PHRASES`` phrases.
   A gram with more than ``SHARD_WORDS`` words of segments is dealt further: its
   windows, each with its smallest and largest id per task, meet by hash of the whole
   window, and no task holds the gram.
4. Occurrences owned by a smaller id mark their words; marks meet their document
   again, which is written without them.

Hashes of grams and windows (64 bits) only route and group; segments, patterns and
matches are compared as words. Whole copies of a text are told by ``text_key``, a
64-bit hash, alone.

Defined results: null or blank text has no words; texts of fewer than ``WINDOW``
words keep all; a window that recurs in its own document only is kept; rows with
equal ids are one document, none removes from the other; a null id counts as
larger than every id; an empty table gives no rows; other columns are ignored by
the query and kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.common import cut, read_table
from lakeward.llm.ngram_join import WordHashes

WINDOW = 13
GRAM = 6
AUTOMATON_PHRASES = 50_000
SHARD_WORDS = 2_000_000       # words of the segments of one shard, about
NO_ID = np.iinfo(np.int64).max
_MIX = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(GRAM)], dtype=np.uint64)


def gram_hashes(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """64-bit hash of the gram that starts at each word (fewer words: none)."""
    count = len(words) - GRAM + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    total = np.zeros(count, dtype=np.uint64)
    for k in range(GRAM):
        total += w[k:k + count] * _MIX[k]
    total = (total ^ (total >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return total ^ (total >> np.uint64(32))


def representatives(grams: np.ndarray) -> np.ndarray:
    """For each window the smallest gram hash inside it."""
    span = WINDOW - GRAM + 1
    if len(grams) < span:
        return np.empty(0, np.uint64)
    low, width = grams, 1  # low[i]: smallest of the `width` hashes from i on
    while width < span:
        step = min(width, span - width)
        low, width = np.minimum(low[:-step], low[step:]), width + step
    return low


def _window_grams(text: str | None, hashes: WordHashes) -> tuple[list[bytes], np.ndarray]:
    words = (text or "").encode().split()
    return words, representatives(gram_hashes(words, hashes)).view(np.int64)


def gram_rows(docs: DataFrame) -> DataFrame:
    """``gram, text_key``: the distinct representative grams of every text, once per task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, done = WordHashes(), set()
        for pdf in batches:
            grams, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for key, text in zip(pdf["text_key"], pdf["text"]):
                if key not in done:
                    done.add(key)
                    grams.append(np.unique(_window_grams(text, hashes)[1]))
                    keys.append(np.full(len(grams[-1]), key, np.int64))
            yield pd.DataFrame({"gram": np.concatenate(grams), "text_key": np.concatenate(keys)})

    return docs.select("text_key", "text").mapInPandas(run, "gram bigint, text_key bigint")


def recurring(grams: DataFrame) -> DataFrame:
    """``text_key, grams``: per text its grams that other texts have too.

    Rows are dealt by gram and sorted, so a task streams the texts of a gram and
    remembers one row of it.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.empty((0, 2), np.int64)   # the only text so far of the last gram
        known = None                        # the last gram, once it has two texts
        for pdf in batches:
            rows = np.concatenate([held, pdf[["gram", "text_key"]].to_numpy(np.int64)])
            if not len(rows):
                continue
            gram, key = rows[:, 0], rows[:, 1]
            first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
            count = np.diff(np.r_[first, len(gram)])
            several = key[first + count - 1] != key[first]
            if known is not None and gram[0] == known:
                several[0] = True
            known = gram[-1] if several[-1] else None
            held = np.empty((0, 2), np.int64) if several[-1] else rows[first[-1]:first[-1] + 1]
            take = np.repeat(several, count)
            yield pd.DataFrame({"gram": gram[take], "text_key": key[take]})

    dealt = grams.repartition("gram").sortWithinPartitions("gram", "text_key")
    shared = dealt.mapInPandas(run, "gram bigint, text_key bigint")
    return shared.groupBy("text_key").agg(F.collect_list("gram").alias("grams"))  # the text's own


def segment_rows(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """``gram, segment, doc, text_key, start``: runs of windows with the same recurring gram.

    ``shared`` names the text's first document, the only one that is cut.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for pdf in batches:
            out = []
            for doc, key, text, grams in zip(pdf["doc"], pdf["text_key"], pdf["text"], pdf["grams"]):
                words, own = _window_grams(text, hashes)
                hit = np.isin(own, np.asarray(grams, np.int64))
                edge = np.flatnonzero(np.r_[True, (own[1:] != own[:-1])]) if len(own) else np.empty(0, np.int64)
                ends = np.r_[edge[1:], len(own)]
                for a, b in zip(edge.tolist(), ends.tolist()):
                    # A run longer than a gram can stay smallest is cut, so segments are bounded.
                    for c in range(a, b, WINDOW - GRAM + 1) if hit[a] else ():
                        d = min(c + WINDOW - GRAM + 1, b)
                        out.append((own[a], b" ".join(words[c:d + WINDOW - 1]).decode(), doc, key, c))
            yield pd.DataFrame(out, columns=["gram", "segment", "doc", "text_key", "start"])

    named = shared.select(F.col("first").alias("s_doc"), F.col("text_key").alias("s_key"), "grams")
    joined = docs.join(named, (F.col("doc") == F.col("s_doc")) & (F.col("text_key") == F.col("s_key")))
    return joined.select("doc", "text_key", "text", "grams").mapInPandas(
        run, "gram bigint, segment string, doc bigint, text_key bigint, start int")


def find_owners(segments: list[str], lo: np.ndarray, hi: np.ndarray) -> list[np.ndarray]:
    """For each segment the smallest id of each of its windows (``NO_ID``: it recurs nowhere).

    ``lo`` and ``hi`` are the smallest and largest ids of the documents with the segment.
    """
    coded = _two_symbols(segments)
    # Confirm: windows by their words, with the smallest and largest id they occur in.
    least: dict[str, int] = {}
    most: dict[str, int] = {}
    shared: set[str] = set()  # windows of several segments
    size = 2 * WINDOW
    for code, a, b in zip(coded, lo.tolist(), hi.tolist()):
        for i in range(0, len(code) - size + 2, 2):
            w = code[i:i + size]
            if w in least:
                shared.add(w)
                least[w] = min(least[w], a)
                most[w] = max(most[w], b)
            else:
                least[w], most[w] = a, b
    # Patterns: windows of several segments by themselves; neighbouring windows that
    # only one segment has, which recurs as a whole, as one phrase.
    patterns = [(w, least[w], 1) for w in shared if least[w] < most[w]]
    for code, a, b in zip(coded, lo.tolist(), hi.tolist()):
        if a < b:
            begin = 0
            for i in range(0, len(code) - size + 4, 2):
                if i > len(code) - size or code[i:i + size] in shared:
                    if i > begin:
                        patterns.append((code[begin:i - 2 + size], a, (i - begin) // 2))
                    begin = i + 2
    owners = [np.full(max(len(c) // 2 - WINDOW + 1, 0), NO_ID, np.int64) for c in coded]
    for k in range(0, len(patterns), AUTOMATON_PHRASES):
        machine = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for phrase, owner, windows in patterns[k:k + AUTOMATON_PHRASES]:
            machine.add_word(phrase, (owner, windows))
        machine.make_automaton()
        for code, found in zip(coded, owners):
            for end, (owner, windows) in machine.iter(code):
                last = (end + 1) // 2 - WINDOW
                found[last - windows + 1:last + 1] = owner
    return owners


def _two_symbols(segments: list[str]) -> list[str]:
    """Segments with every word as two characters of its number.

    The automaton searches a state's successors one by one, so states need few of
    them; the two characters come from different ranges, so no match is shifted.
    """
    number: dict[str, str] = {}
    out = []
    for s in segments:
        code = []
        for w in s.split(" "):
            c = number.get(w)
            if c is None:
                k = len(number)
                c = number[w] = chr(0x200 + k // 256) + chr(0x20 + k % 256)
            code.append(c)
        out.append("".join(code))
    return out


def owned_segments(distinct: DataFrame) -> DataFrame:
    """``o_gram, o_seg, owners``: the owner of each window of a distinct segment, by shard."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        owners = find_owners(pdf["segment"].tolist(), pdf["lo"].to_numpy(np.int64), pdf["hi"].to_numpy(np.int64))
        some = [k for k, o in enumerate(owners) if (o != NO_ID).any()]
        return pd.DataFrame({"o_gram": pdf["gram"].to_numpy()[some], "o_seg": pdf["seg"].to_numpy()[some],
                             "owners": pd.Series([owners[k] for k in some], dtype=object)})

    return distinct.groupBy("shard").applyInPandas(run, "o_gram bigint, o_seg bigint, owners array<bigint>")


def owned_windows(heavy: DataFrame) -> DataFrame:
    """``o_gram, o_seg, owners`` of the distinct segments of heavy grams.

    Equal windows meet by their words (``window``), aggregated in each task before they
    are dealt; only the owners of a segment come back together.
    """
    words = F.split("segment", " ")
    windows = heavy.select("gram", "seg", "lo", "hi", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.array_join(F.slice(words, i + 1, F.lit(WINDOW)), " "))).alias("place", "window"))
    shared = windows.groupBy(F.col("window").alias("w_window")).agg(
        F.min("lo").alias("owner"), F.max("hi").alias("most")).where("owner < most")
    met = windows.select("gram", "seg", "place", "window").join(shared, F.col("window") == F.col("w_window"))
    sizes = heavy.select(F.col("gram").alias("z_gram"), F.col("seg").alias("z_seg"),
                         (F.size(words) - WINDOW).alias("last"))
    held = met.groupBy("gram", "seg").agg(F.map_from_entries(F.collect_list(F.struct("place", "owner"))).alias("at"))
    return held.join(sizes, (F.col("gram") == F.col("z_gram")) & (F.col("seg") == F.col("z_seg"))).select(
        F.col("gram").alias("o_gram"), F.col("seg").alias("o_seg"),
        F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.coalesce(
            F.col("at")[i], F.lit(NO_ID))).alias("owners"))


def segment_owners(segments: DataFrame, distinct: DataFrame, shards: int) -> DataFrame:
    """``o_gram, o_seg, owners`` of every distinct segment: light grams by shard, heavy ones by window."""
    # Counted with equal segments apart: partial sums per gram move, no segment does.
    sizes = segments.groupBy(F.col("gram").alias("h_gram")).agg(F.sum(F.length("segment") / 6).alias("words"))
    heavy = cut(sizes.where(F.col("words") > SHARD_WORDS).select("h_gram"), "phrases-heavy")
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
    if heavy.isEmpty():
        return owned_segments(dealt)
    same = F.col("gram") == F.col("h_gram")
    return owned_segments(dealt.join(heavy, same, "left_anti")).unionByName(
        owned_windows(distinct.join(heavy, same, "left_semi")))


def marks(docs: DataFrame) -> DataFrame:
    """``m_doc, m_key, whole, starts``: what goes of each document that loses words.

    ``starts`` are the first words of windows that a smaller id has too. A document
    whose whole text has a smaller id (``whole``) loses every word under a window.
    """
    ids = cut(docs.select("doc", "text_key").distinct(), "phrases-ids")
    firsts = ids.groupBy(F.col("text_key").alias("f_key")).agg(F.min("doc").alias("first"))
    shared = cut(recurring(gram_rows(docs)), "phrases-grams")
    shared = shared.join(firsts, F.col("text_key") == F.col("f_key"))
    segments = cut(segment_rows(docs, shared).withColumn("seg", F.xxhash64("segment")), "phrases-segments")
    distinct = segments.groupBy("gram", "seg").agg(
        F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.min("segment").alias("segment"))
    words = segments.select(F.sum(F.length("segment") / 6)).first()[0] or 0
    shards = max(1, int(words / SHARD_WORDS) + 1)
    owned = cut(segment_owners(segments, distinct, shards), "phrases-owned")
    hits = (segments.select("gram", "seg", "doc", "text_key", "start")
            .join(owned, (F.col("gram") == F.col("o_gram")) & (F.col("seg") == F.col("o_seg")))
            .select("doc", "text_key", F.explode(F.transform("owners", lambda o, i: F.when(
                o < F.col("doc"), F.col("start") + i))).alias("at")).where("at IS NOT NULL"))
    parts = hits.groupBy(F.col("doc").alias("m_doc"), F.col("text_key").alias("m_key")).agg(
        F.collect_set("at").alias("starts"))
    copies = ids.join(firsts, (F.col("text_key") == F.col("f_key")) & (F.col("doc") > F.col("first"))).select(
        F.col("doc").alias("m_doc"), F.col("text_key").alias("m_key"))
    return parts.select("m_doc", "m_key", F.lit(False).alias("whole"), "starts").unionByName(
        copies.select("m_doc", "m_key", F.lit(True).alias("whole"), F.array().cast("array<int>").alias("starts")))


def _kept(text: str | None, whole: bool | None, starts) -> tuple[list[bytes], np.ndarray]:
    words = (text or "").encode().split()
    if whole:
        return words, np.full(len(words), len(words) < WINDOW)
    gone = np.zeros(len(words) + 1, np.int64)
    if starts is not None and len(starts):
        at = np.asarray(starts, np.int64)
        np.add.at(gone, at, 1)
        np.add.at(gone, at + WINDOW, -1)
    return words, np.cumsum(gone)[:len(words)] == 0


def _numbered(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(text).alias("text_key"), "text")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text`` (kept words joined by a space)."""
    found = marks(_numbered(docs))
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    number = F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID))
    joined = docs.join(found, (number == found["m_doc"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["m_key"]), "left").select(
        row.alias("row"), docs["text"].alias("text"), found["whole"].alias("whole"), found["starts"].alias("starts"))

    @F.pandas_udf("string")
    def rest(text: pd.Series, whole: pd.Series, starts: pd.Series) -> pd.Series:
        out = []
        for t, w, s in zip(text, whole, starts):
            if t is not None and (s is not None or w):
                words, keep = _kept(t, bool(w), s)
                t = b" ".join(x for x, k in zip(words, keep) if k).decode()
            out.append(t)
        return pd.Series(out, dtype=object)

    return joined.withColumn("row", F.col("row").withField("text", rest("text", "whole", "starts"))).select("row.*")


def repeat_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""
    rows = _numbered(docs)
    joined = rows.join(marks(rows), (F.col("doc") == F.col("m_doc")) & (F.col("text_key") == F.col("m_key")),
                       "left").select(F.col("doc_id").cast("string").alias("id"), "text", "whole", "starts")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, text, whole, starts in zip(pdf["id"], pdf["text"], pdf["whole"], pdf["starts"]):
                words, keep = _kept(text, whole is not None and bool(whole), starts)
                kept = b" ".join(w for w, k in zip(words, keep) if k)
                out.append((doc, len(words), int((~keep).sum()), hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["id", "n_words", "n_removed", "kept_sha256"])

    digests = joined.mapInPandas(run, "id string, n_words bigint, n_removed bigint, kept_sha256 string")
    return digests.select(F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
                          "n_words", "n_removed", "kept_sha256")


def op8_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = f"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
        lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i, w[i:i + {WINDOW - 1}] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)),
o AS (SELECT doc_id, i FROM g QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
r AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM o) GROUP BY doc_id),
k AS (SELECT doc_id, len(w) AS n, CASE WHEN gone IS NULL THEN w ELSE
        list_transform(list_filter(range(1, len(w) + 1), lambda p: NOT list_contains(gone, p)), lambda p: w[p]) END AS kept
      FROM d LEFT JOIN r USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(kept) AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k"""
