"""Operator 5: line dedup by an exact set-similarity join (DataFrame functions only).

A line's set is its distinct words. A line with a word goes when an earlier line (by
document id, then line number) has a set with ``10 * |x & y| >= 8 * |x | y|``; lines are
judged on the input. Lines with the same set are one set from the first step on; sets of
fewer than ``JOINED`` words are similar to equal sets only and are settled by their key.

* Rarity: the words of all documents are counted by ``BUCKETS`` hash buckets (two megabytes, a
  fixed size); the order settles what is cheap, not what is found. A
  token's sort key is its bucket's rank from rare to frequent, then its hash; the
  key still holds all 64 bits, so sets of keys are the sets of word hashes.
* Prefix filter on pairs: the neighbours of a sorted set, two by two, are what sets must
  share. Similar sets share one of the first ``(2 n - ceil(0.8 n)) / 3 + 1`` pairs of each (see
  ``pair_prefix``), and sets that are not similar seldom do. Pairs of one set only are not dealt.
* Length and bitmap filters: the sizes fit, and the parity bitmaps (64 bits, 256 in sets of
  more than ``SHORT`` words, one flipped per token) differ in no more bits than the sets may differ in tokens.
* Sets of a token pair meet the ``FRAME`` sets before them and the earliest one, without
  all pairs being formed; a near copy among thousands is settled by these. Only
  sets that no verified earlier partner settles meet the rest of long groups.
* Verification reads the words of candidate lines again and intersects their sets.

Defined results: null or blank text and blank lines are left alone; a document
keeps its other lines and their order; repeated rows are one document; among equal
ids the text's hash decides which is earlier, a null id comes first; an empty table
gives no rows; other columns, of any name, are kept by ``drop_later_lines``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeward.llm.common import SPACE_CHARS, SPACE_CLASS, cut, discard, let, read_table, words

NUM, DEN = 8, 10
JOINED = 4  # smaller sets have no similar set but themselves: 10 * n < 8 * (n + 1)
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
FRAME = 16
SHARED_BITS = 24
SHORT = 80  # sets of up to so many words have bitmaps of 64 bits, larger ones of 256
_BITS = ("bits0", "bits1", "bits2", "bits3")  # longs of the bitmaps that rows of token groups carry


def _dense(rows: DataFrame, index: str, value: str, size: int) -> Column:
    """The values 0 to ``size`` - 1 of a small table as one array, a scalar subquery (missing: 0)."""
    every = rows.sparkSession.range(size).join(rows, F.col("id") == F.col(index), "left")
    filled = F.struct("id", F.coalesce(value, F.lit(0)).alias("v"))
    return every.agg(F.transform(F.sort_array(F.collect_list(filled)), lambda x: x.v).alias("a")).scalar()


def bucket_ranks(docs: DataFrame) -> Column:
    """The rank of each hash bucket, 0 for the rarest words: ``BUCKETS`` ints, a fixed size.

    Every order of the words gives the same rows; this one makes small groups.
    """
    text = F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" "))
    # Spaces and line ends alone need no regular expression.
    odd = reduce(or_, [F.contains(text, F.lit(c)) for c in SPACE_CHARS if c not in " \n"])
    parts = F.when(odd, F.split(text, SPACE_CLASS)).otherwise(F.split(text, " "))
    tokens = docs.select(F.explode(parts).alias("w")).where("w <> ''")
    counts = cut(tokens.select(F.shiftrightunsigned(F.xxhash64("w"), 64 - BUCKET_BITS).alias("b"))
                 .groupBy("b").agg(F.count("*").alias("n")), "lines-buckets")
    # One task sorts the BUCKETS counters, whatever the corpus; every bucket has a rank of its own.
    every = docs.sparkSession.range(BUCKETS).join(counts, F.col("id") == F.col("b"), "left")
    ranked = every.select("id", (F.row_number().over(Window.orderBy(F.coalesce("n", F.lit(0)), "id")) - 1).alias("r"))
    # Kept as what turns the bucket at a hash's head into its rank, signed, by one XOR.
    turns = F.shiftleft(F.col("r").cast("long").bitwiseXOR(F.col("id")).bitwiseXOR(F.lit(BUCKETS // 2).cast("long")),
                        64 - BUCKET_BITS)
    return _dense(cut(ranked.select(F.col("id").alias("b"), turns.alias("r")), "lines-ranks"), "b", "r", BUCKETS)


def needed(n: Column, m: Column) -> Column:
    """Smallest overlap of similar sets of these sizes."""
    return F.ceil(NUM * (n + m) / F.lit(NUM + DEN)).cast("int")


def line_set(line: Column, ranks: Column) -> Column:
    """Distinct token keys of a line, rarest first."""
    trimmed = F.btrim(F.coalesce(line, F.lit("")), F.lit(SPACE_CHARS))
    # Single spaces alone need no regular expression.
    odd = F.lit(False)
    for blank in (*SPACE_CHARS[1:], "  "):
        odd = odd | F.contains(trimmed, F.lit(blank))
    # One word list, whichever way it was split: every form of it would be its own code.
    split = F.when(trimmed == "", F.array().cast("array<string>")).when(odd, F.split(trimmed, SPACE_CLASS)).otherwise(
        F.split(trimmed, " "))
    hashes = F.transform(split, lambda w: F.xxhash64(w))

    def key(h: Column) -> Column:
        # The lambda is interpreted per token, so it is kept short.
        turn = F.get(ranks, F.shiftrightunsigned(h, 64 - BUCKET_BITS).cast("int"))
        return h.bitwiseXOR(F.coalesce(turn, F.lit(0).cast("long")))

    # Keys tell words apart as their hashes do. The set is made of them by compiled functions.
    return F.sort_array(F.array_distinct(F.transform(hashes, key)))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def _parity(s: Column) -> list[Column]:
    """Parity bits of a set, every token flips one: 64 bits, and 256 that fold to them in larger sets.

    The longs 1 to 3 are null in sets of up to ``SHORT`` words; long 0 of the 256 bits is the
    XOR of all four columns.
    """
    def flipped(keep: int | None) -> Column:
        def flip(acc: Column, t: Column) -> Column:
            bit = acc.bitwiseXOR(_bit(t.bitwiseAND(F.lit(63))))
            return bit if keep is None else F.when(F.shiftright(t, 6).bitwiseAND(F.lit(3)) == keep, bit).otherwise(acc)

        return F.aggregate(s, F.lit(0).cast("long"), flip)

    return [flipped(None), *[F.when(F.size(s) > SHORT, flipped(k)) for k in (1, 2, 3)]]


def _doc_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(F.col("doc_id"), F.col("text")).alias("doc_row"), "text")


def pair_prefix(s: Column) -> Column:
    """Hashes of the first neighbouring tokens of a sorted set; similar sets share one of them.

    A token that only the set holds spoils two of its neighbour pairs, one that only the
    other holds at most one: ``2 (n - o) + (m - o)`` pairs for an overlap of ``o``, at most
    ``(2 n - m) / 3`` for similar sets. So the first pair that both hold is among one more.
    """
    n = F.size(s)
    pairs = F.floor((2 * n - F.ceil(NUM * n / F.lit(DEN))) / F.lit(3)).cast("int") + 1
    return F.zip_with(F.slice(s, F.lit(1), pairs), F.slice(s, F.lit(2), pairs), lambda t, u: F.xxhash64(t, u))


def line_table(docs: DataFrame, ranks: Column) -> DataFrame:
    """``doc_id, doc_row, line, n, key, prefix`` and bitmap of every line."""
    lines = _doc_rows(docs).select("doc_id", "doc_row", F.posexplode(
        F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "raw"))
    # The table is a column of the next projection only (the optimizer merges the two,
    # so the array is referred to and never copied into rows).
    sets = lines.select("*", ranks.alias("ranks")).select(
        "doc_id", "doc_row", "line", line_set(F.col("raw"), F.col("ranks")).alias("s"))
    described = sets.select("doc_id", "doc_row", "line", F.size("s").alias("n"), F.xxhash64("s").alias("key"),
                            pair_prefix(F.col("s")).alias("prefix"),
                            *[b.alias(c) for b, c in zip(_parity(F.col("s")), _BITS)])
    # Blank lines are filtered after this is written: a filter here would be pushed
    # below the projection and build every set twice.
    return described


def _plausible(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Length and bitmap filters for two sets that share a token pair."""
    differ = a["n"] + b["n"] - 2 * needed(a["n"], b["n"])
    first, *rest = [a[c].bitwiseXOR(b[c]) for c in _BITS]
    whole = F.bit_count(first.bitwiseXOR(rest[0]).bitwiseXOR(rest[1]).bitwiseXOR(rest[2]))
    # The cheap test of 64 bits settles most; that of 256 says nothing (null) where a set is short.
    return ((DEN * F.least(a["n"], b["n"]) >= NUM * F.greatest(a["n"], b["n"])) & (F.bit_count(first) <= differ)
            & F.coalesce(whole + sum(F.bit_count(x) for x in rest) <= differ, F.lit(True)))


_FIELDS = ("at", "n", *_BITS)


def _bits_held(places: Column, bits: int, rows: DataFrame) -> Column:
    """The ``places`` (0 to ``2 ** bits`` - 1) of ``rows`` as a bitmap of longs, a scalar subquery."""
    longs = rows.groupBy(F.shiftright(places, 6).cast("int").alias("w")).agg(
        F.bit_or(_bit(places.bitwiseAND(F.lit(63)))).alias("held"))
    return _dense(longs, "w", "held", 1 << (bits - 6))


def _maybe_held(column: Column, keys: DataFrame, key: Column) -> Column:
    """May ``column`` be among the ``key`` of ``keys``? A bitmap of ``2 ** SHARED_BITS`` bits; no misses."""
    def place(value: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(value), 64 - SHARED_BITS)

    held = _bits_held(place(key), SHARED_BITS, keys)
    return F.get(held, F.shiftright(place(column), 6).cast("int")).bitwiseAND(
        _bit(place(column).bitwiseAND(F.lit(63)))) != 0


def distinct_sets(lines: DataFrame, first: DataFrame) -> DataFrame:
    """``key, prefix`` of every set that may have similar ones."""
    rows = lines.where(F.col("n") >= JOINED).select("key", "prefix")
    repeated = _maybe_held(F.col("key"), first.where("copies > 1"), F.col("key"))
    # Only lines that may repeat are shuffled, pre-aggregated in each task: a line
    # that a third of the documents share is one row of each of its token groups.
    once = cut(rows.where(repeated).dropDuplicates(["key"]), "lines-distinct")
    every = rows.where(~repeated).unionByName(once)
    every.cut_path = once.cut_path
    return every


def shared_tokens(sets: DataFrame) -> DataFrame:
    """``key, token`` of every token pair that is in the prefixes of two sets."""
    every = sets.select("key", F.explode("prefix").alias("token"))
    shared = cut(every.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1").select("token"), "lines-shared")
    rows = cut(every.where(_maybe_held(F.col("token"), shared, F.col("token"))).join(shared, "token")
               .select("key", "token"), "lines-tokens")
    discard(shared)
    return rows


def token_groups(tokens: DataFrame, first: DataFrame, frame: int = FRAME) -> DataFrame:
    """Rows of token pairs with partners among the ``frame`` sets before them or the earliest, or in long groups."""
    rows = tokens.join(first.select("key", *_FIELDS), "key")
    group = Window.partitionBy("token")
    by_place = group.orderBy("at")
    set_ = F.struct(*_FIELDS)
    before = F.collect_list(set_).over(by_place.rowsBetween(-frame, -1))
    placed = rows.select("token", *_FIELDS, before.alias("before"), F.first(set_).over(
                             by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("earliest"),
                         F.row_number().over(by_place).alias("nth"), F.count("*").over(group).alias("size"))
    own = {f: F.col(f) for f in _FIELDS}
    met = F.when(F.col("nth") > frame + 1, F.concat("before", F.array("earliest"))).otherwise(F.col("before"))
    partners = F.transform(F.filter(met, lambda e: _plausible(own, {f: e[f] for f in _FIELDS})), lambda e: e["at"])
    return cut(placed.select("token", *_FIELDS, "nth", "size", partners.alias("partners"))
                 .where((F.size("partners") > 0) | (F.col("size") > frame + 2)), "lines-groups")


def verified(pairs: DataFrame, first: DataFrame, docs: DataFrame, ranks: Column) -> DataFrame:
    """``later``: the open sets of the ``pairs`` that are similar; the other set of a pair is the earlier one."""
    ats = pairs.select(F.col("open").alias("k")).unionByName(pairs.select(F.col("other").alias("k"))).distinct()
    places = cut(ats.join(first, F.col("k") == F.col("at")).select(
        "at", F.col("place.doc_row").alias("w_row"), F.col("place.line").alias("w_line")), "lines-places")
    lines = _doc_rows(docs).select("doc_row", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "raw"))
    # Only lines that may be wanted are shuffled.
    wanted = lines.where(_maybe_held(F.xxhash64("doc_row", "line"), places, F.xxhash64("w_row", "w_line")))
    read = wanted.join(places, (F.col("doc_row") == F.col("w_row")) & (F.col("line") == F.col("w_line")))
    sets = cut(read.select("at", "raw", ranks.alias("ranks")).select(
        F.col("at").alias("s_key"), line_set(F.col("raw"), F.col("ranks")).alias("s"))
        .dropDuplicates(["s_key"]), "lines-sets")
    mine = sets.select(F.col("s_key").alias("a_key"), F.col("s").alias("a_set"))
    theirs = sets.select(F.col("s_key").alias("b_key"), F.col("s").alias("b_set"))
    met = pairs.join(theirs, F.col("other") == F.col("b_key")).join(mine, F.col("open") == F.col("a_key"))
    overlap = F.size(F.array_intersect("a_set", "b_set"))
    similar = met.where(overlap >= needed(F.size("a_set"), F.size("b_set")))
    later = cut(similar.select(F.col("open").alias("later")).distinct(), "lines-later")
    discard(places, sets)
    return later


def _without(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The ``rows`` whose ``at`` is no ``later`` of ``keys``; only those that a bitmap does not clear are shuffled."""
    maybe = _maybe_held(F.col("at"), keys, F.col("later"))
    return rows.where(~maybe).unionByName(
        rows.where(maybe).join(keys, F.col("at") == F.col("later"), "left_anti"))


def later_keys(tokens: DataFrame, first: DataFrame, docs: DataFrame, ranks: Column,
               frame: int = FRAME) -> DataFrame:
    """``later``: the sets that are similar to a set that occurs earlier."""
    groups = token_groups(tokens, first, frame)
    discard(tokens)
    near = cut(groups.select(F.col("at").alias("open"), F.explode("partners").alias("other")).distinct(), "lines-near")
    settled = verified(near, first, docs, ranks)
    discard(near)
    long = groups.where(F.col("size") > frame + 2).select("token", *_FIELDS, "nth")
    open_ = _without(long.where(F.col("nth") > frame + 2), settled).select(
        F.col("token").alias("o_token"), *[F.col(f).alias(f"o_{f}") for f in (*_FIELDS, "nth")])
    # The frame and the earliest set have been met.
    far = open_.join(long.where("nth > 1"), F.col("o_token") == F.col("token")).where(
        (F.col("o_nth") - F.col("nth") > frame)
        & _plausible({f: F.col(f"o_{f}") for f in _FIELDS}, {f: F.col(f) for f in _FIELDS}))
    rest = cut(far.select(F.col("o_at").alias("open"), F.col("at").alias("other")).distinct(), "lines-far")
    discard(groups)
    later = settled.unionByName(verified(rest, first, docs, ranks)).distinct()
    discard(rest)
    return later


def removed_lines(docs: DataFrame, frame: int = FRAME) -> DataFrame:
    """``doc_row, removed``: per document the numbers of the lines that go."""
    ranks = bucket_ranks(docs)
    wide = cut(line_table(docs, ranks), "lines")
    lines = wide.where("n > 0")
    # Size and bitmap are the same for all lines of a key.
    keys = lines.groupBy("key").agg(
        F.min(F.struct("doc_id", "doc_row", "line")).alias("place"), F.count("*").alias("copies"),
        F.min("n").alias("n"), *[F.min(c).alias(c) for c in _BITS])
    # From here on a set is its number, ``at``; earlier sets have smaller ones.
    first = cut(keys.orderBy("place").withColumn("at", F.monotonically_increasing_id()), "lines-first")
    sets = distinct_sets(lines, first)
    tokens = shared_tokens(sets)
    # Of a line its place and key are needed again; the wide table goes.
    lines = cut(lines.select("doc_id", "doc_row", "line", "key"), "lines-keys")
    discard(wide, sets)
    later = later_keys(tokens, first, docs, ranks, frame)
    # Keys whose lines go: all of them when the set is similar to an earlier one, else all but the first.
    going = first.join(later, F.col("at") == F.col("later"), "left").where("copies > 1 OR later IS NOT NULL").select(
        F.col("key").alias("g_key"), F.col("later").isNotNull().alias("all_go"), F.col("place").alias("kept_place"))
    place = F.struct("doc_id", "doc_row", "line")
    gone = lines.select("doc_id", "doc_row", "line", "key").join(going, F.col("key") == F.col("g_key")).where(
        F.col("all_go") | ~place.eqNullSafe(F.col("kept_place")))
    return gone.groupBy("doc_row").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def drop_later_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that repeat earlier ones; documents left without a word go."""
    gone = removed_lines(docs).withColumnRenamed("doc_row", "g_row")
    joined = docs.join(gone, F.xxhash64(docs["doc_id"], docs["text"]) == gone["g_row"], "left")
    kept = let(F.split(docs["text"], "\n"), lambda ls: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), gone["removed"]), lambda i: F.get(ls, i)), "\n"))
    rewritten = F.when(gone["removed"].isNull(), docs["text"]).otherwise(kept)
    row = F.struct(*[(rewritten if c == "text" else docs[f"`{c}`"]).alias(c) for c in docs.columns])
    rows = joined.select(row.alias("row"), gone["removed"].isNull().alias("same"))
    return rows.where(F.col("same") | (F.btrim("row.text", F.lit(SPACE_CHARS)) != "")).select("row.*")


def op5_line_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = removed_lines(docs).withColumnRenamed("doc_row", "g_row")
    rows = _doc_rows(docs).select("doc_id", "doc_row", F.size(F.split(
        F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    return rows.join(gone, F.col("doc_row") == F.col("g_row"), "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed_lines"))


SQL = f"""
WITH l AS (SELECT doc_id, line, list_sort(list_distinct(list_filter(regexp_split_to_array(raw, '[\\x20\\x09-\\x0D]+'),
        lambda x: x <> ''))) AS s FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line FROM documents)),
t AS (SELECT * FROM l WHERE len(s) > 0),
f AS (SELECT s, min(doc_id * 1000000 + line) AS place, row_number() OVER () AS k FROM t GROUP BY s),
w AS (SELECT w, count(*) AS df FROM (SELECT unnest(s) AS w FROM f) GROUP BY w),
x AS (SELECT k, w, row_number() OVER (PARTITION BY k ORDER BY df, w) AS pos, n FROM
        (SELECT k, len(s) AS n, unnest(s) AS w FROM f) JOIN w USING (w)
      QUALIFY pos <= n - ceil({NUM} * n / {DEN}) + 1),
c AS (SELECT DISTINCT a.k AS a, b.k AS b FROM x a JOIN x b USING (w) WHERE a.k <> b.k
      AND {DEN} * a.n >= {NUM} * b.n AND {DEN} * b.n >= {NUM} * a.n),
v AS (SELECT DISTINCT b AS k FROM c JOIN f p ON p.k = a JOIN f q ON q.k = b WHERE p.place < q.place
      AND {NUM + DEN} * len(list_intersect(p.s, q.s)) >= {NUM} * (len(p.s) + len(q.s))),
r AS (SELECT doc_id, list_sort(list(line)) AS gone FROM t JOIN f USING (s) LEFT JOIN v USING (k)
      WHERE v.k IS NOT NULL OR place <> doc_id * 1000000 + line GROUP BY doc_id)
SELECT doc_id, CAST(len(string_split(coalesce(text, ''), chr(10))) AS BIGINT) AS n_lines,
       CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, array_to_string(gone, ',') AS removed_lines
FROM documents LEFT JOIN r USING (doc_id)"""
