"""Operator 10: benchmark decontamination with spaced seeds (DataFrame functions only).

Texts become lower-case words of letters and digits. At every position of a text
each of the fixed ``MASKS`` hashes six of eight words and ignores the other two;
the hashes of documents and benchmark items are joined. A hit fixes how document
and item are aligned; the item's words are then laid over the document at that
offset, and the document is contaminated when some stretch of ``SPAN`` item words
(the whole item if shorter) differs in at most ``SPAN // 8`` positions. The two
masks lose no such overlap: any two substitutions in 16 words, or one in 9 to 15,
leave some placement of a mask untouched (tested by enumeration).

An item of one to eight words leaves no word to ignore: it is found where a document
holds all its words in order, by a mask without holes for each length that occurs
(two 64-bit hashes of the word sequence decide, so nothing is laid over).

Word hashes are 64 bits; the comparison counts equal hashes position by position.

Defined results: null or blank text, and items without a word, match
nothing; repeated rows get equal verdicts; a null id is kept as an id; no
benchmark rows: nothing is contaminated; other columns, of any name, are kept by
``clean_documents``. The benchmark side is broadcast only while it has at most
``BROADCAST_HASHES`` seed hashes; beyond, the same join is a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.common import cut, read_table

MASKS = ((0, 1, 2, 3, 4, 7), (0, 2, 4, 5, 6, 7))
MASK_SPAN = 8
SPAN = 16
MIN_WORDS = 9  # shorter items are compared whole
BROADCAST_HASHES = 200_000
NOT_WORD = "[^\\p{L}\\p{N}]+"


def word_hashes(text: Column) -> Column:
    """Array of 64-bit hashes of the lower-case words."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def seeds(wh: Column, at: Column) -> Column:
    """One hash per mask for the window of ``wh`` that starts at ``at``."""
    return F.array(*[F.xxhash64(F.lit(k), *[F.get(wh, at + i) for i in mask])
                     for k, mask in enumerate(MASKS)])


def _seeded(df: DataFrame) -> DataFrame:
    """A row per window start and mask: the columns of ``df``, ``at`` and ``seed``."""
    # explode_outer and a filter on the generated column: with explode, Catalyst
    # infers a filter on the array's size that hashes every text a second time.
    starts = F.when(F.size("wh") >= MASK_SPAN,
                    F.sequence(F.lit(0), F.size("wh") - MASK_SPAN))
    placed = df.select("*", F.explode_outer(starts).alias("at")).where("at IS NOT NULL")
    return placed.select("*", F.explode(seeds(F.col("wh"), F.col("at"))).alias("seed"))


def _longest(same: Column, span: Column) -> Column:
    """Longest stretch with at most ``span // 8`` differences (``same``: booleans)."""
    miss = F.filter(F.transform(same, lambda x, i: F.when(x, F.lit(None)).otherwise(i)),
                    lambda i: i.isNotNull())
    ends = F.concat(F.array(F.lit(-1)), miss, F.array(F.size(same)))
    allowed = F.floor(span / 8).cast("int")
    return F.get(F.transform(F.array(ends), lambda m: F.array_max(F.transform(
        m, lambda x, k: F.coalesce(F.get(m, k + allowed + 1), F.element_at(m, -1)) - x - 1))),
        F.lit(0))


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select("item_id", word_hashes(F.col("text")).alias("item_wh")).distinct()


def _runs(wh: Column, length: int) -> Column:
    """``length`` and two hashes of every run of that many words."""
    def run(at: Column) -> Column:
        held = [F.get(wh, at + i) for i in range(length)]
        return F.struct(F.lit(length).alias("length"), F.xxhash64(*held).alias("seed"),
                        F.xxhash64(F.lit(length), *held).alias("check"))
    starts = F.when(F.size(wh) >= length, F.sequence(F.lit(0), F.size(wh) - length)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, run)


def short_overlaps(keyed: DataFrame, benchmark: DataFrame, broadcast_hashes: int) -> DataFrame:
    """``doc_id, text_hash, item_id, longest``: documents that hold a short item word for word."""
    short = cut(_items(benchmark).where(F.size("item_wh").between(1, MIN_WORDS - 1)), "decontam-short")
    # At most MIN_WORDS - 1 numbers; no short item: documents give no row here.
    lengths = sorted(r[0] for r in short.select(F.size("item_wh")).distinct().collect())
    every = F.concat(F.array().cast("array<struct<length:int,seed:bigint,check:bigint>>"),
                     *[_runs(F.col("wh"), n) for n in lengths])
    runs = keyed.select("doc_id", "text_hash", F.explode_outer(every).alias("r")).where("r IS NOT NULL")
    whole = F.get(F.concat(*[F.when(F.size("item_wh") == n, _runs(F.col("item_wh"), n)).otherwise(
        F.array().cast("array<struct<length:int,seed:bigint,check:bigint>>")) for n in lengths]), F.lit(0)
                  ) if lengths else F.lit(None).cast("struct<length:int,seed:bigint,check:bigint>")
    wanted = short.select("item_id", whole.alias("i"))
    if short.count() <= broadcast_hashes:
        wanted = F.broadcast(wanted)
    return (runs.join(wanted, (F.col("r.seed") == F.col("i.seed")) & (F.col("r.check") == F.col("i.check"))
                      & (F.col("r.length") == F.col("i.length")))
            .select("doc_id", "text_hash", "item_id", F.col("i.length").cast("long").alias("longest")).distinct())


def item_words(benchmark: DataFrame) -> DataFrame:
    """``item_id, item_wh`` of the items long enough to count as evidence, once per text."""
    return _items(benchmark).where(F.size("item_wh") >= MIN_WORDS)


def overlaps(docs: DataFrame, benchmark: DataFrame,
             broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """``doc_id, text_hash, item_id, longest``: contaminated documents and their items."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        word_hashes(F.col("text")).alias("wh"))
    return long_overlaps(keyed, benchmark, broadcast_hashes).unionByName(
        short_overlaps(keyed, benchmark, broadcast_hashes))


def long_overlaps(keyed: DataFrame, benchmark: DataFrame, broadcast_hashes: int) -> DataFrame:
    """The same for the items of ``MIN_WORDS`` words or more, by spaced seeds."""
    items = cut(item_words(benchmark), "decontam-items")
    item_seeds = cut(_seeded(items.withColumnRenamed("item_wh", "wh")).select(
        F.col("seed").alias("i_seed"), "item_id", F.col("at").alias("i_at"),
        F.size("wh").alias("n_item")), "decontam-seeds")
    small = item_seeds.count() <= broadcast_hashes
    hint = F.broadcast if small else (lambda df: df)
    shift = F.col("at") - F.col("i_at")
    hits = (_seeded(keyed).join(hint(item_seeds), F.col("seed") == F.col("i_seed"))
            .select("doc_id", "text_hash", "item_id", shift.alias("shift"),
                    F.slice("wh", F.greatest(shift, F.lit(0)) + 1,
                            F.col("n_item") + F.least(shift, F.lit(0))).alias("part"))
            .groupBy("doc_id", "text_hash", "item_id", "shift").agg(F.first("part").alias("part")))
    span = F.least(F.lit(SPAN), F.size("item_wh"))
    same = F.transform("item_wh", lambda x, p: F.coalesce(
        F.get(F.col("part"), p + F.least(F.col("shift"), F.lit(0))) == x, F.lit(False)))
    laid = hits.join(hint(items.withColumnRenamed("item_id", "w_id")),
                     F.col("item_id").eqNullSafe(F.col("w_id")))
    return (laid.select("doc_id", "text_hash", "item_id", span.alias("span"),
                        _longest(same, span).cast("long").alias("longest"))
            .where("longest >= span")
            .groupBy("doc_id", "text_hash", "item_id").agg(F.max("longest").alias("longest")))


def verdicts(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document text: its items and the longest overlap."""
    return overlaps(docs, benchmark).groupBy("doc_id", "text_hash").agg(
        F.count("*").alias("n_items"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
        F.max("longest").alias("longest"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark overlap, with the columns of ``docs``."""
    bad = verdicts(docs, benchmark).select(F.col("doc_id").alias("bad_id"),
                                           F.col("text_hash").alias("bad_hash"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"])
                     & (F.xxhash64(docs["text"]) == bad["bad_hash"]), "left_anti")


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = verdicts(docs, read_table(spark, sf_dir, "benchmark")).select(
        F.col("doc_id").alias("v_id"), F.col("text_hash").alias("v_hash"),
        "n_items", "item_ids", "longest")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    return (rows.join(found, F.col("doc_id").eqNullSafe(F.col("v_id"))
                      & (F.col("text_hash") == F.col("v_hash")), "left")
            .select("doc_id", F.col("n_items").isNotNull().alias("contaminated"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.concat_ws(",", F.transform("item_ids", lambda i: i.cast("string"))).alias("item_ids"),
                    F.coalesce("longest", F.lit(0)).cast("long").alias("longest_overlap")))


# Candidates here are plain shared runs of four words, which every counted overlap has.
SQL = f"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
        '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM documents),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
        '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM benchmark),
it AS (SELECT *, least({SPAN}, len(w)) AS span FROM iw WHERE len(w) >= {MIN_WORDS}),
dg AS (SELECT doc_id, i, w[i:i + 3] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM dw)),
ig AS (SELECT item_id, j, w[j:j + 3] AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 2)) AS j FROM it)),
c AS (SELECT DISTINCT doc_id, item_id, i - j AS shift FROM dg JOIN ig USING (g)),
m AS (SELECT doc_id, item_id, span, list_concat(list_concat([0], list_filter(range(1, len(it.w) + 1),
        lambda p: p + shift < 1 OR p + shift > len(dw.w) OR dw.w[p + shift] <> it.w[p])), [len(it.w) + 1]) AS ends
      FROM c JOIN dw USING (doc_id) JOIN it USING (item_id)),
o AS (SELECT doc_id, item_id, span, list_max(list_transform(range(1, len(ends)),
        lambda k: ends[least(k + span // 8 + 1, len(ends))] - ends[k] - 1)) AS longest FROM m),
sw AS (SELECT * FROM iw WHERE len(w) BETWEEN 1 AND {MIN_WORDS - 1}),
sg AS (SELECT doc_id, k, w[i:i + k - 1] AS w FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i
      FROM dw, (SELECT DISTINCT len(w) AS k FROM sw))),
f AS (SELECT doc_id, item_id, longest FROM o WHERE longest >= span
      UNION ALL SELECT DISTINCT doc_id, item_id, k AS longest FROM sg JOIN sw USING (w)),
v AS (SELECT doc_id, count(DISTINCT item_id) AS n, max(longest) AS longest,
        list_aggregate(list_transform(list_sort(list_distinct(list(item_id))), lambda x: CAST(x AS VARCHAR)),
                       'string_agg', ',') AS ids
      FROM f GROUP BY doc_id)
SELECT doc_id, v.n IS NOT NULL AS contaminated, CAST(coalesce(v.n, 0) AS BIGINT) AS n_items,
       coalesce(v.ids, '') AS item_ids, CAST(coalesce(v.longest, 0) AS BIGINT) AS longest_overlap
FROM documents LEFT JOIN v USING (doc_id)"""
