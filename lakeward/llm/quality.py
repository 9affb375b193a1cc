"""Operator 2: quality rules with risk-controlled thresholds (DataFrame functions only).

Every rule rejects documents whose score exceeds a cutoff. The cutoffs come from
labelled holdout documents: for each stratum (language) and rule, the cutoffs are
tested from the loosest to the strictest; a cutoff is certified when the exact
binomial tail ``P(Bin(n_good, alpha) <= good documents it rejects)`` is at most
``delta / number of (stratum, rule) tests`` (fixed-sequence testing inside a rule,
Bonferroni across rules and strata). With confidence ``1 - delta`` no stratum then
loses more than ``alpha`` of its good documents to one rule, so at most
``alpha * number of rules`` to all of them. Among the certified cutoffs that
reject more bad than good holdout documents the one with the largest surplus is
used (the loosest of equals); without one the rule is off in that stratum.

Defined results: null or blank text has no words and fails the base rules; a null
and an empty language are one stratum; labels with a null id or quality are ignored, a
document with several labels takes the worst; with no labels (or no labelled
document of a stratum) only the base rules decide; repeated rows are judged alike,
each on its own; other columns, of any name, are kept by ``kept_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.common import SPACE_CHARS, cut, let, read_table, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
ALPHA_TOTAL = 0.02  # share of a stratum's good documents that all rules together may reject
BROADCAST_STRATA = 10_000
DELTA = 0.05        # chance that any stratum or rule breaks that bound
# Candidate cutoffs of each rule, loosest first when read from the right.
CUTOFFS = {
    "symbols": [0, 5, 10, 20, 40, 60, 80, 100, 150, 200, 300, 500],          # per 1000 word characters
    "dup_lines": [0, 20, 50, 100, 150, 200, 250, 300, 400, 500, 700, 900],   # per 1000 lines
    "repeats": [0, 20, 50, 100, 150, 200, 250, 300, 350, 400, 450, 490],     # per 1000 words
    "word_length": [550, 600, 650, 700, 750, 800, 900, 1000, 1200, 1500, 2000, 5000],  # 1/100 characters
}


def _repeat_words(ws: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in ``ws``."""
    def count(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(
            hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def covered(s: Column) -> Column:
            again = F.filter(s, lambda e, j: F.coalesce(
                (e.h == F.get(s, j - 1).h), F.lit(False)) | F.coalesce(
                (e.h == F.get(s, j + 1).h), F.lit(False)))
            at = F.sort_array(F.transform(again, lambda e: e.i))
            return F.aggregate(
                at, F.struct(F.lit(-3).alias("p"), F.lit(0).cast("long").alias("n")),
                lambda acc, p: F.struct(p.alias("p"),
                                        (acc.n + F.least(F.lit(3), p - acc.p)).alias("n")),
                lambda acc: acc.n)

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")
                      ).otherwise(let(ordered, covered))

    def windows(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(
            F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(let(hashes, count))

    return let(ws, windows)


def features(text: Column) -> Column:
    """Struct of the base counts of a text, all longs."""
    t = F.coalesce(text, F.lit(""))
    ws = words(t)
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    dup = let(lines, lambda x: F.struct(
        F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    return F.struct(
        F.size(ws).cast("long").alias("n_words"),
        F.length(F.translate(t, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        dup.n.cast("long").alias("n_lines"),
        dup.d.cast("long").alias("n_dup_lines"),
        _repeat_words(ws).cast("long").alias("n_repeat_words"))


def base_failed(f: Column) -> Column:
    return (f.n_words < MIN_WORDS) | (100 * f.n_repeat_words > 50 * f.n_words)


def scores(f: Column) -> dict[str, Column]:
    """Integer scores; only asked of documents that pass the base rules."""
    def ratio(a: Column, scale: int, b: Column) -> Column:
        return F.floor(a * scale / F.greatest(b, F.lit(1))).cast("long")
    return {"symbols": ratio(f.n_symbols, 1000, f.word_chars),
            "dup_lines": ratio(f.n_dup_lines, 1000, f.n_lines),
            "repeats": ratio(f.n_repeat_words, 1000, f.n_words),
            "word_length": ratio(f.word_chars, 100, f.n_words)}


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """Exact ``P(Bin(n, p) <= k)``, summed in logs; 1 when ``k >= n * p`` (never certified)."""
    log, odds = F.log, F.lit(float(p / (1 - p)))
    first = n * F.log1p(F.lit(-float(p)))

    def add(acc: Column, i: Column) -> Column:
        term = acc.term + log((n - i + 1) / i * odds)
        high, low = F.greatest(acc.total, term), F.least(acc.total, term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    summed = F.aggregate(
        F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(
            F.array().cast("array<bigint>")),
        F.struct(first.alias("term"), first.alias("total")), add, lambda acc: F.exp(acc.total))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(summed)


def holdout_counts(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """Good and bad labelled documents per (stratum, rule, number of cutoffs below the score)."""
    worst = (labels.select(F.col("doc_id").alias("l_id"), F.col("quality").alias("l_q"))
             .where("l_id IS NOT NULL AND l_q IS NOT NULL")
             .groupBy("l_id").agg(F.min("l_q").alias("l_q")))
    f = F.col("f")
    rules = F.array(*[F.struct(
        F.lit(rule).alias("rule"),
        sum((F.when(score > c, 1).otherwise(0) for c in CUTOFFS[rule]), F.lit(0)).alias("above"))
        for rule, score in scores(f).items()])
    return (feats.where(~base_failed(f)).join(worst, feats.doc_id == worst.l_id)
            .select("stratum", "l_q", F.explode(rules).alias("r"))
            .groupBy("stratum", "r.rule", "r.above")
            .agg(F.count_if(F.col("l_q") == 1).alias("good"),
                 F.count_if(F.col("l_q") != 1).alias("bad")))


def thresholds(counts: DataFrame, alpha_total: float = ALPHA_TOTAL,
               delta: float = DELTA) -> DataFrame:
    """One row per stratum with a cutoff column per rule (null: the rule is off there)."""
    tests = counts.select("stratum", "rule").distinct().count()
    alpha = alpha_total / len(CUTOFFS)
    grid = F.map_from_entries(F.array(*[
        F.struct(F.lit(r), F.array(*[F.lit(c).cast("long") for c in cs]))
        for r, cs in CUTOFFS.items()]))
    group = ["stratum", "rule"]
    all_cuts = (counts.groupBy(*group).agg(
        F.sum("good").alias("n_good"),
        F.collect_list(F.struct("above", "good", "bad")).alias("bins"))  # at most one per cutoff + 1
        .select(*group, "n_good", "bins", F.posexplode(F.element_at(grid, F.col("rule"))).alias("i", "cutoff")))

    def rejected(what: str) -> Column:
        return F.aggregate(F.filter("bins", lambda b: b.above > F.col("i")), F.lit(0).cast("long"),
                           lambda acc, b: acc + b[what])

    tested = all_cuts.select(*group, "n_good", "cutoff", rejected("good").alias("k"),
                             rejected("bad").alias("bad"))
    certified = (tested.where((F.col("n_good") > 0) & (F.col("bad") > F.col("k")))
                 .where(binomial_tail(F.col("n_good"), F.col("k"), alpha) <= delta / max(tests, 1)))
    best = certified.groupBy(*group).agg(F.max(F.struct(
        (F.col("bad") - F.col("k")).alias("surplus"), F.col("cutoff"))).cutoff.alias("cutoff"))
    return best.groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in CUTOFFS])


def judge_features(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``base_failed``, ``kept`` and the cutoffs to rows with ``doc_id, lang, f``.

    The features are written once, so the text is scanned a single time.
    """
    feats = cut(feats.withColumn("stratum", F.coalesce(F.col("lang"), F.lit(""))), "quality")
    cuts = cut(thresholds(holdout_counts(feats.select("doc_id", "stratum", "f"), labels)), "quality-cuts")
    cuts = cuts.withColumnRenamed("stratum", "c_stratum")
    if cuts.count() <= BROADCAST_STRATA:  # else a shuffle join, which moves the documents
        cuts = F.broadcast(cuts)
    f = F.col("f")
    passes = F.lit(True)
    for rule, score in scores(f).items():
        passes = passes & F.coalesce(score <= F.col(f"cut_{rule}"), F.lit(True))
    return (feats.join(cuts, F.col("stratum") == F.col("c_stratum"), "left")
            .select(*feats.columns, base_failed(f).alias("base_failed"),
                    (~base_failed(f) & passes).alias("kept"),
                    *[F.col(f"cut_{r}") for r in CUTOFFS]))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with the columns of ``docs``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       "doc_id", "lang", features(F.col("text")).alias("f"))
    return judge_features(rows, labels).where("kept").select("doc.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = F.col("f")
    feats = read_table(spark, sf_dir, "documents").select(
        "doc_id", "lang", features(F.col("text")).alias("f"))
    return judge_features(feats, read_table(spark, sf_dir, "labels")).select(
        "doc_id", f.n_words.alias("n_words"), f.word_chars.alias("word_chars"),
        f.n_symbols.alias("n_symbols"), f.n_dup_lines.alias("n_dup_lines"),
        f.n_repeat_words.alias("n_repeat_words"), "base_failed", "kept")
