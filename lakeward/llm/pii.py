"""Operator 7: information-theoretic sanitisation of personal data (DataFrame functions only).

Base entities (e-mail, ip, card, phone) are found by pattern with their code point
spans. A term, a whole run of two letters or more, that lies within ``CONTEXT`` code
points before or after an entity may reveal it. Personal data mostly occur once, so what
a term reveals is estimated at three levels of every entity: its exact value, its
group (mail domain, network of two bytes, issuer digits, dialling prefix) and its kind.
With document frequencies over the whole corpus, for each level ``e`` of an entity,

    PMI(term; e) = ln(co * N / (df_term * df_e)),  IC(e) = ln(N / df_e)

a term discloses the entity when ``PMI >= DISCLOSE * IC`` at any level. At the exact
level one text is enough: a term that few other documents hold leads from the corpus to
that value. At the levels of groups and kinds the two must stand together in at least
``MIN_TEXTS`` different texts, as one text says nothing about an association, however
often it is copied. Disclosing terms near the entity become spans of kind ``term``;
``sanitise`` replaces entities by their kind, removes terms that give a level away
(``PMI >= REMOVE * IC``) and generalises the others to ``[term]``.

Copies are one row per text before anything is shuffled; a text's spans depend on
the text and the corpus only.

Defined results: null or empty text has no spans; repeated rows get equal spans; a
term in the context of several entities is one span; a run of letters that overlaps a
base span or leaves the context is no term; a level that every document holds
discloses nothing (IC 0); an empty table gives no rows; extra columns are ignored
by the query and kept by ``sanitise``.

The patterns are the contract's, written so that Java's matcher neither recurses
nor rescans: possessive repeats, and a look-behind for starts inside a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.common import cut, let, read_table

LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": f"(?:(?<![{LOCAL}])|\\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
KINDS = (*PATTERNS, "term")
TERM = "\\p{L}{2,}"
CONTEXT = 50
DISCLOSE = 0.75
REMOVE = 0.95
MIN_TEXTS = 2
EXACT = "="  # in the name of an exact level only
BROADCAST_TERMS = 100_000  # beyond, term counts are made for the whole vocabulary and joined
ISSUER_DIGITS = 6
SUBSCRIBER_DIGITS = 7  # what follows a telephone number's prefix
_SUM_CHUNK = 256
_PIECE = 256  # code points; a window reaches into two pieces at most
_WINDOW = CONTEXT + 2  # the context, one code point of the entity and one beyond the context

_SPAN = "struct<start:int,kind:int,end:int,value:string>"
_NEAR_SPAN = "struct<start:int,kind:int,end:int,value:string,before:string,after:string>"


def sums_before(lengths: Column) -> Column:
    """Running sums of an int array, exclusive; in chunks so that long arrays stay near linear."""
    def running(xs: Column) -> Column:
        return F.aggregate(xs, F.array(F.lit(0)), lambda acc, x: F.concat(
            acc, F.array(F.element_at(acc, -1) + x)))

    def all_chunks(xs: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / _SUM_CHUNK).cast("int")),
                             lambda c: running(F.slice(xs, c * _SUM_CHUNK + 1, _SUM_CHUNK)))
        return let(chunks, lambda cs: let(
            running(F.transform(cs, lambda c: F.element_at(c, -1))),
            lambda offsets: F.flatten(F.transform(cs, lambda c, i: F.transform(
                F.slice(c, F.lit(1), F.size(c) - 1), lambda x: x + F.get(offsets, i))))))

    return let(lengths, all_chunks)


def find_spans(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches with their code point spans.

    The pieces between the matches (split by the same pattern) give the positions.
    """
    empty = F.array().cast(f"array<{_SPAN}>")

    def placed(found: Column) -> Column:
        def located(gaps: Column) -> Column:
            sizes = F.transform(found, lambda m, i: F.length(m) + F.length(F.get(gaps, i)))
            return let(sums_before(sizes), lambda at: F.transform(found, lambda m, i: F.struct(
                (F.get(at, i) + F.length(F.get(gaps, i))).alias("start"),
                F.lit(kind).alias("kind"),
                (F.get(at, i) + F.length(F.get(gaps, i)) + F.length(m)).alias("end"),
                m.alias("value"))))

        return F.when(F.size(found) == 0, empty).otherwise(let(F.split(text, pattern), located))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def check(d: Column) -> Column:
        total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda acc, i: acc + let(
            F.substring(d, F.length(d) - i + 1, F.lit(1)).cast("int"),
            lambda x: F.when(i % 2 == 1, x).otherwise(x * 2 - F.when(x > 4, 9).otherwise(0))))
        return F.when(F.length(d).between(14, 19), total % 10 == 0).otherwise(F.lit(False))
    return let(_digits(value), check)


def _valid(span: Column) -> Column:
    """Whether a match counts for its kind."""
    v = span.value
    small = F.forall(F.split(v, "\\."), lambda p: F.when(
        F.length(F.regexp_replace(p, "^0+", "")) > 3, F.lit(False)).otherwise(p.cast("int") <= 255))
    checks = {"ip": small, "card": _luhn(v), "phone": F.length(_digits(v)).between(10, 15)}
    ok = F.lit(True)
    for name, check in checks.items():
        ok = F.when(span.kind == KINDS.index(name), check).otherwise(ok)
    return ok


def base_spans(text: Column) -> Column:
    """All valid base spans of a text by start and kind, with the text around them."""
    t = F.coalesce(text, F.lit(""))
    found = [find_spans(t, pattern, KINDS.index(kind)) for kind, pattern in PATTERNS.items()]
    found[0] = F.when(F.contains(t, F.lit("@")), found[0]).otherwise(F.array().cast(f"array<{_SPAN}>"))

    def with_windows(spans: Column) -> Column:
        # Pieces of equal length, cut in one pass: a window costs the same anywhere in a long text.
        pieces = F.regexp_extract_all(t, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))
        return F.when(F.size(spans) == 0, F.array().cast(f"array<{_NEAR_SPAN}>")).otherwise(
            let(pieces, lambda ps: F.transform(spans, lambda s: F.struct(
                s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end"), s.value.alias("value"),
                _window(ps, F.greatest(s.start - CONTEXT - 1, F.lit(0)), s.start + 1).alias("before"),
                _window(ps, s.end - 1, s.end + CONTEXT + 1).alias("after")))))

    return let(F.sort_array(F.filter(F.concat(*found), _valid)), with_windows)


def _window(pieces: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (or the text's end) of a text cut into pieces."""
    first = F.floor(start / _PIECE).cast("int")
    both = F.concat(F.get(pieces, first), F.coalesce(F.get(pieces, first + 1), F.lit("")))
    return F.substring(both, start - first * _PIECE + 1, end - start)


def _levels(span: Column) -> Column:
    """An entity's exact value, its group and its kind."""
    name = F.element_at(F.array(*[F.lit(k) for k in PATTERNS]), span.kind + 1)

    def all_three(value: Column) -> Column:
        group = F.when(span.kind == 0, F.substring_index(value, "@", -1)).when(
            span.kind == 1, F.substring_index(value, ".", 2)).when(
            span.kind == 2, F.left(value, F.lit(ISSUER_DIGITS))).otherwise(
            F.left(value, F.length(value) - SUBSCRIBER_DIGITS))
        return F.array(F.concat(name, F.lit(EXACT), value), F.concat(name, F.lit("~"), group), name)

    return let(F.when(span.kind == 0, F.lower(span.value)).when(
        span.kind == 1, span.value).otherwise(_digits(span.value)), all_three)


def _context_terms(span: Column) -> Column:
    """Whole runs of letters within the context of an entity, with their spans in the text.

    A window holds one code point of the entity, so that a run that goes on into it is
    seen to overlap it, and one beyond the context, so that a run that leaves it is seen too.
    """
    def side(window: Column, offset: Column, far_left: bool) -> Column:
        full = F.length(window) == _WINDOW
        kept = F.filter(find_spans(window, TERM, KINDS.index("term")), lambda t: ~(
            full & ((t.start == 0) if far_left else (t.end == _WINDOW))))
        return F.transform(kept, lambda t: F.struct(
            (t.start + offset).alias("start"), (t.end + offset).alias("end"),
            F.lower(t.value).alias("term")))
    return F.concat(side(span.before, F.greatest(span.start - CONTEXT - 1, F.lit(0)), True),
                    side(span.after, span.end - 1, False))


def _with_spans(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"),
                       base_spans(F.col("text")).alias("spans"))


def _occurrences(spanned: DataFrame) -> DataFrame:
    """``text_key, entity, term, start, end, copies``: terms near levels of entities, once per text."""
    def near(span: Column) -> Column:
        clear = F.filter(_context_terms(span), lambda t: ~F.exists(
            "spans", lambda s: (s.start < t.end) & (t.start < s.end)))
        return let(_levels(span), lambda levels: F.flatten(F.transform(clear, lambda t: F.transform(
            levels, lambda e: F.struct(e.alias("entity"), t.term.alias("term"), t.start.alias("start"),
                                       t.end.alias("end"))))))

    rows = F.array_distinct(F.flatten(F.transform("spans", near)))
    return (spanned.where(F.size("spans") > 0).select("text_key", F.explode(rows).alias("t"))
            .groupBy("text_key", "t.entity", "t.term", "t.start", "t.end")
            .agg(F.count("*").alias("copies")))


def _entity_counts(spanned: DataFrame) -> DataFrame:
    """``e_entity, df_entity``: documents that hold each level of an entity."""
    entities = F.array_distinct(F.flatten(F.transform("spans", _levels)))
    return spanned.where(F.size("spans") > 0).select(F.explode(entities).alias("e_entity")).groupBy(
        "e_entity").agg(F.count("*").alias("df_entity"))


def _term_counts(docs: DataFrame, wanted: DataFrame, broadcast_terms: int) -> DataFrame:
    """``w_term, df_term``: documents that hold each wanted term, counted over all documents."""
    # Lower case after the cut into runs, as near entities: it can change what is a letter.
    terms = F.array_distinct(F.transform(F.array_distinct(F.regexp_extract_all(
        F.coalesce("text", F.lit("")), F.lit(TERM), F.lit(0))), F.lower))
    rows = docs.select(F.explode(terms).alias("w_term"))
    if wanted.count() <= broadcast_terms:
        rows = rows.join(F.broadcast(wanted), F.col("w_term") == F.col("term"), "left_semi")
    return rows.groupBy("w_term").agg(F.count("*").alias("df_term"))


def disclosing_spans(docs: DataFrame, spanned: DataFrame,
                     broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """``text_key, terms``: the term spans of each text with ``removed`` (else generalised)."""
    occurrences = cut(_occurrences(spanned), "pii-near")
    pairs = cut(occurrences.groupBy("text_key", "entity", "term").agg(F.first("copies").alias("copies"))
                .groupBy("entity", "term").agg(F.sum("copies").alias("co"), F.count("*").alias("texts"))
                .where(F.col("entity").contains(EXACT) | (F.col("texts") >= MIN_TEXTS)), "pii-pairs")
    n_docs = float(spanned.count())
    df_term = _term_counts(docs, pairs.select("term").distinct(), broadcast_terms)
    pmi = F.log(F.col("co") * n_docs / (F.col("df_term") * F.col("df_entity")))
    ic = F.log(F.lit(n_docs) / F.col("df_entity"))
    judged = (pairs.join(df_term, F.col("term") == F.col("w_term"))
              .join(_entity_counts(spanned), F.col("entity") == F.col("e_entity"))
              .where((ic > 0) & (pmi >= DISCLOSE * ic))
              .select(F.col("entity").alias("p_entity"), F.col("term").alias("p_term"),
                      (pmi >= REMOVE * ic).alias("removed")))
    return (occurrences.join(judged, (F.col("entity") == F.col("p_entity"))
                             & (F.col("term") == F.col("p_term")))
            .groupBy("text_key", "start", "end").agg(F.max("removed").alias("removed"))
            .groupBy(F.col("text_key").alias("t_key"))
            .agg(F.sort_array(F.collect_list(F.struct("start", "end", "removed"))).alias("terms")))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, spans, terms`` for every document (``terms`` null: none)."""
    spanned = cut(_with_spans(docs), "pii-spans")
    terms = disclosing_spans(docs, spanned)
    return spanned.join(terms, F.col("text_key") == F.col("t_key"), "left").drop("t_key")


def _all_spans() -> Column:
    none = F.array().cast("array<struct<start:int,kind:int,end:int,removed:boolean>>")
    base = F.transform("spans", lambda s: F.struct(
        s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end"), F.lit(True).alias("removed")))
    terms = F.transform("terms", lambda s: F.struct(
        s.start.alias("start"), F.lit(KINDS.index("term")).alias("kind"), s.end.alias("end"),
        s.removed.alias("removed")))
    return F.sort_array(F.concat(base, F.coalesce(terms, none)))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s.kind + 1), s.start.cast("string"), s.end.cast("string"))), ",")


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; overlapping spans count from the left."""
    found = find_personal_data(docs).select(
        "text_key", _all_spans().alias("found")).where(F.size("found") > 0).dropDuplicates(["text_key"])
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def rewrite(text: Column, spans: Column) -> Column:
        def add(acc: Column, s: Column) -> Column:
            shown = F.when((s.kind == KINDS.index("term")) & s.removed, "").otherwise(
                F.element_at(names, s.kind + 1))
            return F.when(s.start < acc.at, F.struct(acc.out.alias("out"), F.greatest(
                acc.at, s.end).alias("at"))).otherwise(F.struct(
                    F.concat(acc.out, F.substring(text, acc.at + 1, s.start - acc.at), shown).alias("out"),
                    s.end.alias("at")))
        return F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), add,
                           lambda acc: F.concat(acc.out, F.substring(text, acc.at + 1, F.length(text))))

    joined = docs.join(found, F.md5(docs["text"]) == found["text_key"], "left")
    return joined.select(*[
        (F.when(found["found"].isNull(), docs["text"]).otherwise(rewrite(docs["text"], found["found"]))
         if c == "text" else docs[f"`{c}`"]).alias(c) for c in docs.columns])


def op7_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("spans", lambda s: s.kind)
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{kind}")
              for i, kind in enumerate(PATTERNS)]
    return found.select("doc_id", *counts, F.sha2(_written(F.col("spans")), 256).alias("base_sha256"),
                        _written(_all_spans()).alias("spans"))
