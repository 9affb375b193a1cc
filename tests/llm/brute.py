"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import regex
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def jaccard(rows):
    """[(id, text)] to {position: (n, component, links)}."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= 75 * (len(sets[i]) + len(sets[j]) - o):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    best = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [(len(sets[i]), best[find(i)], links[i]) for i in range(len(rows))]


def line_dedup(rows):
    """[(id, text)] with ids ascending and distinct to [removed line numbers]."""
    earlier, out = [], []
    for _, text in rows:
        gone = []
        for k, line in enumerate((text or "").split("\n")):
            s = set(words(line))
            if not s:
                continue
            if any(18 * len(s & e) >= 8 * (len(s) + len(e)) for e in earlier):
                gone.append(k)
            earlier.append(s)
        out.append(gone)
    return out


def without_lines(text, gone):
    if not gone:
        return text
    return "\n".join(x for k, x in enumerate(text.split("\n")) if k not in set(gone))


def norm(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def contaminated(text, items):
    """Items of which some stretch of 16 words lies in the text with at most two substitutions.

    Items of fewer than nine words lie in it word for word.
    """
    w, found = norm(text), set()
    for item_id, item_text in items:
        v = norm(item_text)
        if not v:
            continue
        span = min(16, len(v))
        allowed = span // 8 if span > 8 else 0
        for at in range(-len(v) + 1, len(w)):
            same = [0 <= at + p < len(w) and w[at + p] == x for p, x in enumerate(v)]
            if any(same[p:p + span].count(False) <= allowed for p in range(len(v) - span + 1)):
                found.add(item_id)
                break
    return found


def repeats(rows):
    """[(id, text)] to [(words, removed, kept words)]."""
    least = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 12):
            g = tuple(w[k:k + 13])
            least[g] = min(least.get(g, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - 12):
            if least[tuple(w[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        out.append((len(w), len(gone), [x for k, x in enumerate(w) if k not in gone]))
    return out


BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def _luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def _valid(kind, value):
    d = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in value.split(".")),
            "card": 14 <= len(d) <= 19 and _luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def base_spans(text):
    out = [(m.start(), k, m.end(), m[0]) for k, (kind, p) in enumerate(BASE)
           for m in re.finditer(p, text or "") if _valid(kind, m[0])]
    return sorted(out)


def entity_levels(kind, value):
    """An entity's exact value, its group (domain, network, issuer, prefix) and its kind."""
    if kind == 0:
        exact = value.lower()
        group = exact.split("@")[1]
    elif kind == 1:
        exact = value
        group = ".".join(value.split(".")[:2])
    else:
        exact = re.sub("[^0-9]", "", value)
        group = exact[:6] if kind == 2 else exact[:-7]
    return {(kind, "exact", exact), (kind, "group", group), (kind, "kind", "")}


def term_spans(texts, context=50):
    """Disclosing term spans of each text, from document counts over all of them."""
    n, copies = len(texts), Counter(t or "" for t in texts)
    df_term, df_entity, co, seen, near = Counter(), Counter(), Counter(), Counter(), {}
    for t, c in copies.items():
        terms = [(m.start(), m.end(), m[0].lower()) for m in regex.finditer(r"\p{L}{2,}", t)]
        for w in {w for _, _, w in terms}:
            df_term[w] += c
        spans = base_spans(t)
        free = [(x, y, w) for x, y, w in terms if not any(a < y and x < b for a, _, b, _ in spans)]
        near[t] = {(e, w, x, y) for a, kind, b, value in spans for x, y, w in free
                   if a - context <= x < y <= a or b <= x < y <= b + context
                   for e in entity_levels(kind, value)}
        for e in {e for _, kind, _, value in spans for e in entity_levels(kind, value)}:
            df_entity[e] += c
        for pair in {(e, w) for e, w, _, _ in near[t]}:
            co[pair] += c
            seen[pair] += 1
    told = {(e, w) for (e, w), k in co.items() if (e[1] == "exact" or seen[e, w] >= 2) and df_entity[e] < n
            and math.log(k * n / (df_term[w] * df_entity[e])) >= 0.75 * math.log(n / df_entity[e])}
    return [sorted({(a, b) for e, w, a, b in near[t or ""] if (e, w) in told}) for t in texts]


def runs(w, least=12):
    """Every run ``start, length, period`` of a word list, by the definition."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q) and i > start:
                found.setdefault((start, i + q - start), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def without_runs(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def run_columns(doc_id, text):
    """The columns of the periodic run query behind doc_id."""
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = runs(w)
    s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(found), s, n, q, 1000 * n // q if found else None,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(" ".join(without_runs(w, found))))


def collocations(rows, support=30, top=2000, most=4):
    """[(lang, text)] to sorted rows ``lang, rank, phrase, a, l, r, n, score``."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {g: a for g, a in c.items() if len(g) > 1 and a >= support}
        longer = Counter()
        for g, a in cand.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    longer[g[i:i + m]] = max(longer[g[i:i + m]], a)
        best = []
        for g, a in cand.items():
            if 100 * longer[g] < 80 * a:
                s, _, lo, hi = min((2000000 * a // (c[g[:k]] + c[g[k:]]), k, c[g[:k]], c[g[k:]]) for k in range(1, len(g)))
                best.append((-s, -a, " ".join(g).encode(), lo, hi))
        for rank, (s, a, p, lo, hi) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, lo, hi, n[lang], -s))
    return sorted(out)


def top_scores(rows, top=5, every=50):
    """[(id, vector)] to sorted ``query_id, rank, vec_id, score``."""
    sound = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints = [math.floor(256 * x) for x in v]
            sound[i] = min(sound.get(i, ints), ints)
    out = []
    for q in sound:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(sound[q], v)), i) for i, v in sound.items()
                            if i != q and len(v) == len(sound[q]))
            out += [(q, k, i, -s) for k, (s, i) in enumerate(scored[:top], 1)]
    return sorted(out)


def kept_by_rules(con, relation):
    from lakeward.llm.quality_sql import judged_sql
    return {r[0]: r[1] for r in con.sql(
        f"WITH {judged_sql(relation)} SELECT doc_id, kept FROM judged").fetchall()}


_TOKENIZER = []


def tokenizer_once():
    if not _TOKENIZER:
        _TOKENIZER.append(tokenizer())
    return _TOKENIZER[0]


def tokenizer():
    import public_tokenizers
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def connect():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    return con
