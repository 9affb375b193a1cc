"""Operator 1: n-gram Jaccard join by T-occurrence search (DivideSkip).

A document's set is its distinct ``SHINGLE``-word shingles (64-bit hashes). Two
sets are linked when ``100 * |x & y| >= 75 * |x | y|``.

1. One pass hashes every text: set size, 64-bit fingerprint of the set, and a
   rarity sketch (``SKETCH`` counters of shingle occurrences, a fixed size). Equal
   sets are one node from here on, so copies cost one row each and no pairs.
2. Shingles get one global order, rare ones (by the sketch) first. Linked sets
   must share a shingle among the first ``n - ceil(0.75 n) + 1`` of each. Those
   prefixes are grouped by shingle. Nodes that meet in short groups are paired if
   their sizes fit and counted: linked sets of sizes n and m share at least
   ``ceil(3 (n + m) / 7) - ceil(0.75 max(n, m)) + 1`` prefix shingles (common
   shingles up to the smaller of the two last prefix shingles lie in both prefixes,
   the others behind that prefix). Nodes of a long group hang on its first node.
   The components of these pairs and stars are the cells: a link never leaves a
   cell. The order only decides which shingles are looked at, so the sketch's
   collisions cannot lose a link.
3. Only nodes of a cell with company have their texts sent again, once per block.
   Small cells are binned to blocks of about ``BLOCK`` shingles; a larger cell is
   cut by size bands (linked sizes differ by a factor of 4/3 at most, so only
   neighbouring bands meet) and by hash inside a band, and every pair of blocks
   meets in one task. Memory is two blocks whatever the cell's size.
4. In a block every node is a T-occurrence query against inverted lists of the
   nodes before it in the order of size: the L longest lists are set aside, the
   short ones are merged with a heap, nodes that reach T - L there are looked up
   in the long ones by binary search, and the overlap decides. A task returns one
   row per node: its root in the block and the number of documents linked to it.
5. Block roots of cells that span several blocks are joined by components again.

Word and shingle hashes have 64 bits; overlaps are counted on them, which errs for
a given pair with a chance below 1e-10 for sets of a million shingles.

Defined results: null or blank text has an empty set and no link; texts of fewer
than five words are one shingle; repeated rows are equal sets and linked; null ids
are never a component's id unless all its ids are null; an empty table gives no
rows; other columns are ignored (and kept by ``one_per_component``).
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.common import cut, read_table
from lakeward.llm.components import components

SHINGLE = 5
NUM, DEN = 75, 100            # similarity of at least NUM / DEN
SKETCH_BITS = 20              # raise it with the corpus: noise is the root of shingles per counter
SKETCH = 1 << SKETCH_BITS
SKETCH_PARTS = 64
BLOCK = 1_000_000             # shingles of a block
MU = 0.0085                   # DivideSkip's share of a binary probe in the cost of a merge
PAIR_RUN = 64                 # prefix shingles of up to so many nodes give their pairs
HEAP_ENTRIES = 4096           # above, the merge of the short lists runs on whole arrays
CACHE_WORDS = 500_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


class WordHashes(dict):
    """64-bit hash by word, remembered up to ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes; bytes.lower and bytes.split are the word rule."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(SHINGLE, len(w))
    total = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        total += w[k:len(w) - n + 1 + k] * _MIX[k]
        total = (total ^ (total >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return np.unique(_mixed(total))


def fingerprint(shingles: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(shingles.tobytes()), np.uint64).astype(np.int64))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def row_name() -> Column:
    """What a document's text is found again by: its id, or its text's digest where it has none."""
    return F.when(F.col("doc_id").isNull(), F.concat(F.lit("t"), F.md5(F.coalesce("text", F.lit(""))))).otherwise(
        F.concat(F.lit("i"), F.col("doc_id").cast("string")))


def sets_and_sketch(docs: DataFrame) -> DataFrame:
    """Rows of documents (``part`` -1) and of the task's sketch (``part`` 0 and up)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, counts, seen = WordHashes(), np.zeros(SKETCH, np.int32), False
        for pdf in batches:
            sizes, prints = [], []
            for text in pdf["text"]:
                s = shingle_set(text, hashes)
                sizes.append(len(s))
                prints.append(fingerprint(s))
                np.add.at(counts, bucket(s), 1)
            seen = True
            yield pd.DataFrame({"part": -1, "doc": pdf["doc"], "n": sizes, "node": prints, "counts": None})
        if seen:
            parts = counts.reshape(SKETCH_PARTS, -1)
            yield pd.DataFrame({"part": range(SKETCH_PARTS), "doc": None, "n": 0, "node": 0,
                                "counts": [p.tobytes() for p in parts]})

    return docs.select(row_name().alias("doc"), "text").mapInPandas(
        run, "part int, doc string, n bigint, node bigint, counts binary")


def collect_sketch(rows: DataFrame) -> np.ndarray:
    """The sketch's ``SKETCH`` counters, summed by part: a fixed size whatever the input."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            for part, raw in zip(pdf["part"], pdf["counts"]):
                got = np.frombuffer(raw, np.int32).astype(np.int64)
                sums[part] = sums[part] + got if part in sums else got
        if sums:
            yield pd.DataFrame({"part": list(sums), "counts": [s.tobytes() for s in sums.values()]})

    total = np.zeros(SKETCH, np.int64).reshape(SKETCH_PARTS, -1)
    parts = rows.where("part >= 0").select("part", "counts").repartition(SKETCH_PARTS, "part")
    for r in parts.mapInPandas(add, "part int, counts binary").collect():
        total[r["part"]] = np.frombuffer(bytes(r["counts"]), np.int64)
    return np.minimum(total.reshape(-1), np.iinfo(np.int32).max).astype(np.int32)


def in_order(s: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Shingles by the global order: rarest sketch counter first, then by hash."""
    return s[np.argsort(sketch[bucket(s)], kind="stable")]  # s is sorted by hash


def least_overlap(n: int) -> int:
    """Smallest overlap of a set of ``n`` with any linked set: ceil(0.75 n)."""
    return -(-NUM * n // DEN)


def prefix_length(n: int) -> int:
    return n - least_overlap(n) + 1


def linked(overlap, n, m):
    return DEN * overlap >= NUM * (n + m - overlap)


def prefixes(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """``token, node`` for the prefix of every set, once per set and task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, done = WordHashes(), set()
        for pdf in batches:
            tokens, nodes, sizes = [], [], []
            for text in pdf["text"]:
                s = shingle_set(text, hashes)
                node = fingerprint(s)
                if not len(s) or node in done:
                    continue
                done.add(node)
                head = in_order(s, sketch)[:prefix_length(len(s))]
                tokens.append(_signed(head))
                nodes.append(np.full(len(head), node, np.int64))
                sizes.append(np.full(len(head), len(s), np.int64))
            if tokens:
                yield pd.DataFrame({"token": np.concatenate(tokens), "node": np.concatenate(nodes),
                                    "n": np.concatenate(sizes)})

    return docs.select("text").mapInPandas(run, "token bigint, node bigint, n bigint")


class BlockIndex:
    """Inverted lists over the sets of a block; members are numbered by size."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        member = np.repeat(np.arange(len(sets), dtype=np.int64), self.size)
        _, token, df = np.unique(np.concatenate(sets) if sets else np.empty(0, np.uint64),
                                 return_inverse=True, return_counts=True)
        shared = df[token] > 1  # a list of one member finds nobody
        token, member = token[shared], member[shared]
        by_token = np.argsort(token, kind="stable")  # lists one after the other, members ascending
        self.lists = member[by_token]
        ordered = token[by_token]
        first = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.empty(0, bool)
        start_of = np.maximum.accumulate(np.where(first, np.arange(len(ordered)), 0))
        # Per set: where its tokens' lists start and how many members come before it.
        self.start, self.before = np.empty(len(token), np.int64), np.empty(len(token), np.int64)
        self.start[by_token] = start_of
        self.before[by_token] = np.arange(len(ordered)) - start_of
        self.token = token
        held = np.bincount(member, minlength=len(sets))
        self.at = np.r_[0, np.cumsum(held)]

    def query(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Members before ``i`` that share at least ``least_overlap`` tokens with it, and how many.

        T-occurrence search with DivideSkip: members that reach ``need - L`` in the
        heap-merged short lists are looked up in the ``L`` long ones.
        """
        need = least_overlap(int(self.size[i]))
        own = slice(self.at[i], self.at[i + 1])
        before = self.before[own]
        live = before > 0
        start, length, token = self.start[own][live], before[live], self.token[own][live]
        none = np.empty(0, np.int64)
        if len(length) < need:
            return none, none
        order = np.argsort(length, kind="stable")
        n_long = min(need - 1, int(need / (MU * log2(max(int(length[order[-1]]), 2)) + 1)))
        short, long = order[:len(order) - n_long], order[len(order) - n_long:]
        found, count = self._merge(start[short], length[short], need - n_long)
        if len(found) and len(long):
            count = count + self._probe(found, start[long], length[long], np.sort(token[long]))
        enough = count >= need
        return found[enough], count[enough]

    def _merge(self, start: np.ndarray, length: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Members that occur in at least ``least`` of the short lists."""
        total = int(length.sum())
        if total <= HEAP_ENTRIES:
            runs = [self.lists[a:a + n].tolist() for a, n in zip(start.tolist(), length.tolist())]
            hits = [(m, k) for m, k in Counter(heapq.merge(*runs)).items() if k >= least]
            return (np.array([m for m, _ in hits], np.int64), np.array([k for _, k in hits], np.int64))
        # The same merge of sorted runs as one counting pass, for lists of thousands of entries.
        ends = np.cumsum(length)
        flat = self.lists[np.repeat(start - (ends - length), length) + np.arange(total)]
        count = np.bincount(flat)
        found = np.flatnonzero(count >= least)
        return found, count[found]

    def _probe(self, found, start, length, tokens) -> np.ndarray:
        """In how many long lists each member is: binary searches over the shorter side."""
        hits = np.zeros(len(found), np.int64)
        if len(found) < len(start):  # look the lists' tokens up in the member's tokens
            for k, m in enumerate(found.tolist()):
                own = self.token[self.at[m]:self.at[m + 1]]
                at = np.minimum(np.searchsorted(own, tokens), len(own) - 1)
                hits[k] = np.count_nonzero(own[at] == tokens)
            return hits
        for a, n in zip(start.tolist(), length.tolist()):
            x = self.lists[a:a + n]
            at = np.minimum(np.searchsorted(x, found), n - 1)
            hits += x[at] == found
        return hits


def search_block(sets: list[np.ndarray], copies: np.ndarray, side: np.ndarray | None
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Root (a member number) and linked documents of every member; ``sets`` by ascending size.

    With ``side`` only links between the two sides count.
    """
    index = BlockIndex(sets)
    root, links = np.arange(len(sets)), np.zeros(len(sets), np.int64)
    for i in range(len(sets)):
        found, overlap = index.query(i)
        if not len(found):
            continue
        ok = linked(overlap, index.size[i], index.size[found])
        if side is not None:
            ok &= side[found] != side[i]
        found = found[ok]
        if len(found):
            links[i] += copies[found].sum()
            links[found] += copies[i]
            met = np.unique(np.r_[root[found], root[i]])
            if len(met) > 1:
                root[np.isin(root, met[1:])] = met[0]
    return root, links


def prefix_pairs(pref: DataFrame, most: int = PAIR_RUN) -> DataFrame:
    """Which nodes meet in a prefix shingle: ``a, b, n_a, n_b, shared``.

    A shingle with up to ``most`` nodes gives its pairs of fitting size; of a
    shingle with more, every node is paired with the first only (``shared`` null),
    which joins them to one cell without their pairs.
    """
    def pairs(node: np.ndarray, n: np.ndarray, first: np.ndarray, count: np.ndarray) -> list[tuple]:
        out = []
        for step in range(1, most):  # every row with the row `step` further on in its run
            run = np.flatnonzero((count > step) & (count <= most))
            if not len(run):
                break
            left = np.repeat(first[run], count[run] - step)
            ends = np.cumsum(count[run] - step)
            left = left + np.arange(len(left)) - np.repeat(ends - (count[run] - step), count[run] - step)
            right = left + step
            fits = (DEN * np.minimum(n[left], n[right]) >= NUM * np.maximum(n[left], n[right])) & (
                node[left] != node[right])
            out.append((node[left][fits], node[right][fits], n[left][fits], n[right][fits]))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.empty((0, 3), np.int64)   # an unfinished run of at most ``most`` + 1 rows
        hub = None                          # (token, node, n) of an unfinished longer run
        for pdf in _then_end(batches):
            rows = held if pdf is None else np.concatenate(
                [held, pdf[["token", "node", "n"]].to_numpy(np.int64)])
            if not len(rows):
                continue
            token = rows[:, 0]
            first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            count = np.diff(np.r_[first, len(token)])
            closed = len(first) if pdf is None else len(first) - 1
            stop = len(rows) if pdf is None else first[-1]
            node, n = rows[:, 1], rows[:, 2]
            stars = []
            starts, counts = first[:closed], count[:closed]
            if hub is not None:  # the first run goes on with a run whose start is gone
                if token[0] == hub[0]:
                    k = count[0]
                    stars.append(_star(hub, node[:k], n[:k]))
                    if closed == 0:
                        held = np.empty((0, 3), np.int64)
                        yield _edges([], stars)
                        continue
                    starts, counts = starts[1:], counts[1:]
                hub = None
            long = counts > most
            for a, k in zip(starts[long].tolist(), counts[long].tolist()):
                stars.append(_star((token[a], node[a], n[a]), node[a + 1:a + k], n[a + 1:a + k]))
            made = pairs(node, n, starts, counts)
            held = rows[stop:]
            if len(held) > most:
                hub = tuple(held[0])
                stars.append(_star(hub, held[1:, 1], held[1:, 2]))
                held = np.empty((0, 3), np.int64)
            yield _edges(made, stars)

    dealt = pref.repartition("token").sortWithinPartitions("token", "node")
    return dealt.mapInPandas(run, "a bigint, b bigint, n_a bigint, n_b bigint, shared bigint")


def _then_end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | None]:
    yield from batches
    yield None


def _star(hub: tuple, node: np.ndarray, n: np.ndarray) -> tuple:
    far = node != hub[1]
    return (np.full(int(far.sum()), hub[1]), node[far], np.full(int(far.sum()), hub[2]), n[far])


def _edges(pairs: list[tuple], stars: list[tuple]) -> pd.DataFrame:
    columns = ["a", "b", "n_a", "n_b", "shared"]
    parts = []
    for some, is_star in ((pairs, False), (stars, True)):
        flat = [np.concatenate([x[i] for x in some]) for i in range(4)] if some else [np.empty(0, np.int64)] * 4
        got, times = np.unique(np.stack(flat, axis=1), axis=0, return_counts=True)
        frame = pd.DataFrame(got, columns=columns[:4])
        frame["shared"] = pd.array([None] * len(got), "Int64") if is_star else pd.array(times, "Int64")
        parts.append(frame)
    return pd.concat(parts, ignore_index=True)


def cell_edges(met: DataFrame) -> DataFrame:
    """Edges between nodes that may be linked: pairs with enough shared prefix shingles, and stars.

    A pair that also meets in a longer run is joined by that run's star, so the
    shared shingles of all other pairs are counted in full.
    """
    n, m = F.col("n_a"), F.col("n_b")
    larger = F.greatest(n, m)
    overlap = F.ceil(F.lit(NUM) * (n + m) / (NUM + DEN))
    needed = F.greatest(F.lit(1), overlap - F.ceil(F.lit(NUM) * larger / DEN) + 1)
    totals = met.groupBy("a", "b", "n_a", "n_b").agg(
        F.sum("shared").alias("shared"), F.max(F.col("shared").isNull()).alias("star"))
    return totals.where(F.col("star") | (F.col("shared") >= needed)).select("a", "b")


def block_rows(cells: DataFrame, block: int = BLOCK) -> DataFrame:
    """Deals the nodes of cells to blocks: adds ``key`` (a task) and ``side`` (-1: one block)."""
    weight = cells.groupBy("cell").agg(F.sum("n").alias("w"))
    with_w = cells.join(weight.select(F.col("cell").alias("w_cell"), "w"), F.col("cell") == F.col("w_cell")).drop("w_cell")
    small = with_w.where(F.col("w") <= block)
    total = small.agg(F.sum("n")).first()[0] or 0
    bins = ceil(total / block) + 1
    binned = small.select("node", "n", "copies", "rep", F.concat(
        F.lit("bin "), F.pmod(F.xxhash64("cell"), F.lit(bins))).alias("key"), F.lit(-1).alias("side"))
    large = with_w.where(F.col("w") > block).withColumn(
        "band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(DEN / NUM))).cast("int"))
    parts = large.groupBy("cell", "band").agg(F.ceil(F.sum("n") / block).cast("int").alias("parts"))

    def near(step: int) -> DataFrame:
        return parts.select(F.col("cell").alias(f"c{step}"), (F.col("band") - step).alias(f"b{step}"),
                            F.col("parts").alias(f"parts{step}"))

    dealt = large
    for step in (0, 1, -1):
        other = near(step)
        dealt = dealt.join(other, (F.col("cell") == F.col(f"c{step}")) & (F.col("band") == F.col(f"b{step}")),
                           "inner" if step == 0 else "left").drop(f"c{step}", f"b{step}")
    own = F.pmod(F.xxhash64("node"), F.col("parts0"))

    def keys(kind, low, high, band, side):
        return F.struct(F.concat_ws(" ", F.lit(kind), F.col("cell"), band, low, high).alias("key"),
                        side.alias("side"))

    def upto(n):
        return F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(
            F.array().cast("array<int>"))

    same = F.transform(upto(F.col("parts0")), lambda j: keys(
        "band", F.least(own, j), F.greatest(own, j), F.col("band"),
        F.when(own == j, -1).when(own < j, 0).otherwise(1)))
    above = F.transform(upto(F.col("parts1")), lambda j: keys("step", own, j, F.col("band"), F.lit(0)))
    below = F.transform(upto(F.col("parts-1")), lambda j: keys("step", j, own, F.col("band") - 1, F.lit(1)))
    spread = dealt.select("node", "n", "copies", "rep", F.explode(F.concat(same, above, below)).alias("k")).select(
        "node", "n", "copies", "rep", "k.key", "k.side")
    return binned.unionByName(spread)


def block_links(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, root, n_links`` of every node in every block it was dealt to."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        hashes, seen, held = WordHashes(), set(), []
        for node, copies, side, text in zip(pdf["node"], pdf["copies"], pdf["side"], pdf["text"]):
            if node in seen:
                continue
            s = shingle_set(text, hashes)
            if fingerprint(s) == node:  # another text under the same id is another node
                seen.add(node)
                held.append((len(s), node, copies, side, s))
        held.sort(key=lambda x: x[:2])
        nodes = np.array([h[1] for h in held], np.int64)
        sides = np.array([h[3] for h in held], np.int64)
        root, links = search_block([h[4] for h in held], np.array([h[2] for h in held], np.int64),
                                   sides if (sides >= 0).any() else None)
        return pd.DataFrame({"node": nodes, "root": nodes[root], "n_links": links})

    named = docs.select("doc_id", row_name().alias("t_name"), "text")
    texts = named.where(F.col("doc_id").isNotNull()).select("t_name", "text").unionByName(
        named.where(F.col("doc_id").isNull()).groupBy("t_name").agg(F.first("text").alias("text")))
    joined = rows.join(texts, F.col("rep") == F.col("t_name")).select("key", "side", "node", "copies", "text")
    return joined.groupBy("key").applyInPandas(run, "node bigint, root bigint, n_links bigint")


def jaccard_components(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links, node, is_first`` for every document.

    ``is_first``: the set is the one of its component that ``one_per_component`` keeps, and the
    id is the component's; true for documents with an empty set.
    """
    id_type = docs.schema["doc_id"].dataType
    docs = docs.select("doc_id", "text")
    raw = cut(sets_and_sketch(docs), "ngram-sets")
    sketch = collect_sketch(raw)
    own_id = F.when(F.col("doc").startswith("i"), F.expr("substring(doc, 2)").cast(id_type))
    members = raw.where("part = -1").select(own_id.alias("doc_id"), "n", "node", "doc")
    nodes = cut(members.where("n > 0").groupBy("node", "n").agg(
        F.min("doc_id").alias("least_id"), F.min("doc").alias("rep"), F.count("*").alias("copies")), "ngram-nodes")
    cells = components(cell_edges(prefix_pairs(prefixes(docs, sketch))), "a", "b", "ngram-cells")
    celled = cut(nodes.join(cells.select(F.col("node").alias("c_node"), F.col("component").alias("cell")),
                            F.col("node") == F.col("c_node")).drop("c_node"), "ngram-celled")
    found = cut(block_links(block_rows(celled, block), docs), "ngram-links")
    roots = components(found.select("node", "root"), "node", "root", "ngram-roots")
    links = found.groupBy("node").agg(F.sum("n_links").alias("other_links"))
    per_node = (nodes.join(roots.select(F.col("node").alias("r_node"), "component"),
                           F.col("node") == F.col("r_node"), "left").drop("r_node")
                .join(links.select(F.col("node").alias("l_node"), "other_links"),
                      F.col("node") == F.col("l_node"), "left").drop("l_node")
                .withColumn("component", F.coalesce("component", "node")))
    first = F.min(F.struct(F.col("least_id").isNull(), "least_id", F.col("node").alias("first_node")))
    smallest = per_node.groupBy(F.col("component").alias("s_component")).agg(first.alias("first"))
    info = per_node.join(smallest, F.col("component") == F.col("s_component")).select(
        F.col("node").alias("i_node"), F.col("first.least_id").alias("component_id"), "first.first_node",
        (F.coalesce("other_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return members.join(info, (F.col("node") == F.col("i_node")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "node",
        ((F.col("n") == 0) | ((F.col("node") == F.col("first_node")) & F.col("doc_id").eqNullSafe(
            F.col("component_id")))).alias("is_first"))


def one_per_component(docs: DataFrame) -> DataFrame:
    """``docs`` with the document of the smallest id of every component, and no others.

    Documents with an empty set all stay. Rows with equal id and text are one
    document, of which one row stays. Where a component has no id, or its smallest id
    stands for several texts, the set of the smallest fingerprint stays, once, with the
    text of the smallest digest.
    """
    found = cut(jaccard_components(docs).select("doc_id", "n_shingles", "node", "is_first"), "ngram-found")
    first = found.where("is_first")
    ids = first.select(F.col("doc_id").alias("k_id")).distinct()
    kept = docs.join(ids, docs["doc_id"].eqNullSafe(ids["k_id"]), "left_semi")
    repeated = found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("doc_id").alias("r_id"))
    if repeated.isEmpty():
        return kept
    repeated = cut(repeated, "ngram-repeated")
    same = kept["doc_id"].eqNullSafe(repeated["r_id"])
    several = kept.join(repeated, same, "left_semi")
    chosen = _first_texts(several.select("doc_id", "text"), first)
    digest = F.md5(F.coalesce(several["text"], F.lit("")))
    one = several.join(chosen, several["doc_id"].eqNullSafe(chosen["c_id"]) & (digest == chosen["c_digest"]),
                       "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, same, "left_anti").unionByName(one)


def _first_texts(docs: DataFrame, first: DataFrame) -> DataFrame:
    """``c_id, c_digest``: which texts stay of ids (or of no id) that stand for several rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for pdf in batches:
            sets = [shingle_set(text, hashes) for text in pdf["text"]]
            yield pd.DataFrame({"name": pdf["name"], "digest": pdf["digest"], "n": [len(s) for s in sets],
                                "node": [fingerprint(s) for s in sets]})

    id_type = docs.schema["doc_id"].dataType
    prints = cut(docs.select(F.col("doc_id").cast("string").alias("name"), F.md5(
        F.coalesce("text", F.lit(""))).alias("digest"), "text").mapInPandas(
            run, "name string, digest string, n bigint, node bigint"), "ngram-prints")
    texts = prints.select(F.col("name").cast(id_type).alias("c_id"), F.col("digest").alias("c_digest"), "n", "node")
    wanted = first.where("n_shingles > 0").select(F.col("doc_id").alias("f_id"), F.col("node").alias("f_node")).distinct()
    full = texts.where("n > 0").join(wanted, F.col("c_id").eqNullSafe(F.col("f_id")) & (
        F.col("node") == F.col("f_node")), "left_semi").groupBy("c_id", "node").agg(F.min("c_digest").alias("c_digest"))
    return full.select("c_id", "c_digest").unionByName(
        texts.where("n = 0").select("c_id", "c_digest")).distinct()


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "n_links")


def links_sql(docs: str) -> str:
    """CTEs ending in ``link(a, b)`` (both directions) and ``comp(doc_id, component_id)``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
nw AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {docs}),
sh AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < {SHINGLE} THEN w ELSE w[i:i + {SHINGLE - 1}] END AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM nw WHERE len(w) > 0)),
sn AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
link AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM sh x JOIN sh y USING (s)
        WHERE x.doc_id <> y.doc_id GROUP BY ALL) JOIN sn p ON p.doc_id = a JOIN sn q ON q.doc_id = b
        WHERE {DEN} * o >= {NUM} * (p.n + q.n - o)),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM {docs} UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.doc_id),
comp AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)"""


SQL = f"""WITH RECURSIVE {links_sql('documents')}
SELECT doc_id, CAST(coalesce(sn.n, 0) AS BIGINT) AS n_shingles, component_id,
       CAST((SELECT count(*) FROM link WHERE a = comp.doc_id) AS BIGINT) AS n_links
FROM comp LEFT JOIN sn USING (doc_id)"""
