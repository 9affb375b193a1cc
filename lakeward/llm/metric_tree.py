"""Operator 13: exact top-k search by best-first search of paged M-trees.

Vectors become integers, ``floor(256 * x)``; the score is the integer inner product. By
Cauchy-Schwarz and the triangle inequality an object o with routing object c has
``q.o <= q.c + |q| * d(o, c)``, so covering radii and stored distances bound scores.

* Directory: ``ROUTES`` rows (those with the smallest hash of their id: a bounded sample, it
  only decides where rows lie) are the top routing objects. Every row joins the nearest
  one; each route keeps the covering radius of its rows.
* Trees: the rows of a route are dealt by hash into chunks of about ``CHUNK`` rows, so a hot
  route (one vector may be a third of the table) is many chunks. One task builds a chunk's
  pages: at most ``PAGE`` rows near a page's routing object, the covering radius, the
  distance to the chunk's root and each row's distance to the routing object. Pages are
  written once as a table in the shared folder and read back.
* Search: a query starts with the k-th best score among the routing objects, which are
  rows themselves, and goes to the routes whose bound reaches it. In a chunk, pages whose
  bound from the stored distance to the root is too low are passed over without a
  computation; the others enter a heap by the bound of their routing object, the best
  is opened first, rows are passed over by their stored distances, and the search ends when the
  best bound is below the k-th best score so far. The best rows of all chunks meet per query.

Every row is indexed and every bound has a margin for rounding, so the result is exact. Queries
meet a chunk in blocks of about ``BLOCK``; a task holds one chunk and one block. In
high dimensions the bounds prune little and the search nears queries times rows.

Defined results: vectors that are null or hold null or non-finite components take no part,
nor do rows without an id; a vector meets those of its own length only; rows with equal
ids are one row, with the smallest vector; ties go to the smaller id; a query with fewer
than k candidates gets them all; an empty table gives no rows; other columns are
ignored. A vector whose squared length needs over 63 bits is an error.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeward.llm.common import cut, read_table

SCALE = 256
TOP = 5
ROUTES = 64
CHUNK = 2048
PAGE = 128
BLOCK = 2048
_MARGIN = 1e-9


def integer_vectors(rows: DataFrame) -> DataFrame:
    """``id, dim, vector`` (array of long) of the rows that take part."""
    sound = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
             & F.forall("embedding", lambda x: F.coalesce(
                 x.cast("double").between(F.lit(-1.7976931348623157e308), F.lit(1.7976931348623157e308)), F.lit(False))))
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = rows.where(sound).select(F.col("vec_id").cast("long").alias("id"), vector.alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    checked = F.when(square < 2.0 ** 63, F.col("vector")).otherwise(
        F.raise_error(F.concat(F.lit("vector too long for 64-bit products: "), F.col("id").cast("string"))))
    return (rows.groupBy("id").agg(F.min("vector").alias("vector"))
            .select("id", F.size("vector").alias("dim"), checked.alias("vector")))


def _matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, np.int64) for v in vectors], np.int64).reshape(len(vectors), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of a from the row b, with a margin upwards."""
    gap = a.astype(np.float64) - b.astype(np.float64)
    return np.sqrt((gap * gap).sum(axis=1)) * (1 + _MARGIN)


class Directory:
    """The routing objects of each vector length: ``routes * lengths`` vectors, a fixed number a length."""

    def __init__(self, sample: list):
        by: dict[int, list] = {}
        for row in sample:
            by.setdefault(row["dim"], []).append((row["id"], row["vector"]))
        self.ids = {d: np.array([i for i, _ in v], np.int64) for d, v in by.items()}
        self.objects = {d: _matrix([x for _, x in v]) for d, v in by.items()}
        self.radius: dict[tuple[int, int], float] = {}
        self.chunks: dict[tuple[int, int], int] = {}


def _directory(vectors: DataFrame, routes: int) -> Directory:
    # Routes are few rows of each length; lengths of a table are few.
    first = Window.partitionBy("dim").orderBy(F.xxhash64("id"), "id")
    return Directory(vectors.withColumn("place", F.row_number().over(first)).where(F.col("place") <= routes)
                     .select("id", "dim", "vector").collect())


def _routed(vectors: DataFrame, directory) -> DataFrame:
    """``vectors`` with the nearest ``route`` and the distance ``away`` from it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                rows = _matrix(list(part["vector"]))
                away = np.stack([_distances(rows, c) for c in directory.value.objects[dim]], axis=1)
                route = away.argmin(axis=1)
                yield part.assign(route=route.astype(np.int32), away=away[np.arange(len(rows)), route])

    return vectors.mapInPandas(run, "id long, dim int, vector array<long>, route int, away double")


def _pages(pdf: pd.DataFrame, page: int = PAGE) -> pd.DataFrame:
    """The pages of one chunk: rows near a routing object, which is one of them."""
    rows, ids = _matrix(list(pdf["vector"])), pdf["id"].to_numpy()
    root, out, todo = rows[0], [], [np.arange(len(rows))]
    while todo:
        at = todo.pop()
        if len(at) <= page or not (rows[at] != rows[at[0]]).any():
            # Equal rows cannot be told apart by distance: pages by order.
            for k in range(0, len(at), page):
                own = at[k:k + page]
                centre = rows[own[0]]
                away = _distances(rows[own], centre)
                out.append((float(away.max()), float(_distances(centre[None], root)[0]), centre, ids[own], rows[own].ravel(), away))
            continue
        # Two far objects share the rows out by distance.
        a = at[_distances(rows[at], rows[at[0]]).argmax()]
        far = _distances(rows[at], rows[a])
        b = at[far.argmax()]
        nearer = far <= _distances(rows[at], rows[b])
        todo += [at[nearer], at[~nearer]]
    made = pd.DataFrame(out, columns=["radius", "to_root", "centre", "ids", "vectors", "away"])
    for k in ("dim", "route", "chunk"):
        made[k] = pdf[k].iloc[0]
    made["root"] = [root] * len(made)
    return made[["dim", "route", "chunk", "root", "radius", "to_root", "centre", "ids", "vectors", "away"]]


_PAGE_ROW = ("dim int, route int, chunk int, root array<long>, radius double, to_root double, centre array<long>, "
             "ids array<long>, vectors array<long>, away array<double>")


def _upper(score, length: float, distance):
    bound = score + length * distance
    return bound + np.abs(bound) * _MARGIN + 1e-6


class Chunk:
    """One chunk's pages in memory, searched best first."""

    def __init__(self, pages: pd.DataFrame):
        self.root = np.asarray(pages["root"].iloc[0], np.int64)
        self.centres = _matrix(list(pages["centre"]))
        self.radius, self.to_root = pages["radius"].to_numpy(), pages["to_root"].to_numpy()
        self.ids = [np.asarray(x, np.int64) for x in pages["ids"]]
        self.away = [np.asarray(x) for x in pages["away"]]
        self.rows = [np.asarray(x, np.int64).reshape(len(i), len(self.root)) for x, i in zip(pages["vectors"], self.ids)]

    def best(self, own: int, query: np.ndarray, top: int, least: int | None) -> list[tuple[int, int]]:
        """``(score, -id)`` of up to ``top`` rows that are not beaten by ``top`` others or by the score ``least``."""
        length = float(np.sqrt((query.astype(np.float64) ** 2).sum())) * (1 + _MARGIN)
        floor = -np.inf if least is None else least
        held: list[tuple[int, int]] = []
        # Stored distances first: these pages need no product with their routing object.
        near = np.flatnonzero(_upper(float(self.root @ query), length, self.to_root + self.radius) >= floor)
        scores = self.centres[near] @ query
        bounds = _upper(scores, length, self.radius[near])
        heap = [(-b, p, s) for b, p, s in zip(bounds, near, scores) if b >= floor]
        heapq.heapify(heap)
        while heap and -heap[0][0] >= floor:
            _, page, score = heapq.heappop(heap)
            at = np.flatnonzero((_upper(score, length, self.away[page]) >= floor) & (self.ids[page] != own))
            products = self.rows[page][at] @ query
            for k in np.flatnonzero(products >= floor):
                item = (int(products[k]), -int(self.ids[page][at[k]]))
                if len(held) < top:
                    heapq.heappush(held, item)
                else:
                    heapq.heappushpop(held, item)
            if len(held) == top:
                floor = max(floor, held[0][0])
        return held


def _visits(queries: DataFrame, directory, top: int, blocks: int) -> DataFrame:
    """A row per query and chunk it has to visit, with the score it has to reach."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        d = directory.value
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                objects, ids = d.objects[dim], d.ids[dim]
                radius = np.array([d.radius[dim, r] for r in range(len(ids))])
                out = []
                for own, vector in zip(part["id"], _matrix(list(part["vector"]))):
                    scores = objects @ vector
                    known = np.sort(scores[ids != own])[::-1]
                    least = int(known[top - 1]) if len(known) >= top else None
                    length = float(np.sqrt((vector.astype(np.float64) ** 2).sum())) * (1 + _MARGIN)
                    for r in np.flatnonzero(_upper(scores, length, radius) >= (-np.inf if least is None else least)):
                        out += [(own, vector, dim, r, c, own % blocks, least) for c in range(d.chunks[dim, r])]
                yield pd.DataFrame(out, columns=["id", "vector", "dim", "route", "chunk", "block", "least"]).astype(
                    {"least": "Int64"})

    return queries.mapInPandas(run, "id long, vector array<long>, dim int, route int, chunk int, block int, least long")


def top_scores(rows: DataFrame, is_query: Column, top: int = TOP, routes: int = ROUTES, chunk_rows: int = CHUNK,
               page: int = PAGE, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` best rows of ``vec_id, embedding`` for each query row."""
    spark = rows.sparkSession
    vectors = cut(integer_vectors(rows), "vectors")
    directory = _directory(vectors, routes)
    placed = cut(_routed(vectors, spark.sparkContext.broadcast(directory)), "vectors-routed")
    # One row per route and vector length.
    for r in placed.groupBy("dim", "route").agg(F.max("away").alias("radius"), F.count("*").alias("n")).collect():
        directory.radius[r["dim"], r["route"]] = r["radius"]
        directory.chunks[r["dim"], r["route"]] = -(-r["n"] // chunk_rows)
    for dim, ids in directory.ids.items():
        for r in range(len(ids)):  # a copy of another routing object may be nobody's nearest
            directory.radius.setdefault((dim, r), 0.0)
            directory.chunks.setdefault((dim, r), 0)
    sizes = spark.createDataFrame([(d, r, n) for (d, r), n in directory.chunks.items() if n], "c_dim int, c_route int, chunks int")
    dealt = placed.join(sizes, (F.col("dim") == F.col("c_dim")) & (F.col("route") == F.col("c_route"))).select(
        "id", "vector", "dim", "route", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"))
    pages = cut(dealt.groupBy("dim", "route", "chunk").applyInPandas(lambda pdf: _pages(pdf, page), _PAGE_ROW), "vectors-pages")

    queries = vectors.where(is_query)
    blocks = max(1, -(-queries.count() // block))
    visits = _visits(queries, spark.sparkContext.broadcast(directory), top, blocks)
    copies = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            chunk = Chunk(left)
            for own, vector, least in zip(right["id"], right["vector"], right["least"]):
                held = chunk.best(own, np.asarray(vector, np.int64), top, None if pd.isna(least) else int(least))
                out += [(own, -i, s) for s, i in held]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    key = ["dim", "route", "chunk", "block"]
    found = copies.groupBy(*key).cogroup(visits.groupBy(*key)).applyInPandas(
        search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score")


def op13_metric_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 50 == 0)


SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {TOP}"""
