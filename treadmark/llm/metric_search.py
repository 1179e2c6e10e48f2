"""Exact top-k search by inner product in an M-tree.

Inner products become distances: a vector v gets one more component, sqrt(M - |v|^2) with M the largest squared length, and
a query gets 0 there; then |q - v|^2 = |q|^2 + M - 2 q.v, and the nearest are those with the highest products.

The tree is a table.  Its leaves are pages of at most PAGE vectors, each stored with its distance from the page's centre;
pages of a subtree are stored with their covering radii and their distances from the subtree's centre; and the subtrees'
centres stand in directory pages.  A query searches its own subtree first, then those that its bound cannot exclude,
best bound first; stored distances exclude entries by the triangle inequality before any product is computed.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from treadmark.llm.common import ship, table
from treadmark.session import durable

SCALE = 64
#: Centres of the first split: so many vectors, those with the smallest hashes of their ids.
CENTRES = 64
#: Vectors of a subtree, on average at most; a larger cell, such as that of a vector with many copies, becomes several.
SUBTREE = 4096
PAGE = 128
#: Queries and subtree centres that meet in one block.
BLOCK = 1024


def _whole(batch: pd.DataFrame) -> np.ndarray:
    return np.stack(batch["v"].to_numpy()).astype(np.float64) if len(batch) else np.empty((0, 0))


def _lifted(vectors: np.ndarray, limit: float) -> np.ndarray:
    """The vectors with the component that makes them all equally long."""
    last = np.sqrt(np.maximum(limit - (vectors * vectors).sum(axis=1), 0.0))
    return np.column_stack((vectors, last))


def _between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of a from the rows of b."""
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def _slack(x: np.ndarray) -> np.ndarray:
    """A bound a little wider than rounding can make it."""
    return x * (1 + 1e-7) + 1e-4


def build(ids: np.ndarray, vectors: np.ndarray, limit: float) -> dict:
    """One subtree: its centre and radius, and its pages with centres, radii, parent distances and entries."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    points = _lifted(vectors, limit)
    centre = points[0]
    reach = _between(points, centre[None, :])[:, 0]
    by_reach = np.argsort(reach, kind="stable")
    seeds = by_reach[np.linspace(0, len(ids) - 1, max(1, -(-2 * len(ids) // PAGE))).astype(int)]
    near = _between(points, points[seeds]).argmin(axis=1)
    pages = []
    for k in np.unique(near):
        own = np.flatnonzero(near == k)
        from_seed = _between(points[own], points[seeds[k]][None, :])[:, 0]
        own = own[np.argsort(from_seed, kind="stable")]
        for at in range(0, len(own), PAGE):
            rows = own[at : at + PAGE]
            mid = points[rows[0]]
            away = _between(points[rows], mid[None, :])[:, 0]
            pages.append((mid, away.max(), float(np.linalg.norm(mid - centre)), ids[rows], vectors[rows], away))
    return {
        "centre": centre, "radius": float(reach.max()), "mids": np.stack([p[0] for p in pages]), "radii": np.array([p[1] for p in pages]),
        "parent": np.array([p[2] for p in pages]), "ids": [p[3] for p in pages], "vectors": [p[4] for p in pages], "away": [p[5] for p in pages],
    }


def search(tree: dict, q_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, limit: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query row, vector id and score of each query's best k in the subtree that score at least its floor."""
    n, length = len(q_ids), (queries * queries).sum(axis=1)
    points = np.column_stack((queries, np.zeros(n)))
    best_ids, best = [np.empty(0, np.int64)] * n, [np.empty(0)] * n
    floor = floor.astype(float).copy()
    radius = lambda rows: _slack(np.sqrt(np.maximum(length[rows] + limit - 2 * floor[rows], 0.0)))
    every = np.arange(n)
    to_centre = _between(points, tree["centre"][None, :])[:, 0]
    # Stored distances alone give a first bound of every page; the product with a page's centre comes only where it holds.
    could = np.abs(to_centre[:, None] - tree["parent"][None, :]) - tree["radii"][None, :] <= radius(every)[:, None]
    to_mid = np.full(could.shape, np.inf)
    for p in np.flatnonzero(could.any(axis=0)):
        rows = np.flatnonzero(could[:, p])
        to_mid[rows, p] = _between(points[rows], tree["mids"][p][None, :])[:, 0]
    bound = np.where(np.isfinite(to_mid), to_mid - tree["radii"][None, :], np.inf)
    order = np.argsort(bound, axis=1, kind="stable")
    for turn in range(order.shape[1]):
        page = order[:, turn]
        live = np.flatnonzero(bound[every, page] <= radius(every))
        if not len(live):
            break
        for p in np.unique(page[live]):
            rows = live[page[live] == p]
            gap = np.abs(to_mid[rows, p][:, None] - tree["away"][p][None, :])
            need = np.flatnonzero((gap <= radius(rows)[:, None]).any(axis=0))
            if not len(need):
                continue
            ids = tree["ids"][p][need]
            score = queries[rows] @ tree["vectors"][p][need].T
            ok = (score >= floor[rows][:, None]) & (ids[None, :] != q_ids[rows][:, None])
            for i, r in zip(np.flatnonzero(ok.any(axis=1)), rows[ok.any(axis=1)], strict=True):
                all_ids = np.concatenate((best_ids[r], ids[ok[i]]))
                all_scores = np.concatenate((best[r], score[i][ok[i]]))
                top = np.lexsort((all_ids, -all_scores))[:k]
                best_ids[r], best[r] = all_ids[top], all_scores[top]
                if len(top) == k:
                    floor[r] = max(floor[r], best[r][-1])
    sizes = [len(b) for b in best]
    return np.repeat(every, sizes), np.concatenate(best_ids) if n else np.empty(0, np.int64), np.concatenate(best) if n else np.empty(0)


def prepared(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v: floor(scale * x) of each component, of the vectors that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(fine)
    one = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return one.select("vec_id", F.transform("embedding", lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("v"))


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score: the k highest integer products of each query with the other vectors.

    Queries are the rows whose vec_id is divisible by ``every``.  Ties go to the smaller vec_id.  Vectors that are null
    or hold a null or non-finite component, and rows without vec_id, take no part; of rows that repeat a vec_id the
    one with the smallest vector does.  Shorter vectors count as followed by zeros.  With fewer than k others,
    all are returned; an empty table gives no rows.  Products are exact below 2^53.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = durable(prepared(vectors, scale), "vectors")
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    stats = rows.agg(F.max(F.size("v")), F.max(length), F.count("*")).first()
    out = "query_id long, rank int, vec_id long, score long"
    if not stats[2]:
        return spark.createDataFrame([], out)
    width, limit, total = int(stats[0]), float(stats[1]), int(stats[2])
    padded = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")))
    rows = rows.select("vec_id", padded.alias("v"))
    first = rows.orderBy(F.xxhash64("vec_id")).limit(CENTRES).collect()  # a fixed number of vectors
    centres = _lifted(np.array([r["v"] for r in first]), limit)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                batch["cell"] = _between(_lifted(_whole(batch), limit), centres).argmin(axis=1)
                yield batch

    placed = durable(rows.mapInPandas(near, "vec_id long, v array<double>, cell int"), "cells")
    counts = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # at most CENTRES
    parts = F.create_map(*[F.lit(int(x)) for c in counts for x in (c, -(-counts[c] // SUBTREE))])
    salt = F.pmod(F.xxhash64("vec_id"), F.element_at(parts, F.col("cell")))
    placed = placed.select("vec_id", "v", (F.col("cell") * F.lit(1 << 32) + salt).alias("tree"))

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree = build(group["vec_id"].to_numpy(np.int64), _whole(group), limit)
        return pd.DataFrame({"tree": [key[0]], "centre": [tree["centre"]], "radius": [tree["radius"]], "pages": [pickle.dumps(tree)]})

    trees = durable(placed.groupBy("tree").applyInPandas(grow, "tree long, centre array<double>, radius double, pages binary"), "trees")
    queries = placed.filter(F.col("vec_id") % every == 0)
    found_in = "query_id long, vec_id long, score double"

    def visit(key: tuple, asked: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(tree):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        own, ids, parts_ = pickle.loads(tree["pages"].iloc[0]), asked["vec_id"].to_numpy(np.int64), []
        vectors_, low = _whole(asked), asked["low"].to_numpy(float)
        for at in range(0, len(ids), BLOCK):
            q = ids[at : at + BLOCK]
            row, vec, score = search(own, q, vectors_[at : at + BLOCK], low[at : at + BLOCK], limit, k)
            parts_.append(pd.DataFrame({"query_id": q[row], "vec_id": vec, "score": score}))
        return pd.concat(parts_)

    # A block of queries meets one subtree in one task; the block number spreads the queries of a large cell.
    blocks = max(1, -(-total // every // BLOCK))
    block = F.pmod(F.xxhash64(F.col("vec_id"), F.lit(7)), F.lit(blocks))

    def searched(asked: DataFrame) -> DataFrame:
        """Results of (tree, block, vec_id, v, low) in their trees; each tree goes to the blocks that ask for it."""
        wanted = asked.select(F.col("tree").alias("t"), F.col("block").alias("b")).distinct()
        wanted = wanted.join(trees.select("tree", "pages"), F.col("t") == F.col("tree")).drop("tree")
        return asked.groupBy("tree", "block").cogroup(wanted.groupBy("t", "b")).applyInPandas(visit, found_in)

    lowest = -4.0 * limit - 1.0
    home = queries.select("tree", block.alias("block"), "vec_id", "v", F.lit(lowest).alias("low"))
    first_found = durable(searched(home), "home")
    kth = first_found.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n")).filter(F.col("n") >= k)
    asked = queries.join(kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").select(
        "vec_id", "v", F.col("tree").alias("own"), block.alias("block"), F.coalesce("low", F.lit(lowest)).alias("low")
    )
    asked = durable(asked, "asked")
    pages = max(1, -(-(total // SUBTREE + CENTRES) // BLOCK))
    directory = trees.select("tree", "centre", "radius", F.pmod(F.xxhash64("tree"), F.lit(pages)).alias("page"))
    spread = asked.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1)).cast("array<long>")))

    def open_trees(key: tuple, own: pd.DataFrame, page: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(page):
            return pd.DataFrame({"tree": [], "block": [], "vec_id": [], "v": [], "low": []})
        q = _whole(own)
        low, length_ = own["low"].to_numpy(float), (q * q).sum(axis=1)
        reach = _slack(np.sqrt(np.maximum(length_ + limit - 2 * low, 0.0)))
        points = np.column_stack((q, np.zeros(len(q))))
        bound = _between(points, np.stack(page["centre"].to_numpy())) - page["radius"].to_numpy()[None, :]
        r, t = np.nonzero((bound <= reach[:, None]) & (own["own"].to_numpy()[:, None] != page["tree"].to_numpy()[None, :]))
        picked = own.iloc[r]
        return pd.DataFrame({"tree": page["tree"].to_numpy()[t], "block": picked["block"].to_numpy(), "vec_id": picked["vec_id"].to_numpy(), "v": picked["v"].to_numpy(), "low": low[r]})

    wanted = asked.select(F.col("block").alias("b")).distinct()
    wanted = wanted.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(pages - 1)).cast("array<long>")))
    wanted = wanted.join(directory, F.col("p") == F.col("page")).drop("page")
    more = spread.groupBy("block", "page").cogroup(wanted.groupBy("b", "p")).applyInPandas(
        open_trees, "tree long, block long, vec_id long, v array<double>, low double"
    )
    found = first_found.unionByName(searched(durable(more, "open")))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score"))


def op8_metric_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
