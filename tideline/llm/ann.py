"""Approximate nearest neighbours by learned partitions.

1. On a bounded sample (``SAMPLE`` rows, a parameter) the driver builds the graph of nearest neighbours and cuts it into
   parts of equal size that few edges cross: halving again and again along the direction that neighbours agree on most,
   then swapping pairs of nodes while that saves edges.
2. A small network learns to tell a vector's part. It assigns every row of the table to its most probable part,
   and routes a query to its several most probable ones. How many, is measured on sample rows that the network
   did not learn from: the fewest with which the target share of their true neighbours is met.
3. The rows of those parts are ranked by their exact distance. Parts may be of any size: their tiles are dealt into groups
   (see ``vectors``), so a part that holds most rows is many tasks.

Every row is indexed. Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null
id, take no part. Vectors of another length than most of the sample form a part of their own per length,
which queries of that length ask for. Rows that share a query's id are not its candidates; other repeated rows
are candidates as often as they occur. A query whose parts hold fewer than ``k`` candidates asks all parts.
Empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import drawn, table
from tideline.llm.vectors import best, usable

SAMPLE = 8192
PARTS = 32
NEIGHBOURS = 10
HIDDEN = 128
TARGET = 0.95


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest other rows of every row, in blocks."""
    out, squares = np.empty((len(x), k), np.int64), (x * x).sum(axis=1)
    for i in range(0, len(x), 1024):
        far = squares - 2 * x[i:i + 1024] @ x.T
        far[np.arange(len(far)), np.arange(i, i + len(far))] = np.inf
        out[i:i + 1024] = np.argpartition(far, k, axis=1)[:, :k]
    return out


def _halve(x: np.ndarray, edges: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """True for one half; few of the (node, node) edges cross."""
    n = len(x)
    # Neighbours' mean positions against positions: the main direction in which a neighbourhood agrees.
    u, v = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    degree = np.maximum(np.bincount(u, minlength=n), 1)
    value = x @ rng.normal(size=x.shape[1])
    for _ in range(60):
        value = value - value.mean()
        value = 0.5 * value + 0.5 * np.bincount(u, weights=value[v], minlength=n) / degree
        value /= np.linalg.norm(value) + 1e-12
    side = np.zeros(n, bool)
    side[np.argsort(value, kind="stable")[n // 2:]] = True
    for _ in range(30):
        # What moving a node would save: edges to the other half less those to its own.
        other = np.bincount(u, weights=side[u] != side[v], minlength=n)
        gain = 2 * other - np.bincount(u, minlength=n)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right))
        swaps = int(((gain[left[:m]] + gain[right[:m]]) > 0).sum()) // 2
        if not swaps:
            break
        before = int((side[edges[:, 0]] != side[edges[:, 1]]).sum())
        side[left[:swaps]], side[right[:swaps]] = True, False
        if int((side[edges[:, 0]] != side[edges[:, 1]]).sum()) >= before:
            side[left[:swaps]], side[right[:swaps]] = False, True
            break
    return side


def partition(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 1) -> np.ndarray:
    """A part for every node, of equal sizes up to one node; ``parts`` is a power of two."""
    rng, out = np.random.default_rng(seed), np.zeros(len(x), np.int64)
    edges = np.stack([np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()], axis=1)
    size = 1
    while size < parts:
        for part in range(size):
            nodes = np.flatnonzero(out == part)
            place = np.full(len(x), -1)
            place[nodes] = np.arange(len(nodes))
            inner = place[edges]
            inner = inner[(inner >= 0).all(axis=1)]
            out[nodes[_halve(x[nodes], inner, rng)]] += size
        size *= 2
    return out


@dataclass
class Router:
    """A network with one hidden layer that gives a vector's log probability for every part."""

    weights: list[np.ndarray]
    probes: int
    dims: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.maximum(x @ a + b, 0) @ c + d


def _learn(x: np.ndarray, parts: np.ndarray, count: int, seed: int = 2, epochs: int = 30) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    w = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, HIDDEN ** -0.5, (HIDDEN, count)), np.zeros(count)]
    first, second, step = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w], 0
    total = epochs * -(-len(x) // 256)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            chosen = order[at:at + 256]
            inputs = x[chosen]
            hidden = np.maximum(inputs @ w[0] + w[1], 0)
            score = hidden @ w[2] + w[3]
            score = np.exp(score - score.max(axis=1, keepdims=True))
            error = score / score.sum(axis=1, keepdims=True)
            error[np.arange(len(chosen)), parts[chosen]] -= 1
            error /= len(chosen)
            back = (error @ w[2].T) * (hidden > 0)
            step += 1
            for i, g in enumerate((inputs.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.99 * second[i] + 0.01 * g * g
                w[i] -= (0.005 * (1 - 0.9 * step / total) * (first[i] / (1 - 0.9 ** step))
                         / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8))
    return w


def fit(x: np.ndarray, parts: int = PARTS, target: float = TARGET, k: int = NEIGHBOURS) -> Router:
    """Learn parts and routes from sample vectors (rows x dimensions)."""
    while parts > 1 and len(x) < 4 * parts * k:
        parts //= 2
    if parts == 1:
        return Router([np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1, x.shape[1])
    graph = neighbour_graph(x, k)
    named = partition(x, graph, parts)
    # Every fourth row is kept apart to measure how many parts a query must ask.
    kept = np.arange(len(x)) % 4 == 0
    router = Router(_learn(x[~kept], named[~kept], parts), parts, x.shape[1])
    scores = router.scores(x)
    rows, asked = scores.argmax(axis=1), np.argsort(-scores[kept], axis=1)
    # Place, in each kept row's order of parts, of the part that holds each of its neighbours.
    place = np.argsort(asked, axis=1)[np.arange(len(asked))[:, None], rows[graph[kept]]]
    met = np.cumsum(np.bincount(place.ravel(), minlength=parts)) / place.size
    router.probes = int(np.searchsorted(met, target)) + 1
    return router


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE,
          parts: int = PARTS, target: float = TARGET) -> Router | None:
    """Fit to at most ``sample`` rows, drawn by a hash of id and vector; None for a table without usable vectors."""
    found = (vectors.where(usable(id_col, F.col(vector_col)))
             .select(F.col(vector_col).cast("array<double>").alias("v"), F.xxhash64(id_col, vector_col).alias("h")))
    # In one order, whatever the partitions.
    rows = sorted(drawn(found, sample, "h").collect(), key=lambda r: (r.h, r.v))
    sizes = Counter(len(r.v) for r in rows)
    if not sizes:
        return None
    dims = max(sizes, key=lambda n: (sizes[n], n))
    return fit(np.array([r.v for r in rows if len(r.v) == dims]), parts, target)


def _routed(df: DataFrame, router: Router, several: bool) -> DataFrame:
    """Rows (id, mark, v) with a ``part`` each, or one row per part that a query asks for."""
    schema = "id long, mark long, v array<double>, part long"

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            sizes = vectors.value_lengths().to_numpy()
            starts = np.cumsum(sizes) - sizes
            flat = vectors.flatten().to_numpy()
            known = np.flatnonzero(sizes == router.dims)
            count = min(router.probes, router.weights[-1].size) if several else 1
            # Other lengths: a part of their own, numbered below zero.
            rows, parts = [np.flatnonzero(sizes != router.dims)], [-sizes[sizes != router.dims].astype(np.int64)]
            if len(known):
                scores = router.scores(flat[starts[known][:, None] + np.arange(router.dims)])
                rows.append(np.repeat(known, count))
                parts.append(np.argsort(-scores, axis=1, kind="stable")[:, :count].ravel())
            taken = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), vectors.take(taken),
                 pa.array(np.concatenate(parts).astype(np.int64))], names=["id", "mark", "v", "part"])

    return df.select("id", "mark", "v").mapInArrow(routed, schema)


def distances(k: int) -> Callable[..., tuple]:
    """Compares a block of queries with a tile by exact distance; see ``vectors.best``."""
    def compare(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, ids: np.ndarray, limit: np.ndarray) -> tuple:
        q_squares, c_squares = (q * q).sum(axis=0), (c * c).sum(axis=0)
        size = q_squares[:, None] + c_squares[None, :]
        near = size - 2 * (q.T @ c)
        near[q_ids[:, None] == ids[None, :]] = np.inf
        # The product form loses digits; what may be among the nearest is measured again below.
        slack = 1e-9 * size.max(initial=0)
        cut = np.partition(near, k - 1, axis=1)[:, k - 1] if near.shape[1] > k else np.full(len(near), np.inf)
        cut = np.minimum(cut, limit * limit) + slack
        at, to = np.nonzero((near <= cut[:, None]) & (near < np.inf))
        score = np.empty(len(at))
        for i in range(0, len(at), 65_536):
            part = slice(i, i + 65_536)
            score[part] = np.sqrt(((q[:, at[part]] - c[:, to[part]]) ** 2).sum(axis=0))
        return at, to, score

    return compare


def search(vectors: DataFrame, queries: Column, router: Router | None, k: int = 10, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of every row that ``queries`` selects: query_id, mark, rank, vec_id, score."""
    if router is None:
        return vectors.sparkSession.createDataFrame(
            [], "query_id long, mark long, rank int, vec_id long, score double")
    exact = F.col(vector_col).cast("array<double>")
    rows = (vectors.where(usable(id_col, F.col(vector_col)) & F.exists(vector_col, lambda x: x != 0))
            .withColumn("__query", F.coalesce(queries, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), F.xxhash64(vector_col).alias("mark"), exact.alias("v"),
                    "__query"))
    asked = rows.where("__query").drop("__query").distinct()
    indexed = _routed(rows, router, several=False)
    found = best(_routed(asked, router, several=True), indexed, k, True, distances(k), "double")
    if router.probes == router.weights[-1].size:
        return found
    # Queries that met fewer than k rows ask again, now all parts.
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"), "mark")
    short = asked.join(full, ["id", "mark"], "left_anti")
    everywhere = Router(router.weights, router.weights[-1].size, router.dims)
    again = best(_routed(short, everywhere, several=True), indexed, k, True, distances(k), "double")
    return found.join(full.withColumnRenamed("id", "query_id"), ["query_id", "mark"], "left_semi").unionByName(again)


def op7_ann(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest found for every 100th id, against all rows."""
    vectors = table(spark, folder, "embeddings")
    found = search(vectors, F.col("vec_id") % 100 == 0, train(vectors), k=10)
    return found.select("query_id", "rank", "vec_id", "score")
