"""Exact top-k search by columnar branch and bound.

Components become whole numbers, so that scores are exact. A tile holds its rows dimension after dimension. Inner
products grow by one block of dimensions at a time, for a block of queries and all rows of a tile. What the dimensions
still to come can add or take is at most the product of the lengths that query and row have left there (their
remaining mass). A row whose product plus that bound falls short of what ``k`` rows are sure to reach, here or
in tiles that the task met before, is dropped; the survivors are compacted, first whole columns, then single pairs.

Where products could pass 2**53, doubles only tell which rows may be among the best, with a bound on what they lose;
the products of these are then whole numbers of any size.

Vectors that are null, empty or hold null or non-finite components (also once scaled), and rows with a null id, take no
part. A query meets vectors of its own length only. Rows that share a query's id are not its candidates; other repeated
rows are candidates as often as they occur. A query id with several vectors gets a ranking for each. Ranks follow the
exact product; a score beyond the range of a long is given as the end of that range. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import table
from tideline.llm.vectors import best, usable

SCALE = 256
BLOCK = 16
# Below this share of surviving pairs, they are followed one by one.
_SPARSE = 0.05


def products(k: int, block: int = BLOCK):
    """Compares a block of queries with a tile; see ``best``."""
    def compare(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, ids: np.ndarray, limit: np.ndarray) -> tuple:
        dims, n = c.shape
        if np.log2(np.abs(q).max(initial=1)) + np.log2(np.abs(c).max(initial=1)) + np.log2(max(dims, 1)) >= 52.9:
            return _large(q, q_ids, c, ids, k)
        cuts = list(range(0, dims, block)) + [dims]
        # Lengths left after each block.
        q_left = [np.sqrt((q[cut:] ** 2).sum(axis=0)) for cut in cuts[1:]]
        c_left = [np.sqrt((c[cut:] ** 2).sum(axis=0)) for cut in cuts[1:]]
        places, alive = np.arange(n), q_ids[:, None] != ids[None, :]
        score = np.zeros((q.shape[1], n))
        pairs = None
        for i, (start, end) in enumerate(zip(cuts, cuts[1:])):
            if pairs is None:
                score += q[start:end].T @ c[start:end]
                bound = np.outer(q_left[i], c_left[i][places])
                sure = np.where(alive, score - bound, -np.inf)
                if sure.shape[1] >= k:
                    limit = np.maximum(limit, np.partition(sure, -k, axis=1)[:, -k])
                # Half a unit more than rounding can take.
                alive &= score + bound >= limit[:, None] - 0.5
                columns = alive.any(axis=0)
                if columns.sum() < 0.8 * len(columns):
                    places, c = places[columns], np.ascontiguousarray(c[:, columns])
                    score, alive = score[:, columns], alive[:, columns]
                if alive.sum() <= _SPARSE * q.shape[1] * n:
                    at, to = np.nonzero(alive)
                    pairs = (at, to, score[at, to])
            else:
                at, to, total = pairs
                total = total + (q[start:end, at] * c[start:end, to]).sum(axis=0)
                keep = total + q_left[i][at] * c_left[i][places[to]] >= limit[at] - 0.5
                pairs = (at[keep], to[keep], total[keep])
        if pairs is None:
            at, to = np.nonzero(alive)
            pairs = (at, to, score[at, to])
        at, to, total = pairs
        return at, places[to], np.rint(total)

    return compare


def _large(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """The ``k`` best of each query, with products of any size, and the parts of scores beyond a long."""
    dims, n = c.shape
    # Each vector by a power of two of its own, which loses nothing; the exponents are added again at the end.
    q_up, c_up = (np.frexp(np.abs(x).max(axis=0))[1] for x in (q, c))
    q_small, c_small = np.ldexp(q, -q_up), np.ldexp(c, -c_up)
    near = q_small.T @ c_small
    error = dims * 2.0**-50 * np.outer(np.linalg.norm(q_small, axis=0), np.linalg.norm(c_small, axis=0))
    up = q_up[:, None] + c_up[None, :]
    low, high = (np.ldexp(x.astype(np.longdouble), up) for x in (near - error, near + error))
    others = q_ids[:, None] != ids[None, :]
    low[~others] = -np.inf
    cut = np.partition(low, -k, axis=1)[:, -k] if n >= k else np.full(len(low), -np.inf)
    at, to = np.nonzero(others & (high >= cut[:, None]))
    # Equal vectors are multiplied once.
    columns, kind = np.unique(c[:, to], axis=1, return_inverse=True)
    kind = kind.ravel()
    whole = [[int(x) for x in v] for v in columns.T]
    found, first = [], np.searchsorted(at, np.arange(q.shape[1] + 1))
    for i in range(q.shape[1]):
        chosen = range(first[i], first[i + 1])
        own = [int(x) for x in q[:, i]]
        products = {j: sum(x * y for x, y in zip(own, whole[j])) for j in {int(kind[m]) for m in chosen}}
        ranked = sorted((-products[int(kind[m])], int(ids[to[m]]), int(to[m])) for m in chosen)
        found += [(i, place, -score) for score, _, place in ranked[:k]]
    scores = [min(max(v, -2**63), 2**63 - 1) for _, _, v in found]
    return (np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.int64),
            np.array(scores, np.int64), [_beyond(v) for _, _, v in found])


def _beyond(value: int) -> bytes | None:
    """None for a long; else bytes that order numbers beyond its range on one side of zero."""
    if -2**63 < value < 2**63:
        return None
    size = (abs(value).bit_length() + 7) // 8
    key = size.to_bytes(2) + abs(value).to_bytes(size)
    return key if value > 0 else bytes(255 - b for b in key)


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """The ``k`` highest whole-number inner products of every row that ``queries`` selects, against all other rows.

    Columns: query_id, mark (a hash of the query's vector), rank, vec_id, score.
    """
    def scaled(x: Column) -> Column:
        # Larger numbers are whole already, and may be beyond a long.
        x = x.cast("double") * scale
        return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)

    rows = (vectors.where(usable(id_col, F.col(vector_col))).withColumn("__query", F.coalesce(queries, F.lit(False)))
            .select(F.size(vector_col).cast("long").alias("part"), F.col(id_col).cast("long").alias("id"),
                    F.xxhash64(vector_col).alias("mark"), F.transform(vector_col, scaled).alias("v"), "__query")
            .where(usable("id", F.col("v"))))
    asked = rows.where("__query").drop("__query").distinct()
    return best(asked, rows.drop("__query"), k, False, products(k), "long")


def op6_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 highest inner products for every 50th id, against all rows."""
    found = top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH v AS (
    SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
    WHERE q.vec_id % 50 = 0),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
