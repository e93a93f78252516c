"""Blocks of vectors, and which blocks of queries meet which blocks of rows.

Rows are put into tiles inside the tasks that read them: ``ids`` and the components in vertical layout, dimension
after dimension. Nothing is grouped by key, so no key can make a large tile. Queries are put into smaller blocks
in the same way. Tiles of one part are dealt into groups of some ``GROUP_ROWS`` rows, and every block of queries
goes once to each group of the parts it asks for, where it meets the tiles by an equi-join.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE_ROWS = 8192
QUERY_ROWS = 512
GROUP_ROWS = 131_072
_TILE = "part long, tile long, ids array<long>, marks array<long>, data binary"


def usable(id_col: str, vector: Column) -> Column:
    """The id is known; the vector is neither null nor empty and has no null or non-finite component."""
    def finite(x: Column) -> Column:
        x = x.cast("double")
        return F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False))

    return F.col(id_col).isNotNull() & F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def tiles(rows: DataFrame, size: int) -> DataFrame:
    """Tiles of rows (part, id, mark, v); ``mark`` tells rows with one id apart. Parts differ in length of v."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, made, waiting = TaskContext.get().partitionId(), 0, defaultdict(list)

        def flush(part: int) -> pa.RecordBatch:
            nonlocal made
            made += 1
            held = waiting.pop(part)
            data = np.array([v for _, _, v in held], np.float64).T
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([(partition << 28) + made]), pa.array([[i for i, _, _ in held]]),
                 pa.array([[m for _, m, _ in held]]), pa.array([np.ascontiguousarray(data).tobytes()], pa.binary())],
                names=["part", "tile", "ids", "marks", "data"])

        for batch in batches:
            parts, ids, marks = (batch.column(i).to_pylist() for i in range(3))
            for part, i, mark, v in zip(parts, ids, marks, batch.column(3)):
                waiting[part].append((i, mark, v.values.to_numpy(zero_copy_only=False)))
                if len(waiting[part]) == size:
                    yield flush(part)
        for part in list(waiting):
            yield flush(part)

    return rows.select("part", "id", "mark", "v").mapInArrow(packed, _TILE)


def best(queries: DataFrame, rows: DataFrame, k: int, ascending: bool,
         compare: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple], result: str) -> DataFrame:
    """The ``k`` best rows of every query: query_id, mark, rank, vec_id, score.

    Both sides have part, id, mark and v; a query meets the rows of its parts. ``compare`` gets components
    (dimensions x rows) and ids of a block of queries and of a tile, and the score each query must reach; it
    returns positions of queries and of rows with their scores, and holds the k best of each query at least. If it also
    returns ``beyond``, bytes or None for each, equal scores are ordered by it, None last, and there are no more than k.
    """
    held = tiles(rows, TILE_ROWS)
    groups = (rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("groups")))
    dealt = (held.join(groups, "part").withColumn("g", F.pmod(F.xxhash64("tile"), F.col("groups")).cast("int"))
             .select("part", "g", "ids", "data"))
    asked = (tiles(queries, QUERY_ROWS).join(groups, "part")
             .select("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"),
                     F.col("tile").alias("block"), F.col("ids").alias("q_ids"), "marks",
                     F.col("data").alias("q_data")))
    met = asked.join(dealt, ["part", "g"]).select("block", "q_ids", "marks", "q_data", "ids", "data")
    worst = np.inf if ascending else -np.inf

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What each query has reached in this task; rows that fall short of it can't be among its best.
        reached: dict[int, np.ndarray] = {}
        for batch in batches:
            for n in range(batch.num_rows):
                block = batch.column(0)[n].as_py()
                q_ids, marks, ids = (batch.column(i)[n].values.to_numpy() for i in (1, 2, 4))
                q_data = np.frombuffer(batch.column(3)[n].as_buffer(), np.float64).reshape(-1, len(q_ids))
                data = np.frombuffer(batch.column(5)[n].as_buffer(), np.float64).reshape(-1, len(ids))
                limit = reached.setdefault(block, np.full(len(q_ids), worst))
                at, to, score, *beyond = compare(q_data, q_ids, data, ids, limit)
                beyond = np.array(beyond[0] if beyond else [None] * len(at), object)
                order = np.lexsort((ids[to], score if ascending else -score, at))
                at, to, score, beyond = at[order], to[order], score[order], beyond[order]
                place = np.arange(len(at)) - np.searchsorted(at, at)
                last = place == k - 1
                if last.any():
                    better = np.minimum if ascending else np.maximum
                    limit[at[last]] = better(limit[at[last]], score[last])
                keep = place < k
                at, to, score, beyond = at[keep], to[keep], score[keep], beyond[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[at]), pa.array(marks[at]), pa.array(ids[to]),
                     pa.array(score if result == "double" else score.astype(np.int64)), pa.array(beyond, pa.binary())],
                    names=["query_id", "mark", "vec_id", "score", "beyond"])

    found = met.mapInArrow(matched, f"query_id long, mark long, vec_id long, score {result}, beyond binary")
    order = [F.col("score").asc() if ascending else F.col("score").desc(), F.col("beyond").desc_nulls_last(),
             F.col("vec_id")]
    rank = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(*order))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "mark", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
