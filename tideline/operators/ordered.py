"""Ordered computations that no single key or value can overload.

A window over a key puts all rows of that key in one task. Here, a key that holds more rows than
an average shuffle partition is cut into slices along its order (``slice_hot_keys``), rows are
compared inside (key, slice), and what a slice needs from its neighbours comes from a table of
one row per slice (``join_edges``).
There are fewer hot keys than shuffle partitions, and at most two slices per partition on
average, so that table is bounded by a cluster setting and not by the data.

The same idea gives running totals over a global order (``running_totals``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import ensure_checkpoint_dir

SLICE = "__slice"
# Slicing pays only above this many rows in one key.
MIN_HOT_ROWS = 1_000_000
# approx_top_k accepts at most this many tracked items: enough below 50,000 shuffle partitions. A hot
# key that is not found costs time only.
_MAX_TRACKED = 1_000_000


def slice_hot_keys(df: DataFrame, keys: Sequence[str], order: Column,
                   min_hot_rows: int = MIN_HOT_ROWS,
                   population: DataFrame | None = None) -> tuple[DataFrame, bool]:
    """Add ``__slice``: 0 for ordinary keys, 1..n along ``order`` for hot ones.

    A slice number never decreases as ``order`` grows, and equal ``order`` values share one, so
    it is safe to compare rows slice by slice. Which keys are found hot affects only the spread
    of work, never a result. ``order`` may have any type that can be sorted: the rows of hot keys
    are range-partitioned by key and order, and the first order of each partition is a cut point.

    Keys and cut points are taken from ``population``, by default ``df`` itself. Pass rows that
    contain those of ``df`` and are cheaper to read, such as the tables ``df`` was joined from.
    """
    spark = df.sparkSession
    population = df if population is None else population
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key_hash = F.xxhash64(*[F.col(k) for k in keys])
    tracked = min(_MAX_TRACKED, max(1000, 20 * partitions))
    found = (population.select(key_hash.alias("h"))
             .agg(F.count(F.lit(1)).alias("rows"),
                  F.expr(f"approx_top_k(h, {partitions}, {tracked})").alias("top"))
             .first())
    share = max(min_hot_rows, math.ceil(found["rows"] / partitions))
    wanted = [item[0] for item in found["top"] or [] if item[1] > share]
    if not wanted:
        return df.withColumn(SLICE, F.lit(0)), False

    # Fewer hot keys than shuffle partitions, so at most three cut points per partition in all.
    hot = spark.createDataFrame([(h,) for h in wanted], "__hot long")
    bounds = (population.select(key_hash.alias("__hot"), order.alias("__o"))
              .join(F.broadcast(hot), "__hot", "left_semi")
              .repartitionByRange(2 * partitions, "__hot", "__o")
              .groupBy("__hot", F.spark_partition_id().alias("__p")).agg(F.min("__o").alias("__o"))
              .groupBy("__hot").agg(F.array_distinct(F.sort_array(F.collect_list("__o"))).alias("__all"))
              .select("__hot", F.expr("slice(__all, 2, size(__all))").alias("__bounds"))
              .withColumn("__block", (F.sqrt(F.size("__bounds")) + 1).cast("int"))
              .withColumn("__coarse",
                          F.filter("__bounds", lambda b, i: (i + 1) % F.col("__block") == 0)))
    # One row per hot key; checkpointed so that every use, and every retry, sees the same cuts.
    ensure_checkpoint_dir(spark)
    bounds = bounds.checkpoint()
    # Search whole blocks first, then inside one block.
    before = F.size(F.filter("__coarse", lambda b: b < F.col("__o"))) * F.col("__block")
    within = F.slice("__bounds", F.col("__before") + 1, F.col("__block"))
    sliced = (df.withColumn("__hot", key_hash).withColumn("__o", order)
              .join(F.broadcast(bounds), "__hot", "left")
              .withColumn("__before", before)
              .withColumn(SLICE, F.when(F.col("__bounds").isNull(), 0).otherwise(
                  1 + F.col("__before") + F.size(F.filter(within, lambda b: b < F.col("__o")))))
              .drop("__hot", "__o", "__block", "__bounds", "__coarse", "__before"))
    return sliced, True


def join_edges(df: DataFrame, edges: DataFrame, keys: Sequence[str],
               values: Sequence[str]) -> DataFrame:
    """Add ``values`` of the edge row of each (key, slice) to its rows, NULL where there is none.

    The edge table has one row per slice of a hot key and is broadcast, so ``df`` keeps its
    partitioning and order for the windows that follow.
    """
    renamed = edges.select(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
                           F.col(SLICE).alias("__edge_slice"), *values)
    same = F.col(SLICE) == F.col("__edge_slice")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{i}"))
    return df.join(F.broadcast(renamed), same, "left").select(*df.columns, *values)


def running_totals(df: DataFrame, order: str, values: Sequence[str], descending: bool = False,
                   slices: int | None = None, slice_rows: int = 1_000_000) -> DataFrame:
    """Add ``cum_<value>`` for each value, over the global order of the distinct ``order`` column.

    Rows fall into ``slices`` ranges of similar size, by default at least 1000 and as many as keep a range
    at some ``slice_rows`` rows; totals run inside each range in parallel, and the totals of the earlier
    ranges, one row per range, are added. ``order`` must not be NULL or NaN.
    """
    slices = slices or max(1000, math.ceil(df.count() / slice_rows))
    cuts = df.agg(F.percentile_approx(F.col(order).cast("double"),
                                      [i / slices for i in range(1, slices)], max(100_000, 100 * slices))
                  .alias("b")).first()["b"]
    splits = [-math.inf, *sorted(set(cuts or [])), math.inf]
    if len(splits) > 2:
        # Binary search over the cut points, in the JVM.
        cutter = Bucketizer(splits=splits, inputCol="__x", outputCol="__bucket")
        placed = (cutter.transform(df.withColumn("__x", F.col(order).cast("double")))
                  .withColumn(SLICE, F.col("__bucket").cast("int")).drop("__x", "__bucket"))
    else:
        placed = df.withColumn(SLICE, F.lit(0))
    sliced = placed.withColumn(SLICE, -F.col(SLICE)) if descending else placed
    direction = F.col(order).desc() if descending else F.col(order).asc()
    inside = (Window.partitionBy(SLICE).orderBy(direction)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, so the single-partition window below never holds more than `slices` rows.
    offsets = (sliced.groupBy(SLICE).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
               .select(SLICE, *[F.coalesce(F.sum(f"__t_{v}").over(earlier), F.lit(0)).alias(f"__o_{v}")
                                for v in values]))
    return (sliced.join(F.broadcast(offsets), SLICE)
            .select(*df.columns,
                    *[(F.sum(v).over(inside) + F.col(f"__o_{v}")).alias(f"cum_{v}") for v in values]))
