"""Helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import ensure_checkpoint_dir, scratch_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> bytes:
    """Bytes of a public vocabulary file; read once on the driver and shipped with the tasks."""
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def small_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Hand Python workers at most ``size`` bytes at a time, where the session allows more."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).removesuffix("b")
    if not now.isdigit() or int(now) > size:
        spark.conf.set(name, f"{size}b")


# What this Python worker remembers from one task to the next.
_kept: dict[Any, Any] = {}


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """What tasks of one kind share in a Python worker; made by the first of them."""
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    """Free what tasks of another kind have left in this worker; Spark reuses workers, whatever they ran before."""
    _kept.clear()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    The result no longer depends on the tasks that made it, so a lost executor repeats none of
    that work and every later use sees the same rows.
    """
    path = scratch_dir(df.sparkSession, f"{label}-{uuid.uuid4().hex[:8]}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def refuse(names: list[str], columns: list[str]) -> None:
    """Stop if a table already has a column of a name that is to be added."""
    clash = [n for n in names if n.lower() in {c.lower() for c in columns}]
    if clash:
        raise ValueError(f"the table already has a column {', '.join(clash)}; rename it first")


def checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def drawn(df: DataFrame, rows: int, key: str) -> DataFrame:
    """At most ``rows`` rows of a table whose ``key`` is unique, chosen by a hash of it; all if there are no more.

    Rows are counted first, so that tasks give up little more than is wanted, however many tasks there are.
    """
    found = df.count()
    if found <= rows:
        return df
    place = F.pmod(F.xxhash64(F.lit(11), key), F.lit(1 << 40))
    cut = int((rows + 5 * rows ** 0.5) / found * (1 << 40))
    return df.where(place <= cut).orderBy(place, key).limit(rows)


def texts(column: pa.Array) -> Iterator[str]:
    """Values of a string column; null counts as empty."""
    for value in column:
        yield value.as_py() or ""
