"""Writing datasets: append-once streaming tables, fully refreshed live tables, stream aggregates."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StructType, VariantType

from tideline.operators.quality import DROPPED_ROWS, INPUT_ROWS, apply_expectations
from tideline.spec import Dataset
from tideline.streaming import paths
from tideline.streaming.folded import BUCKET_ROWS, FoldedTable

# The folder of a micro-batch in a streaming table is named after its id.
BATCH = "__batch"


@dataclass(frozen=True)
class FlowProgress:
    """What one write of a dataset did: a micro-batch, or a full refresh."""

    dataset: str
    batch_id: int
    output_rows: int
    dropped_rows: int = 0
    expectations: list[dict] = field(default_factory=list)
    input_bytes: int | None = None
    backlog_bytes: int | None = None


def lay_out(df: DataFrame, dataset: Dataset) -> DataFrame:
    """Distribute rows for the write.

    Clustered tables are range-sorted, so that files carry narrow min/max values; a hash of the
    row ends the range key and lets a value with many rows span several files. Tables that are
    only partitioned are rebalanced: adaptive execution splits large partitions and merges small
    ones, so each directory gets few, similar files.
    """
    if dataset.cluster_by:
        order = [*dataset.partition_by, *dataset.cluster_by]
        hashed = [f.name for f in df.schema if not isinstance(f.dataType, (MapType, VariantType))]
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in hashed])
        return df.repartitionByRange(*order, spread).sortWithinPartitions(*order)
    if dataset.partition_by:
        return df.hint("rebalance", *dataset.partition_by)
    return df


def _checked_and_laid_out(shaped: DataFrame, dataset: Dataset, observation: Observation) -> DataFrame:
    """Rows that the rules allow, distributed for the write, each counted once.

    A range sort samples its input before it deals it, so its rows are counted behind it.
    """
    if dataset.cluster_by:
        return apply_expectations(lay_out(shaped, dataset), dataset.rules, observation)
    return lay_out(apply_expectations(shaped, dataset.rules, observation), dataset)


def _rule_entries(dataset: Dataset, counts) -> list[dict]:
    return [{"name": rule.name, "dataset": dataset.name,
             "passed_records": counts[INPUT_ROWS] - counts[f"failed_{i}"],
             "failed_records": counts[f"failed_{i}"]}
            for i, rule in enumerate(dataset.rules)]


def _schema_path(path: str, version: int | None) -> str:
    return f"{path}/_schema_stream.json" if version is None else f"{path}/_schema_v{version:08d}.json"


def _keep_schema(df: DataFrame, path: str, version: int | None) -> None:
    """Store the schema next to the data; partition columns would be typed by guess otherwise."""
    paths.write_text(df.sparkSession, _schema_path(path, version), df.schema.json(), replace=True)


def write_live_table(df: DataFrame, path: str, dataset: Dataset) -> FlowProgress:
    """Replace the table's content with ``df``, in a new version directory.

    A rule that fails the update, or any other error, leaves the previous version in place.
    """
    spark = df.sparkSession
    observation = Observation(dataset.name)
    shaped = dataset.shape(df)
    latest = paths.latest_version(spark, path)
    version = 0 if latest is None else latest + 1
    _keep_schema(shaped, path, version)
    writer = _checked_and_laid_out(shaped, dataset, observation).write.mode("overwrite")
    writer.partitionBy(*dataset.partition_by).parquet(paths.version_path(path, version))
    return _flow_progress(dataset, version, observation.get)


def _triggered(writer, trigger: str | None):
    """Process what is there and stop, or keep running at an interval such as ``1 hour``."""
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def _flow_progress(dataset: Dataset, batch_id: int, counts) -> FlowProgress:
    return FlowProgress(dataset.name, batch_id, counts[INPUT_ROWS] - counts[DROPPED_ROWS],
                        counts[DROPPED_ROWS], _rule_entries(dataset, counts))


@dataclass(frozen=True)
class Prepared:
    """A stream whose micro-batches take shape only when they are there, such as files with headers."""

    stream: DataFrame
    prepare: Callable[[DataFrame], DataFrame]
    schema: StructType

    @property
    def sparkSession(self) -> SparkSession:
        return self.stream.sparkSession

    @property
    def columns(self) -> list[str]:
        return self.schema.names


class Progress(list):
    """Progress of batches that nobody has settled yet; ``settle`` says that they are noted elsewhere.

    Batches of a run that was killed are listed by the next run.
    """

    def __init__(self, entries, settle: Callable[[], None]):
        super().__init__(entries)
        self.settle = settle


def _batch_path(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}={batch_id}"


def _batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in paths.children(spark, path) if n.startswith(f"{BATCH}="))


def _append_batch(batch: DataFrame, batch_id: int, path: str, dataset: Dataset) -> None:
    """Write one micro-batch with its counters under a hidden name, then show both by one rename.

    A batch that is replayed after that is found and skipped; before that, nothing of it was seen.
    """
    spark, target = batch.sparkSession, _batch_path(path, batch_id)
    if paths.exists(spark, target):
        return
    draft = f"{path}/_draft/{batch_id}"
    shaped = dataset.shape(batch)
    observation = Observation(dataset.name)
    (_checked_and_laid_out(shaped, dataset, observation)
     .write.mode("overwrite").partitionBy(*dataset.partition_by).parquet(draft))
    entry = _flow_progress(dataset, batch_id, observation.get)
    paths.write_text(spark, f"{draft}/_progress.json", json.dumps(asdict(entry)), replace=True)
    if not paths.rename(spark, draft, target):
        raise OSError(f"cannot show {target}")


def progress_after(spark: SparkSession, path: str, batch_id: int | None) -> list[FlowProgress]:
    """What the later batches of a streaming table did, as stored with their rows."""
    found = [b for b in _batches(spark, path) if batch_id is None or b > batch_id]
    return [FlowProgress(**json.loads(paths.read_text(spark, f"{_batch_path(path, b)}/_progress.json")))
            for b in found]


def outstanding_bytes(spark: SparkSession, checkpoint: str, batches: Sequence[int]) -> dict[int, tuple[int, int]]:
    """For each of some batches the bytes of its files, and of the files of the later ones among them.

    The files are those that the stream's file source has logged; their sizes come from a listing.
    """
    log = f"{checkpoint}/sources/0"
    if not batches or not paths.exists(spark, log):
        return {}
    entry = F.from_json("value", "path STRING, batchId BIGINT")
    files = (spark.read.text(log).where("value LIKE '{%'").select(entry.alias("e")).select("e.path", "e.batchId").distinct()
             .where(F.col("batchId").between(min(batches), max(batches))))
    # As many paths as the file source listed itself.
    listed = {r["path"]: r["batchId"] for r in files.collect()}
    if not listed:
        return {}
    sizes = {}
    for path, batch in listed.items():
        sizes[batch] = sizes.get(batch, 0) + paths.size(spark, path)
    return {b: (sizes.get(b, 0), sum(n for later, n in sizes.items() if later > b)) for b in batches}


def write_streaming_table(df: DataFrame | Prepared, path: str, checkpoint: str, dataset: Dataset,
                          trigger: str | None = None):
    """Append each new input record once.

    Every micro-batch is laid out for itself and becomes visible at once, together with its
    counters (this needs a file system where renaming a folder is one step). Returns the progress of all
    batches that are not settled, or the running query when a ``trigger`` interval is given.
    """
    spark = df.sparkSession
    if isinstance(df, Prepared):
        shaped = dataset.shape(spark.createDataFrame([], df.schema))
        stream, prepare = df.stream, df.prepare
    else:
        shaped, stream, prepare = dataset.shape(df), df, lambda batch: batch
    paths.delete(spark, f"{path}/_draft")
    _keep_schema(shaped, path, None)
    writer = (stream.writeStream.foreachBatch(lambda b, i: _append_batch(prepare(b), i, path, dataset))
              .option("checkpointLocation", checkpoint))
    query = _triggered(writer, trigger).start()
    if trigger:
        return query
    query.awaitTermination()
    return unsettled(spark, path, checkpoint)


def unsettled(spark: SparkSession, path: str, checkpoint: str) -> Progress:
    """Progress of the batches of a streaming table that were not settled yet, with their backlog."""
    settled = f"{checkpoint}/settled.json"
    last = json.loads(paths.read_text(spark, settled)) if paths.exists(spark, settled) else None
    entries = progress_after(spark, path, last)
    sizes = outstanding_bytes(spark, checkpoint, [e.batch_id for e in entries])
    entries = [replace(e, input_bytes=sizes[e.batch_id][0], backlog_bytes=sizes[e.batch_id][1])
               if e.batch_id in sizes else e for e in entries]

    def settle() -> None:
        if entries:
            paths.write_whole(spark, settled, json.dumps(entries[-1].batch_id))

    return Progress(entries, settle)


class SumTable(FoldedTable):
    """Sums per group, kept up to date from a stream of rows.

    A micro-batch adds one row per group that it holds; folds rewrite the buckets of those groups.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], sums: Sequence[str],
                 compact_every: int | None = 20, bucket_rows: int = BUCKET_ROWS):
        super().__init__(spark, path, keys, self._added, compact_every, bucket_rows)
        self.sums = list(sums)

    def _totals(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.sum(s).alias(s) for s in self.sums])

    def _added(self, state: DataFrame | None, new: DataFrame) -> DataFrame:
        both = new if state is None else state.unionByName(new)
        # A group has a row per batch at most, so nothing is gained by summing up the rows of a file first.
        both = both.repartition(*[F.col(f"`{k}`") for k in self.keys])
        # Sums of sums keep the type of the first ones.
        return self._totals(both).select(*self.keys, *[F.col(s).cast(new.schema[s].dataType).alias(s) for s in self.sums])

    def add(self, batch: DataFrame, batch_id: int) -> int | None:
        """Add the rows of one micro-batch; adding the same batch id again changes nothing.

        A task keeps all groups that it meets in memory, and a batch may hold nearly as many groups as rows. So rows
        meet their groups before they are summed up, in tasks of the advisory partition size: adaptive execution splits
        what is larger, the rows of one group too, whatever the files the batch was read from.
        """
        return self.record(batch_id, lambda: self._totals(batch.hint("rebalance", *self.keys)))


def write_stream_sums(df: DataFrame, keys: Sequence[str], sums: Sequence[str], path: str, checkpoint: str,
                      dataset: Dataset, trigger: str | None = None, compact_every: int | None = 20,
                      bucket_rows: int = BUCKET_ROWS):
    """Keep the sums of a stream's rows per group; a batch costs what its own groups cost.

    The dataset's rules hold for the rows that are summed up. Returns the progress of the new batches, whose output
    rows are groups, or the running query when a ``trigger`` interval is given. ``read_sums`` reads the table.
    """
    spark = df.sparkSession
    store = SumTable(spark, path, keys, sums, compact_every, bucket_rows)
    shaped = dataset.shape(df).select(*keys, *sums)
    totals = store._totals(spark.createDataFrame([], shaped.schema))
    paths.write_whole(spark, f"{path}/_sums.json", json.dumps(
        {"keys": list(keys), "sums": list(sums), "schema": totals.schema.jsonValue()}))
    done: list[FlowProgress] = []

    def add(batch: DataFrame, batch_id: int) -> None:
        observation = Observation(dataset.name)
        checked = apply_expectations(batch, dataset.rules, observation)
        groups = store.add(checked, batch_id)
        if groups is not None:
            counts = observation.get
            done.append(FlowProgress(dataset.name, batch_id, groups, counts[DROPPED_ROWS], _rule_entries(dataset, counts)))

    writer = shaped.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    query = _triggered(writer, trigger).start()
    if trigger:
        return query
    query.awaitTermination()
    return done


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    """The sums of all groups."""
    made = json.loads(paths.read_text(spark, f"{path}/_sums.json"))
    state = SumTable(spark, path, made["keys"], made["sums"]).state()
    return spark.createDataFrame([], StructType.fromJson(made["schema"])) if state is None else state


def write_stream_aggregate(df: DataFrame, path: str, checkpoint: str, dataset: Dataset,
                           trigger: str | None = None):
    """Keep a streaming aggregate as a live table: every batch writes the complete result.

    A replayed batch rewrites its own version directory, so readers see each result once.
    """
    done: dict[int, FlowProgress] = {}

    def refresh(batch: DataFrame, batch_id: int) -> None:
        observation = Observation(dataset.name)
        shaped = dataset.shape(batch)
        _keep_schema(shaped, path, batch_id)
        (_checked_and_laid_out(shaped, dataset, observation).write.mode("overwrite").partitionBy(*dataset.partition_by)
         .parquet(paths.version_path(path, batch_id)))
        done[batch_id] = _flow_progress(dataset, batch_id, observation.get)

    writer = (df.writeStream.outputMode("complete").foreachBatch(refresh)
              .option("checkpointLocation", checkpoint))
    query = _triggered(writer, trigger).start()
    if trigger:
        return query
    query.awaitTermination()
    return [done[batch_id] for batch_id in sorted(done)]


def _stored_schema(spark: SparkSession, path: str, version: int | None) -> StructType:
    return StructType.fromJson(json.loads(paths.read_text(spark, _schema_path(path, version))))


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Current content of a table written by this module."""
    if paths.exists(spark, f"{path}/_sums.json"):
        return read_sums(spark, path)
    version = paths.latest_version(spark, path)
    schema = _stored_schema(spark, path, version)
    if version is not None:
        return spark.read.schema(schema).parquet(paths.version_path(path, version))
    return spark.read.schema(schema.add(BATCH, LongType())).parquet(path).drop(BATCH)


def read_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New records of a streaming table, as a stream."""
    if paths.latest_version(spark, path) is not None:
        raise ValueError(f"{path} is fully refreshed and cannot be read as a stream")
    reader = spark.readStream.schema(_stored_schema(spark, path, None).add(BATCH, LongType()))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).drop(BATCH)
