"""The event log: written by every update, read by the analysis queries.

An event has an id, a time, a type, an ``origin`` struct and ``details`` as JSON text. Ids are
made from update, dataset, batch and type, so events written twice collapse on reading. The log lies in
directories by update; a question about one update reads that directory only.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.functions.parsing import json_number, json_path, version_key
from tideline.spec import Dataset
from tideline.streaming.writers import FlowProgress, Progress

EVENT_SCHEMA = ("id STRING, timestamp TIMESTAMP, event_type STRING, "
                "origin STRUCT<update_id: STRING, dataset_name: STRING>, details STRING")

# The directory an event lies in; ids are unique inside it.
UPDATE = "update_id"

# Fixed value: shape of the rule counters in a flow_progress event.
EXPECTATIONS = ("array<struct<name: string, dataset: string, "
                "passed_records: bigint, failed_records: bigint>>")
EXPECTATIONS_EXAMPLE = ('[{"name": "str", "dataset": "str", '
                        '"passed_records": 42, "failed_records": 42}]')


class EventLog:
    """Appends the events of one update."""

    def __init__(self, spark: SparkSession, path: str, update_id: str):
        self.spark, self.path, self.update_id = spark, path, update_id

    def event(self, event_type: str, details: dict, dataset: str = "", key: str = "") -> tuple:
        event_id = "/".join([self.update_id, dataset, key, event_type])
        return (event_id, datetime.now(timezone.utc), event_type, (self.update_id, dataset),
                json.dumps({event_type: details}))

    def append(self, events: list[tuple]) -> None:
        """A handful of rows about the update; they come from the driver in one small file."""
        if events:
            rows = self.spark.createDataFrame(events, EVENT_SCHEMA).withColumn(UPDATE, F.col(f"origin.{UPDATE}"))
            rows.coalesce(1).write.mode("append").partitionBy(UPDATE).parquet(self.path)

    def user_action(self, action: str, user_name: str) -> None:
        self.append([self.event("user_action", {"action": action, "user_name": user_name},
                                key=action)])

    def create_update(self) -> None:
        details = {"runtime_version": {"dbr_version": self.spark.version}}
        self.append([self.event("create_update", details)])

    def begin(self, user_name: str | None = None) -> None:
        """Log that an update starts, and who started it where that is known."""
        self.create_update()
        if user_name is not None:
            self.user_action("START", user_name)

    @contextmanager
    def flow(self, df: DataFrame, dataset: Dataset, flow_type: str):
        """Log the definition of a flow, then its progress or its failure.

        Yields a function that takes the progress of the write, which is settled once it is logged: what a
        killed update did not log is logged by the next one. When a rule fails the update,
        the counters are lost with the job, and the log keeps the error that names the rule.
        """
        self.append([self.event("flow_definition", {
            "output_dataset": dataset.name, "input_datasets": list(dataset.inputs),
            "flow_type": flow_type, "comment": dataset.comment,
            "properties": dict(dataset.properties), "schema": json.loads(df.schema.json()),
        }, dataset.name)])
        given: list[Sequence[FlowProgress]] = []
        try:
            yield given.append
        except Exception as error:
            self.append([self.event("flow_progress", {"status": "FAILED", "error": str(error)},
                                    dataset.name, "failed")])
            raise
        self.append([self.event("flow_progress", _progress_details(p), p.dataset, str(p.batch_id))
                     for progress in given for p in progress])
        for progress in given:
            if isinstance(progress, Progress):
                progress.settle()


def _progress_details(progress: FlowProgress) -> dict:
    metrics = {"num_output_rows": progress.output_rows, "input_bytes": progress.input_bytes,
               "backlog_bytes": progress.backlog_bytes}
    details = {"status": "COMPLETED", "metrics": {k: v for k, v in metrics.items() if v is not None}}
    if progress.expectations:
        details["data_quality"] = {"dropped_records": progress.dropped_rows,
                                   "expectations": progress.expectations}
    return details


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """All events, each id of an update once; a filter by update reaches the directories."""
    newest = Window.partitionBy(UPDATE, "id").orderBy(F.col("timestamp").desc())
    return (spark.read.schema(f"{EVENT_SCHEMA}, {UPDATE} STRING").parquet(path)
            .withColumn("__rank", F.row_number().over(newest)).where("__rank = 1").drop("__rank"))


def _of_update(log: DataFrame, update_id: str | None) -> DataFrame:
    """Events of one update, by directory where the log has any."""
    column = UPDATE if UPDATE in log.columns else f"origin.{UPDATE}"
    return log if update_id is None else log.where(F.col(column) == update_id)


def update_events(log: DataFrame, update_id: str) -> DataFrame:
    """Events of one update in time order."""
    return _of_update(log, update_id).orderBy("timestamp")


def user_actions(log: DataFrame) -> DataFrame:
    return (log.where(F.col("event_type") == "user_action")
            .select("timestamp", json_path("details", "user_action.action").alias("action"),
                    json_path("details", "user_action.user_name").alias("user_name")))


def lineage(log: DataFrame) -> DataFrame:
    """Flow definitions in time order: output, inputs, flow type, schema, whole definition."""
    # Objects and arrays are read as the texts they are: one pass for the definition, one for its fields.
    names = ("output_dataset", "input_datasets", "flow_type", "schema")
    whole = F.from_json("details", "flow_definition STRING").getField("flow_definition")
    fields = F.from_json("flow_definition", ", ".join(f"{n} STRING" for n in names))
    return (log.select("timestamp", whole.alias("flow_definition")).where("flow_definition IS NOT NULL")
            .withColumn("__fields", fields)
            .select("timestamp", *[F.col(f"__fields.{n}").alias(n) for n in names], "flow_definition")
            .orderBy("timestamp").drop("timestamp"))


def _expectations(schema) -> F.Column:
    return F.explode(F.from_json(json_path("details", "flow_progress.data_quality.expectations"),
                                 schema)).alias("rule")


def quality_totals(log: DataFrame, update_id: str | None = None) -> DataFrame:
    """Passed and failed records per dataset and rule for one update."""
    rules = (_of_update(log.where(F.col("event_type") == "flow_progress"), update_id)
             .select(_expectations(EXPECTATIONS)))
    return (rules.groupBy(F.col("rule.dataset").alias("dataset"), F.col("rule.name").alias("expectation"))
            .agg(F.sum("rule.passed_records").alias("passing_records"),
                 F.sum("rule.failed_records").alias("failing_records")))


def quality_runs(log: DataFrame) -> DataFrame:
    """Rule counters of every flow_progress event that carries metrics."""
    shape = F.schema_of_json(F.lit(EXPECTATIONS_EXAMPLE))
    return (log.where(json_path("details", "flow_progress.metrics").isNotNull())
            .select("id", "timestamp",
                    json_path("details", "flow_progress.status").alias("status_update"),
                    _expectations(shape))
            .select("id", "timestamp", "status_update", "rule.dataset", "rule.name",
                    "rule.failed_records", "rule.passed_records"))


def latest_version(log: DataFrame, by_number: bool = False) -> DataFrame:
    """Runtime version of the update that sorts last, as text or by its numbers."""
    version = json_path("details", "create_update.runtime_version.dbr_version")
    order = version_key("dbr_version") if by_number else F.col("dbr_version")
    return (log.where(F.col("event_type") == "create_update")
            .select(version.alias("dbr_version")).orderBy(order.desc()).limit(1))


def backlog(log: DataFrame, update_id: str | None = None) -> DataFrame:
    return (_of_update(log.where(F.col("event_type") == "flow_progress"), update_id)
            .select("timestamp",
                    json_number("details", "flow_progress.metrics.backlog_bytes").alias("backlog")))


def cluster_metrics(log: DataFrame, update_id: str | None = None) -> DataFrame:
    """Executors, task slots, queue and backlog over time; each event is parsed once."""
    metrics = {"current_num_executors": "cluster_utilization.num_executors",
               "avg_num_task_slots": "cluster_utilization.avg_num_task_slots",
               "avg_task_slot_utilization": "cluster_utilization.avg_task_slot_utilization",
               "queue_size": "cluster_utilization.avg_num_queued_tasks",
               "backlog": "flow_progress.metrics.backlog_bytes"}
    chosen = log.where(F.col("event_type").isin("cluster_utilization", "flow_progress"))
    shape = ("cluster_utilization STRUCT<num_executors: STRING, avg_num_task_slots: STRING, "
             "avg_task_slot_utilization: STRING, avg_num_queued_tasks: STRING>, "
             "flow_progress STRUCT<metrics: STRUCT<backlog_bytes: STRING>>")
    return (_of_update(chosen, update_id).select("timestamp", F.from_json("details", shape).alias("__d")).select(
        "timestamp", *[F.col(f"__d.{path}").try_cast("double").alias(name) for name, path in metrics.items()]))
