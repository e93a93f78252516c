"""Customer change feed: raw records, cleansed records, type 1 and type 2 tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.functions.parsing import change_time
from tideline.operators.quality import expect, expect_or_drop
from tideline.plans import event_log
from tideline.sources.ingest import RESCUED, ingest_files
from tideline.spec import Dataset
from tideline.streaming import paths, writers
from tideline.streaming.change_target import ChangeTarget, apply_changes

# Column set and rules of the cleansed feed.
CLEAN_COLUMNS = ("address", "email", "id", "firstname", "lastname", "operation", "operation_date",
                 RESCUED)
CUSTOMER_RULES = (
    expect_or_drop("valid_id", "id IS NOT NULL"),
    expect("valid_address", "address IS NOT NULL"),
    expect_or_drop("valid_operation", "operation IS NOT NULL"),
)

BRONZE = Dataset("customer_bronze", "New customer records from the landing zone",
                 properties={"quality": "bronze"})
CLEAN = Dataset("customer_bronze_clean", "Cleansed customer change records", rules=CUSTOMER_RULES,
                inputs=("customer_bronze",), properties={"quality": "silver"})
SCD1 = Dataset("scd1_customer", "Current customers", inputs=("customer_bronze_clean",))
SCD2 = Dataset("scd2_customer", "Customer history", inputs=("customer_bronze_clean",))


def cleanse(raw: DataFrame) -> DataFrame:
    return raw.select(*CLEAN_COLUMNS)


def run(spark: SparkSession, tables: paths.Tables, feed: str, update_id: str,
        max_files: int | None = None, user_name: str | None = None) -> tuple[ChangeTarget, ChangeTarget]:
    """One update: ingest, cleanse, and bring both customer tables up to date."""
    log = event_log.EventLog(spark, tables.event_log, update_id)
    log.begin(user_name)
    raw = ingest_files(spark, feed, "json", rescued=RESCUED, max_files=max_files,
                       schema_location=tables.checkpoint("customer_schema"))
    with log.flow(raw, BRONZE, "append") as done:
        done(writers.write_streaming_table(raw, tables.path(BRONZE.name),
                                           tables.checkpoint(BRONZE.name), BRONZE))
    clean = cleanse(writers.read_stream(spark, tables.path(BRONZE.name), max_files))
    with log.flow(clean, CLEAN, "append") as done:
        done(writers.write_streaming_table(clean, tables.path(CLEAN.name),
                                           tables.checkpoint(CLEAN.name), CLEAN))
    targets = []
    for dataset, scd_type in ((SCD1, 1), (SCD2, 2)):
        source = writers.read_stream(spark, tables.path(CLEAN.name), max_files)
        with log.flow(source, dataset, "append") as done:
            targets.append(apply_changes(
                spark, tables.path(dataset.name), source, tables.checkpoint(dataset.name),
                keys=["id"], sequence_by=change_time("operation_date"),
                apply_as_deletes="operation = 'DELETE'",
                except_column_list=["operation", "operation_date", RESCUED],
                stored_as_scd_type=scd_type, name=dataset.name))
            done(targets[-1].progress)
    return targets[0], targets[1]
