"""Loan tables: raw records, cleaned and quarantined ones, history, and balance by location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.quality import Rule, expect_or_drop, expect_or_fail, quarantine
from tideline.plans import event_log
from tideline.sources.accounts import account_schema
from tideline.sources.ingest import RESCUED, ingest_files
from tideline.spec import Dataset
from tideline.streaming import paths, writers

# The rules of the cleaned table.
LOAN_RULES: tuple[Rule, ...] = (
    expect_or_drop("Payments should be this year",
                   "try_cast(next_payment_date AS DATE) > DATE'2021-12-31'"),
    expect_or_drop("Balance should be positive", "balance > 0 AND arrears_balance > 0"),
    expect_or_fail("Cost center must be specified", "cost_center_code IS NOT NULL"),
)

# Fixed value: the hand-written inverse of the rules. It compares text with text and yields NULL
# for missing values, so some rejected rows are not caught by it.
LITERAL_INVERSE = ("(next_payment_date <= '2021-12-31') OR (balance <= 0 OR arrears_balance <= 0) "
                   "OR (cost_center_code IS NULL)")

RAW = Dataset("raw_txs", "New loan records from the landing zone",
              properties={"quality": "bronze"})
LOAN_STATS = Dataset("reference_loan_stats", "Historical loan records", cluster_by=("addr_state",),
                     properties={"quality": "bronze"})
STATS_INTERVAL = "1 hour"
TREATMENTS = Dataset("ref_accounting_treatment", "Lookup of accounting treatments")
CLEANED = Dataset("cleaned_new_txs", "New loan records that pass all rules", rules=LOAN_RULES,
                  inputs=("raw_txs", "ref_accounting_treatment"), properties={"quality": "silver"})
QUARANTINED = Dataset("quarantined_cleaned_new_txs", "New loan records that break a rule",
                      inputs=("raw_txs", "ref_accounting_treatment"),
                      properties={"quality": "silver"})
# New loans date payments by the second and old ones by month and text, so the directories are a
# derived year.
BALANCE = Dataset("loan_balance_by_location", "Loan balances of historical and new loans",
                  generated={"last_payment_year": "coalesce(year(try_cast(last_payment_date AS DATE)), "
                                                  "2000 + try_cast(regexp_extract(last_payment_date, "
                                                  "'^[A-Za-z]+-([0-9]{2})$', 1) AS INT))"},
                  partition_by=("last_payment_year",), cluster_by=("location_code",),
                  inputs=("historical_txs", "cleaned_new_txs"), properties={"quality": "gold"})
SCORED = Dataset("risk_prediction", "Historical loans with a risk prediction",
                 inputs=("reference_loan_stats",))


def with_lookup(rows: DataFrame, lookup: DataFrame, key: str, lookup_key: str,
                name: str) -> DataFrame:
    """Rows that have a lookup entry, plus its key as ``name``.

    Spark broadcasts the lookup when its measured size is below the broadcast threshold and
    shuffles both sides otherwise, on batches and on streams.
    """
    entries = lookup.select(F.col(lookup_key).alias(name))
    return rows.join(entries, rows[key] == entries[name], "inner").select(rows["*"], entries[name])


def historical(stats: DataFrame, treatments: DataFrame, key: str = "id") -> DataFrame:
    """Historical rows with a treatment; a treatment listed twice repeats the row."""
    known = treatments.select(F.col(key).alias("__known"))
    same = stats[key].try_cast(treatments.schema[key].dataType) == known["__known"]
    return stats.join(known, same, "inner").select(*[stats[c] for c in stats.columns])


def balance(rows: DataFrame, amount: Column, location: str | Column, date: str | Column) -> DataFrame:
    """Summed balance by location and last payment date."""
    location = F.col(location) if isinstance(location, str) else location
    date = F.col(date) if isinstance(date, str) else date
    return (rows.groupBy(location.alias("location_code"), date.alias("last_payment_date"))
            .agg(F.sum(amount).alias("bal"))
            .select("bal", "location_code", "last_payment_date"))


def balance_by_location(branches: Sequence[DataFrame]) -> DataFrame:
    """Union of aggregated branches; equal rows from different branches appear once."""
    combined = branches[0]
    for branch in branches[1:]:
        combined = combined.union(branch)
    return combined.distinct()


def stats_stream(spark: SparkSession, tables: paths.Tables, loan_stats: str):
    """New loan statistics, from a glob of CSV files."""
    return ingest_files(spark, loan_stats, "csv", rescued=RESCUED,
                        schema_location=tables.checkpoint("reference_loan_stats_schema"))


def follow_stats(spark: SparkSession, tables: paths.Tables, loan_stats: str, interval: str = STATS_INTERVAL):
    """Keep taking in loan statistics at an interval; returns the running query.

    It works on the table and checkpoint of ``run``, so stop it before an update.
    """
    return writers.write_streaming_table(stats_stream(spark, tables, loan_stats), tables.path(LOAN_STATS.name),
                                         tables.checkpoint(LOAN_STATS.name), LOAN_STATS, trigger=interval)


def run(spark: SparkSession, tables: paths.Tables, landing: str, loan_stats: str,
        treatments: str, update_id: str, score=None, quarantine_mode: str = "complement",
        user_name: str | None = None) -> None:
    """One update of all loan tables.

    ``landing`` holds account JSON lines, ``loan_stats`` is a glob of CSV files, ``treatments`` a
    Parquet lookup. ``score`` maps a DataFrame of loans to one with a ``pred`` column.
    """
    log = event_log.EventLog(spark, tables.event_log, update_id)
    log.begin(user_name)

    def stream(df: DataFrame, dataset: Dataset) -> None:
        with log.flow(df, dataset, "append") as done:
            done(writers.write_streaming_table(df, tables.path(dataset.name),
                                               tables.checkpoint(dataset.name), dataset))

    def refresh(df: DataFrame, dataset: Dataset) -> None:
        with log.flow(df, dataset, "complete") as done:
            done([writers.write_live_table(df, tables.path(dataset.name), dataset)])

    stream(ingest_files(spark, landing, "json", schema=account_schema(), rescued=RESCUED), RAW)
    stream(stats_stream(spark, tables, loan_stats), LOAN_STATS)
    refresh(spark.read.parquet(treatments), TREATMENTS)

    lookup = writers.read_snapshot(spark, tables.path(TREATMENTS.name))

    def joined() -> DataFrame:
        new = writers.read_stream(spark, tables.path(RAW.name))
        return with_lookup(new, lookup, "accounting_treatment_id", "id", "accounting_treatment")

    inverse = LITERAL_INVERSE if quarantine_mode == "literal" else None
    stream(quarantine(joined(), LOAN_RULES, inverse), QUARANTINED)
    stream(joined(), CLEANED)

    stats = writers.read_snapshot(spark, tables.path(LOAN_STATS.name))
    cleaned = writers.read_snapshot(spark, tables.path(CLEANED.name))
    refresh(balance_by_location([
        balance(historical(stats, lookup), F.col("revol_bal").try_cast("double"), "addr_state",
                F.col("last_pymnt_d").cast("string")),
        balance(cleaned, F.col("balance").cast("double"), "country_code", "last_payment_date"),
    ]), BALANCE)
    if score is not None:
        stream(score(writers.read_stream(spark, tables.path(LOAN_STATS.name))), SCORED)

