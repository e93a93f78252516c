"""Retail tables: raw orders, cleaned orders, sales by city, and the sales table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.parsing import epoch_timestamp
from tideline.operators.quality import expect_or_drop
from tideline.plans import event_log
from tideline.sources.ingest import RESCUED, ingest_files
from tideline.spec import Dataset
from tideline.streaming import paths, writers

# Column order of the cleaned orders, rule, cities, and shape of the sales table.
CLEANED_COLUMNS = ("customer_id", "customer_name", "number_of_line_items", "order_datetime",
                   "order_date", "order_number", "ordered_products", "state", "city", "lon",
                   "lat", "units_purchased", "loyalty_segment")
ORDER_RULES = (expect_or_drop("valid order_number", "order_number IS NOT NULL"),)
LOS_ANGELES, CHICAGO = "Los Angeles", "Chicago"
SALES_KEYS = ("order_date", "city", "customer_id", "customer_name", "currency")
SALES_SUMS = ("sales", "quantity")
SALES_SCHEMA = ("customer_id STRING, customer_name STRING, order_date DATE, currency STRING, "
                "sales LONG, order_day_of_week INT")

RAW = Dataset("sales_orders_raw", "Raw sales orders", properties={"quality": "bronze"})
CLEANED = Dataset("sales_orders_cleaned", "Sales orders with a valid number", rules=ORDER_RULES,
                  partition_by=("order_date",), inputs=("sales_orders_raw", "customers"),
                  properties={"quality": "silver"})
IN_LA = Dataset("sales_order_in_la", "Sales in Los Angeles", inputs=("sales_orders_cleaned",),
                properties={"quality": "gold"})
IN_CHICAGO = Dataset("sales_order_in_chicago", "Sales in Chicago",
                     inputs=("sales_orders_cleaned",), properties={"quality": "gold"})
SALES = Dataset("sales", "Sales with the day of the week", schema=SALES_SCHEMA,
                generated={"order_day_of_week": "dayofweek(order_date)"},
                partition_by=("order_day_of_week",), inputs=("sales_order_in_chicago",),
                properties={"quality": "gold"})


def customers(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; every column is text."""
    return spark.read.csv(path, header=True)


def orders_with_customer(orders: DataFrame, customers: DataFrame,
                         keys=("customer_id", "customer_name")) -> DataFrame:
    """Orders with the customer's columns (NULL when unknown), order time and order date."""
    joined = orders.join(customers, list(keys), "left")
    joined = joined.withColumn("order_datetime", epoch_timestamp("order_datetime"))
    return joined.withColumn("order_date", F.col("order_datetime").cast("date"))


def sales_lines(cleaned: DataFrame, city: str | None = None) -> DataFrame:
    """Sales and quantity of every order line, with what they are summed up by.

    Lines are exploded after the city filter; an order without lines gives no row.
    """
    rows = cleaned if city is None else cleaned.where(F.col("city") == city)
    lines = rows.select("city", "order_date", "customer_id", "customer_name",
                        F.explode("ordered_products").alias("line"))
    return lines.select("order_date", "city", "customer_id", "customer_name", F.col("line.curr").alias("currency"),
                        F.col("line.price").alias("sales"), F.col("line.qty").alias("quantity"))


def sales_by_city(cleaned: DataFrame, city: str | None = None) -> DataFrame:
    """Sales and quantity per order date, city, customer and currency, over the order lines."""
    return (sales_lines(cleaned, city).groupBy(*SALES_KEYS)
            .agg(*[F.sum(s).alias(s) for s in SALES_SUMS]))


def keep_sales(cleaned: DataFrame, city: str | None, path: str, checkpoint: str, dataset: Dataset, **more):
    """The same sums from a stream, kept as a table to which every batch adds its own groups."""
    return writers.write_stream_sums(sales_lines(cleaned, city), SALES_KEYS, SALES_SUMS, path, checkpoint,
                                     dataset, **more)


def run(spark: SparkSession, tables: paths.Tables, orders: str, customer_file: str,
        update_id: str, user_name: str | None = None) -> None:
    """One update of all retail tables."""
    log = event_log.EventLog(spark, tables.event_log, update_id)
    log.begin(user_name)
    raw = ingest_files(spark, orders, "json",
                       schema_location=tables.checkpoint("sales_orders_schema"), rescued=RESCUED)
    with log.flow(raw, RAW, "append") as done:
        done(writers.write_streaming_table(raw, tables.path(RAW.name),
                                           tables.checkpoint(RAW.name), RAW))
    cleaned = orders_with_customer(writers.read_stream(spark, tables.path(RAW.name)),
                                   customers(spark, customer_file)).select(*CLEANED_COLUMNS)
    with log.flow(cleaned, CLEANED, "append") as done:
        done(writers.write_streaming_table(cleaned, tables.path(CLEANED.name),
                                           tables.checkpoint(CLEANED.name), CLEANED))
    for dataset, city in ((IN_LA, LOS_ANGELES), (IN_CHICAGO, CHICAGO)):
        orders_of = writers.read_stream(spark, tables.path(CLEANED.name))
        with log.flow(sales_by_city(orders_of, city), dataset, "update") as done:
            done(keep_sales(orders_of, city, tables.path(dataset.name), tables.checkpoint(dataset.name), dataset))
    in_chicago = writers.read_snapshot(spark, tables.path(IN_CHICAGO.name))
    with log.flow(in_chicago, SALES, "complete") as done:
        done([writers.write_live_table(in_chicago, tables.path(SALES.name), SALES)])
