"""Every operator of the package as a query over the given tables.

Each function takes a session and the folder of Parquet tables, runs over whole tables, and
returns a DataFrame. Streaming queries run to the end of the available data into a new scratch
folder and return the table read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.operators import changes as ch
from tideline.operators.quality import (apply_expectations, expect, expect_or_drop, expect_or_fail,
                                        expectation_counts, quarantine)
from tideline.plans import event_log, loan, retail, risk
from tideline.session import scratch_dir
from tideline.sources.ingest import ingest_files, rescue_json
from tideline.spec import Dataset
from tideline.streaming import catalog, writers
from tideline.streaming.change_target import ChangeTarget, apply_changes

Query = Callable[[SparkSession, str], DataFrame]

SHIPMENT_RULES = (
    expect_or_drop("shipped after 1997", "CAST(l_shipdate AS DATE) > DATE'1997-12-31'"),
    expect_or_drop("discount and tax are positive", "l_discount > 0 AND l_tax > 0"),
    expect("returned or accepted", "l_returnflag <> 'N'"),
    expect_or_fail("line status is known", "l_linestatus IS NOT NULL"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table as a stream; all tables are files of one folder, hence the name filter."""
    schema = table(spark, folder, name).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .parquet(folder))


def money(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(18,2)")


def _streamed(spark: SparkSession, df: DataFrame, dataset: Dataset) -> DataFrame:
    """Append the stream to a new table, update once more (nothing is new), read the table."""
    root = scratch_dir(spark, dataset.name)
    for _ in range(2):
        writers.write_streaming_table(df, f"{root}/table", f"{root}/checkpoint", dataset)
    return writers.read_snapshot(spark, f"{root}/table")


# --- ingest ---------------------------------------------------------------------------------


def ingest_stream_once(spark, folder):
    return _streamed(spark, table_stream(spark, folder, "events"), Dataset("events_bronze"))


def ingest_json_files(spark, folder):
    """Table to JSON files, then ingest with an inferred, stored schema and rescued fields."""
    root = scratch_dir(spark, "ingest_json")
    table(spark, folder, "customer").repartition(8).write.json(f"{root}/landing")
    stream = ingest_files(spark, f"{root}/landing", "json", schema_location=f"{root}/schema",
                          rescued="_rescued_data", max_files=4)
    return _streamed(spark, stream, Dataset("customer_json"))


def ingest_csv_files(spark, folder):
    """Table to CSV files with a header, then ingest through a glob with inferred types."""
    root = scratch_dir(spark, "ingest_csv")
    table(spark, folder, "part").repartition(4).write.option("header", True).csv(f"{root}/landing")
    stream = ingest_files(spark, f"{root}/landing/part-*", "csv", schema_location=f"{root}/schema")
    return _streamed(spark, stream, Dataset("part_csv"))


def _csv_lines(df: DataFrame, header: str, path: str) -> None:
    """Write lines of text as CSV files that all begin with the same header, whatever the lines hold."""
    df.toDF(header).write.mode("append").option("header", True).option("sep", "\x01").option("quote", "\x02").csv(path)


def csv_mixed_headers(spark, folder):
    """Orders in CSV files with three headers: reordered, lacking a column, with a column of their own."""
    root = scratch_dir(spark, "csv_mixed_headers")
    orders = table(spark, folder, "orders").repartition(6)
    for part, header in enumerate((("o_orderkey", "o_custkey", "o_orderpriority"),
                                   ("o_orderpriority", "o_custkey", "o_orderkey"), ("o_custkey", "note", "o_orderkey"))):
        some = orders.where(F.col("o_orderkey") % 3 == part).withColumn("note", F.concat(F.lit("n"), "o_orderstatus"))
        some.select(*header).write.mode("append").option("header", True).csv(f"{root}/landing")
    stream = ingest_files(spark, f"{root}/landing", "csv", max_files=5, rescued="_rescued_data",
                          schema="o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING")
    return _streamed(spark, stream, Dataset("orders_csv")).select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.get_json_object("_rescued_data", "$.note").alias("note"))


def rescue_fields(spark, folder):
    """Events as JSON lines, parsed with a schema that lacks a field and mistypes another."""
    lines = table(spark, folder, "events").select(
        F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("line"))
    return rescue_json(lines, "line", StructType.fromDDL("event_id BIGINT, user_id BIGINT, value INT"))


# --- loan tables ------------------------------------------------------------------------------


def _shipments(rows: DataFrame, spark, folder) -> DataFrame:
    return loan.with_lookup(rows, table(spark, folder, "supplier"), "l_suppkey", "s_suppkey",
                            "supplier")


def clean_txs(spark, folder):
    rows = _shipments(table_stream(spark, folder, "lineitem"), spark, folder)
    return _streamed(spark, rows, Dataset("clean_txs", rules=SHIPMENT_RULES))


def quarantine_txs(spark, folder):
    rows = _shipments(table_stream(spark, folder, "lineitem"), spark, folder)
    return _streamed(spark, quarantine(rows, SHIPMENT_RULES), Dataset("quarantine_txs"))


def expectation_totals(spark, folder):
    rows = _shipments(table(spark, folder, "lineitem"), spark, folder)
    return expectation_counts(rows, SHIPMENT_RULES, "clean_txs")


def fail_rule_passes(spark, folder):
    rules = (expect_or_fail("status is known", "o_orderstatus IN ('F', 'O', 'P')"),
             expect_or_drop("price is above 1000", "o_totalprice > 1000"))
    return apply_expectations(table(spark, folder, "orders"), rules)


def history_view(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "id")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))
    return loan.historical(orders, customers)


def _order_balance(spark, folder) -> DataFrame:
    places = (table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "n_name"))
    orders = table(spark, folder, "orders")
    placed = orders.join(places, orders["o_custkey"] == places["c_custkey"])
    return loan.balance(placed, money("o_totalprice"), "n_name", F.col("o_orderdate").cast("date"))


def _shipment_balance(spark, folder) -> DataFrame:
    suppliers = (table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "n_name"))
    clean = apply_expectations(table(spark, folder, "lineitem"), SHIPMENT_RULES[:2])
    placed = clean.join(suppliers, clean["l_suppkey"] == suppliers["s_suppkey"])
    return loan.balance(placed, money("l_extendedprice"), "n_name", F.col("l_shipdate").cast("date"))


def balance_by_location(spark, folder):
    return loan.balance_by_location([_order_balance(spark, folder), _shipment_balance(spark, folder)])


def partitioned_layout(spark, folder):
    """A live table in directories by priority, range-sorted by date and customer."""
    dataset = Dataset("orders_layout", partition_by=("o_orderpriority",),
                      cluster_by=("o_orderdate", "o_custkey"))
    root = scratch_dir(spark, dataset.name)
    writers.write_live_table(table(spark, folder, "orders"), root, dataset)
    return writers.read_snapshot(spark, root)


def clustered_stream(spark, folder):
    """A streaming table in directories by priority, each batch range-sorted by date and customer."""
    dataset = Dataset("orders_stream", partition_by=("o_orderpriority",),
                      cluster_by=("o_orderdate", "o_custkey"))
    return _streamed(spark, table_stream(spark, folder, "orders"), dataset)


def catalog_tables(spark, folder):
    """An external table after two refreshes and a managed copy of it, both read by name."""
    root = scratch_dir(spark, "catalog_tables")
    database = "tideline_" + root.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    dataset = Dataset("suppliers", partition_by=("s_nationkey",))
    catalog.refresh(suppliers.where("s_suppkey % 2 = 0"), f"{root}/live", dataset, f"{database}.suppliers")
    catalog.refresh(suppliers, f"{root}/live", dataset, f"{database}.suppliers")
    catalog.drop(spark, f"{database}.copied")
    catalog.save_managed(spark.table(f"{database}.suppliers"), f"{database}.copied", Dataset("copied", cluster_by=("s_name",)))
    return spark.sql(f"SELECT s_suppkey, s_name, c.s_nationkey FROM {database}.suppliers "
                     f"JOIN {database}.copied AS c USING (s_suppkey, s_name)")


def live_table_refresh(spark, folder):
    """A live table refreshed twice holds its definition once."""
    dataset = Dataset("supplier_nation", schema="s_suppkey BIGINT, n_name STRING, balance DECIMAL(18,2)",
                      generated={"balance": "CAST(s_acctbal AS DECIMAL(18,2))"})
    rows = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    root = scratch_dir(spark, dataset.name)
    for _ in range(2):
        writers.write_live_table(rows, root, dataset)
    return writers.read_snapshot(spark, root)


# --- change feeds -----------------------------------------------------------------------------


def _change_feed(events: DataFrame) -> DataFrame:
    """Cleansed change records: known user and operation."""
    rules = (expect_or_drop("valid_id", "user_id IS NOT NULL"),
             expect_or_drop("valid_operation", "event_type IS NOT NULL"),
             expect("valid_value", "value IS NOT NULL"))
    return apply_expectations(events, rules)


def scd1_users(spark, folder):
    """Current row per user from the event stream; an error event deletes the user."""
    root = scratch_dir(spark, "scd1_users")
    target = apply_changes(
        spark, f"{root}/target", _change_feed(table_stream(spark, folder, "events")),
        f"{root}/checkpoint", keys=["user_id"], sequence_by=F.struct("ts", "event_id"),
        apply_as_deletes="event_type = 'error'", except_column_list=["props", "ts"])
    return target.read()


def _out_of_order(spark, folder, name: str, spec: ch.ChangeSpec) -> DataFrame:
    """The whole feed in three batches, newest first, with a fold in between and a replay."""
    events = _change_feed(table(spark, folder, "events"))
    day = F.dayofmonth("ts")
    batches = [events.where(day > 20), events.where(day.between(11, 20)), events.where(day < 11)]
    target = ChangeTarget(spark, scratch_dir(spark, name), spec, compact_every=2)
    for batch_id, batch in enumerate(batches):
        target.apply(batch, batch_id)
        target.apply(batch, batch_id)
    return target.read()


def scd2_users(spark, folder):
    return _out_of_order(spark, folder, "scd2_users", ch.ChangeSpec(
        keys=("user_id",), sequence_by="ts", apply_as_deletes="event_type = 'error'",
        except_columns=("props", "ts"), scd_type=2))


def scd2_in_buckets(spark, folder):
    """The same versions from small buckets: nine batches, a fold after every second one."""
    events = _change_feed(table(spark, folder, "events"))
    spec = ch.ChangeSpec(keys=("user_id",), sequence_by="ts", apply_as_deletes="event_type = 'error'",
                         except_columns=("props", "ts"), scd_type=2)
    target = ChangeTarget(spark, scratch_dir(spark, "scd2_in_buckets"), spec, compact_every=2, bucket_rows=5000)
    for batch_id in range(9):
        target.apply(events.where(F.col("event_id") % 9 == (batch_id * 5) % 9), batch_id)
    target.clean_up()
    return target.read()


def scd2_tracked(spark, folder):
    return _out_of_order(spark, folder, "scd2_tracked", ch.ChangeSpec(
        keys=("user_id",), sequence_by="ts", apply_as_deletes="event_type = 'error'",
        except_columns=("props", "ts"), scd_type=2, track_history=("event_type",)))


def scd2_hot_keys(spark, folder):
    """Five keys hold all records; each is cut into slices along its sequence."""
    feed = table(spark, folder, "events").withColumn("large", F.col("value") > 50)
    spec = ch.ChangeSpec(keys=("event_type",), sequence_by="ts",
                         apply_as_deletes="user_id % 7 = 0", except_columns=("props", "ts"),
                         scd_type=2, track_history=("large",), min_hot_rows=100)
    target = ChangeTarget(spark, scratch_dir(spark, "scd2_hot_keys"), spec)
    target.apply(feed, 0)
    return target.read()


def scd2_text_sequence(spark, folder):
    """Five keys hold all records, sequenced by text; each is cut into slices along it."""
    moment = F.concat_ws("/", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    feed = (table(spark, folder, "events").withColumn("moment", moment)
            .select("event_type", "user_id", "event_id", "value", "moment"))
    spec = ch.ChangeSpec(keys=("event_type",), sequence_by="moment", except_columns=("moment",),
                         scd_type=2, min_hot_rows=100)
    target = ChangeTarget(spark, scratch_dir(spark, "scd2_text_sequence"), spec)
    target.apply(feed, 0)
    return target.read()


# --- retail -----------------------------------------------------------------------------------


def _retail_customers(spark, folder) -> DataFrame:
    nation = table(spark, folder, "nation")
    customer = table(spark, folder, "customer")
    return (customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
            .select(F.col("c_custkey").cast("string").alias("customer_id"),
                    F.col("c_name").alias("customer_name"), F.col("n_name").alias("city"),
                    F.col("c_mktsegment").alias("loyalty_segment")))


def orders_with_customer(spark, folder):
    """Left join of the order stream; pending orders carry a name no customer has."""
    known = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    orders = table_stream(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(known).alias("customer_name"),
        F.col("o_orderkey").alias("order_number"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string").alias("order_datetime"))
    cleaned = retail.orders_with_customer(orders, _retail_customers(spark, folder))
    cleaned = cleaned.withColumn("order_datetime", F.col("order_datetime").cast("timestamp_ntz"))
    return _streamed(spark, cleaned, Dataset("orders_cleaned", rules=retail.ORDER_RULES))


def _packed_orders(rows: DataFrame, spark, folder) -> DataFrame:
    """Shipments as orders with an array of two product lines; untaxed ones have no array."""
    suppliers = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    suppliers = suppliers.select("s_suppkey", "s_name", F.col("n_name").alias("city"))
    line = F.struct(F.col("l_returnflag").alias("curr"), money("l_extendedprice").alias("price"),
                    F.col("l_linenumber").cast("bigint").alias("qty"))
    charge = F.struct(F.col("l_linestatus").alias("curr"), money("l_quantity").alias("price"),
                      F.lit(1).cast("bigint").alias("qty"))
    return rows.join(suppliers, rows["l_suppkey"] == suppliers["s_suppkey"], "left").select(
        "city", F.trunc(F.col("l_shipdate").cast("date"), "month").alias("order_date"),
        F.col("l_suppkey").cast("string").alias("customer_id"),
        F.col("s_name").alias("customer_name"),
        F.when(F.col("l_tax") > 0, F.array(line, charge)).alias("ordered_products"))


def sales_by_place(spark, folder):
    """Sums over exploded order lines of every city, from a stream of several micro-batches."""
    dataset = Dataset("sales_by_place")
    root = scratch_dir(spark, dataset.name)
    packed = _packed_orders(table(spark, folder, "lineitem"), spark, folder)
    # Dealt by a hash, which needs no sort; a large file can be read by several tasks.
    (packed.repartition(8, F.xxhash64(*packed.columns)).write.option("parquet.block.size", 16 << 20)
     .parquet(f"{root}/orders"))
    schema = spark.read.parquet(f"{root}/orders").schema
    orders = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/orders")
    for _ in range(2):
        retail.keep_sales(orders, None, f"{root}/table", f"{root}/checkpoint", dataset, compact_every=3)
    return writers.read_snapshot(spark, f"{root}/table")


def sales_table(spark, folder):
    """Sales of one city in the declared shape, with the generated day of the week."""
    orders = _packed_orders(table(spark, folder, "lineitem"), spark, folder)
    root = scratch_dir(spark, "sales_table")
    writers.write_live_table(retail.sales_by_city(orders, "NATION_3"), root, retail.SALES)
    return writers.read_snapshot(spark, root)


# --- event log --------------------------------------------------------------------------------


def event_records(spark, folder) -> DataFrame:
    """The events table as an event log: five event types with their JSON details."""
    e = table(spark, folder, "events")
    number = F.col("event_id")
    minor = (number % 17).cast("string")

    def wrap(name: str, *fields: Column) -> Column:
        return F.to_json(F.struct(F.struct(*fields).alias(name)))

    details = (
        F.when(F.col("event_type") == "click", wrap(
            "user_action", F.lit("START").alias("action"),
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name")))
        .when(F.col("event_type") == "view", wrap(
            "flow_definition", F.concat(F.lit("table_"), minor).alias("output_dataset"),
            F.array(F.concat(F.lit("source_"), minor)).alias("input_datasets"),
            F.lit("append").alias("flow_type"), F.struct(F.lit("long").alias("id")).alias("schema")))
        .when(F.col("event_type") == "signup", wrap(
            "create_update", F.struct(F.concat(minor, F.lit("."), (number % 4).cast("string"))
                                      .alias("dbr_version")).alias("runtime_version")))
        .when(F.col("event_type") == "error", wrap(
            "cluster_utilization", (number % 9).alias("num_executors"),
            (number % 5).alias("avg_num_task_slots"), (number % 3).alias("avg_task_slot_utilization"),
            (number % 11).alias("avg_num_queued_tasks")))
        .otherwise(wrap(
            "flow_progress", F.lit("COMPLETED").alias("status"),
            F.struct((number * 3).alias("num_output_rows"), (number * 10).alias("backlog_bytes"))
            .alias("metrics"),
            F.struct((number % 6).alias("dropped_records"), F.array(
                F.struct(F.lit("valid_id").alias("name"), F.concat(F.lit("table_"), minor).alias("dataset"),
                         (number * 2).alias("passed_records"), (number % 6).alias("failed_records")),
                F.struct(F.lit("valid_value").alias("name"), F.concat(F.lit("table_"), minor).alias("dataset"),
                         (number + 7).alias("passed_records"), (number % 2).alias("failed_records")))
                .alias("expectations")).alias("data_quality"))))
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in (
        ("click", "user_action"), ("view", "flow_definition"), ("signup", "create_update"),
        ("error", "cluster_utilization"), ("purchase", "flow_progress")) for x in pair]), F.col("event_type"))
    return e.select(number.cast("string").alias("id"), F.col("ts").alias("timestamp"),
                    kind.alias("event_type"),
                    F.struct(F.concat(F.lit("update_"), (F.col("user_id") % 4).cast("string"))
                             .alias("update_id")).alias("origin"), details.alias("details"))


def log_update_events(spark, folder):
    chosen = event_log.update_events(event_records(spark, folder), "update_1")
    return chosen.select("id", "timestamp", "event_type", "origin.update_id")


def log_user_actions(spark, folder):
    return event_log.user_actions(event_records(spark, folder))


def log_lineage(spark, folder):
    return event_log.lineage(event_records(spark, folder))


def log_quality_totals(spark, folder):
    return event_log.quality_totals(event_records(spark, folder), "update_2")


def log_quality_runs(spark, folder):
    return event_log.quality_runs(event_records(spark, folder))


def log_latest_version(spark, folder):
    return event_log.latest_version(event_records(spark, folder))


def log_latest_version_by_number(spark, folder):
    return event_log.latest_version(event_records(spark, folder), by_number=True)


def log_backlog(spark, folder):
    return event_log.backlog(event_records(spark, folder), "update_3")


def log_cluster_metrics(spark, folder):
    return event_log.cluster_metrics(event_records(spark, folder), "update_0")


def log_view_in_sql(spark, folder):
    """The log as a view, queried with a named parameter."""
    event_records(spark, folder).createOrReplaceTempView("tideline_event_log")
    return spark.sql(
        "SELECT event_type, count(*) AS events FROM tideline_event_log "
        "WHERE origin.update_id = :update_id GROUP BY event_type", args={"update_id": "update_1"})


def log_of_own_run(spark, folder):
    """Clean the shipments with observed counters, log the run, and report its quality totals."""
    root = scratch_dir(spark, "log_of_own_run")
    log = event_log.EventLog(spark, f"{root}/log", "run_1")
    dataset = Dataset("clean_txs", rules=SHIPMENT_RULES, inputs=("lineitem", "supplier"))
    rows = _shipments(table_stream(spark, folder, "lineitem"), spark, folder)
    with log.flow(rows, dataset, "append") as done:
        done(writers.write_streaming_table(rows, f"{root}/table", f"{root}/checkpoint", dataset))
    return event_log.quality_totals(event_log.read_event_log(spark, f"{root}/log"), "run_1")


def log_rows_of_own_run(spark, folder):
    """Rows that a run logs for a cleaned table, its quarantine and an aggregate, with the rows they hold."""
    root = scratch_dir(spark, "log_rows_of_own_run")
    log = event_log.EventLog(spark, f"{root}/log", "run_1")
    log.begin("someone")
    rows = _shipments(table_stream(spark, folder, "lineitem"), spark, folder)
    held = None
    for dataset, df in ((Dataset("clean_txs", rules=SHIPMENT_RULES), rows),
                        (Dataset("quarantine_txs"), quarantine(rows, SHIPMENT_RULES)),
                        (Dataset("by_flag"), table(spark, folder, "lineitem").groupBy("l_returnflag").count())):
        path = f"{root}/{dataset.name}"
        with log.flow(df, dataset, "append") as done:
            done(writers.write_streaming_table(df, path, f"{path}_checkpoint", dataset) if df.isStreaming
                 else [writers.write_live_table(df, path, dataset)])
        count = writers.read_snapshot(spark, path).agg(F.count(F.lit(1)).alias("held"), F.lit(dataset.name).alias("dataset"))
        held = count if held is None else held.union(count)
    events = event_log.read_event_log(spark, f"{root}/log")
    logged = (events.where("event_type = 'flow_progress'").groupBy(F.col("origin.dataset_name").alias("dataset"))
              .agg(F.sum(F.get_json_object("details", "$.flow_progress.metrics.num_output_rows").cast("long")).alias("logged")))
    return logged.join(held, "dataset").select("dataset", "logged", "held")


def log_backlog_of_own_run(spark, folder):
    """Bytes that a run over six files logs: all it read, what was open after its first batch, and after its last.

    Every order is a line of 16 bytes, so the sizes are known.
    """
    root = scratch_dir(spark, "log_backlog_of_own_run")
    line = F.lpad(F.col("o_orderkey").cast("string"), 15, " ")
    table(spark, folder, "orders").select(line).repartition(6).write.text(f"{root}/landing")
    stream = spark.readStream.option("maxFilesPerTrigger", 2).text(f"{root}/landing")
    log = event_log.EventLog(spark, f"{root}/log", "run_1")
    dataset = Dataset("lines")
    with log.flow(stream, dataset, "append") as done:
        done(writers.write_streaming_table(stream, f"{root}/table", f"{root}/checkpoint", dataset))
    events = event_log.read_event_log(spark, f"{root}/log").where("event_type = 'flow_progress'")
    bytes_read = F.get_json_object("details", "$.flow_progress.metrics.input_bytes").cast("long")
    open_bytes = F.get_json_object("details", "$.flow_progress.metrics.backlog_bytes").cast("long")
    noted = events.select(bytes_read.alias("input"), open_bytes.alias("backlog"))
    return noted.agg(F.count(F.lit(1)).alias("batches"), F.sum("input").alias("read_bytes"),
                     F.max(F.col("input") + F.col("backlog")).alias("first_bytes"), F.min("backlog").alias("last_backlog"))


def rescue_csv(spark, folder):
    """Orders as CSV files with misfits and values too many; nothing is lost."""
    root = scratch_dir(spark, "rescue_csv")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 10 == 3, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("customer"))
    lines = orders.select(F.concat_ws(",", "o_orderkey", "customer", F.when(F.col("o_orderkey") % 10 == 7, "extra")))
    _csv_lines(lines.repartition(4), "o_orderkey,customer", f"{root}/landing")
    stream = ingest_files(spark, f"{root}/landing", "csv", schema="o_orderkey BIGINT, customer BIGINT",
                          rescued="_rescued_data")
    return _streamed(spark, stream, Dataset("orders_csv")).select(
        "o_orderkey", "customer", F.get_json_object("_rescued_data", "$.customer").alias("misfit"),
        F.get_json_object("_rescued_data", "$._corrupt_record").alias("whole"))


def rescue_nested(spark, folder):
    """Events with a nested field that the schema mistypes or lacks; the whole struct is kept."""
    lines = table(spark, folder, "events").select(F.to_json(F.struct(
        "event_id", F.struct("user_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("kind"))
        .alias("who"), F.array(F.struct(F.col("value").alias("v"))).alias("items"))).alias("line"))
    schema = StructType.fromDDL("event_id BIGINT, who STRUCT<user_id: BIGINT>, items ARRAY<STRUCT<v: DOUBLE>>")
    found = rescue_json(lines, "line", schema)
    return found.select("event_id", F.col("who.user_id").alias("user_id"), F.col("items")[0]["v"].alias("value"),
                        F.get_json_object(F.get_json_object("_rescued_data", "$.who"), "$.kind").alias("kind"),
                        F.get_json_object("_rescued_data", "$.items").alias("items"))


# --- risk model -------------------------------------------------------------------------------


def loan_book(spark, folder) -> DataFrame:
    """Orders in the shape of finished and running loans, with a label that features explain."""
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    borrowers = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    orders = table(spark, folder, "orders")
    rows = orders.join(borrowers, orders["o_custkey"] == borrowers["c_custkey"])
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    priority = F.substring("o_orderpriority", 1, 1)
    status = (F.when(F.col("o_orderstatus") == "P", "Current")
              .when((price > 300000) & (key % 10 < 8), "Charged Off")
              .when((F.col("c_acctbal") < 0) & (key % 10 < 5), "Default")
              .when(key % 10 == 9, "Charged Off").otherwise("Fully Paid"))
    return rows.select(
        "o_orderkey",
        F.when(key % 3 == 0, " 60 months").otherwise(" 36 months").alias("term"),
        F.col("c_mktsegment").alias("home_ownership"),
        F.col("o_orderpriority").alias("purpose"), F.col("n_name").alias("addr_state"),
        F.when(priority == "1", "Source Verified").when(priority == "2", "Verified")
        .otherwise("Not Verified").alias("verification_status"),
        F.when(key % 50 == 0, "Joint App").otherwise("Individual").alias("application_type"),
        price.alias("loan_amnt"),
        F.when(key % 20 != 7, F.col("c_acctbal")).alias("annual_inc"),
        (key % 4).cast("double").alias("delinq_2yrs"), (key % 30).cast("double").alias("total_acc"),
        status.alias("loan_status"))


def label_rows(spark, folder):
    labelled = risk.label_loans(loan_book(spark, folder))
    return risk.clean_verification(labelled).select(
        "o_orderkey", "loan_status", "bad_loan", "verification_status")


def sample_split(spark, folder):
    """Every order and the part of the seeded split it falls into."""
    small, rest = risk.sample_loans(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")
    return small.withColumn("part", F.lit("sample")).union(rest.withColumn("part", F.lit("rest")))


def count_by_state(spark, folder):
    return risk.loans_per_state(loan_book(spark, folder))


def fixed_scores(spark, folder) -> DataFrame:
    """A score and a label for every labelled document, without a trained model."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return labels.join(documents.select("doc_id", "n_chars"), "doc_id").select(
        ((F.col("n_chars") % 1000) / 1000.0).alias("p1"), F.col("quality").cast("double").alias("label"),
        F.when(F.col("n_chars") % 1000 > 400, 1.0).otherwise(0.0).alias("prediction"),
        F.col("n_chars").alias("net"))


def roc_by_bins(spark, folder):
    return risk.roc_points(fixed_scores(spark, folder), bins=100)


def roc_exact(spark, folder):
    return risk.roc_points(fixed_scores(spark, folder), bins=None)


def roc_null_scores(spark, folder):
    """The exact curve with its end points, where some rows have no score."""
    scored = fixed_scores(spark, folder)
    holes = F.when(F.col("net") % 7 != 0, F.col("p1"))
    return risk.roc_points(scored.withColumn("p1", holes), bins=None, ends=True)


def roc_stacked(spark, folder):
    scored = fixed_scores(spark, folder)
    turned = scored.withColumn("p1", F.lit(0.999) - F.col("p1"))
    return risk.stacked_roc({"scored": scored, "turned": turned}, bins=10)


def f_measure_by_threshold(spark, folder):
    return risk.f_measures(fixed_scores(spark, folder))


def roc_area(spark, folder):
    return risk.roc_area(fixed_scores(spark, folder))


def confusion_totals(spark, folder):
    return risk.confusion_value(fixed_scores(spark, folder), "net")


def confusion_business_value(spark, folder):
    return risk.business_value(risk.confusion_value(fixed_scores(spark, folder), "net"))


def _training_table(spark, folder) -> DataFrame:
    """Labelled loans, stored once because training reads them many times."""
    return risk.store_training_table(risk.label_loans(loan_book(spark, folder)),
                                     scratch_dir(spark, "loanstats_train"))


# Where this application has published a model of a folder's loans.
_PUBLISHED: dict[tuple[str, str, str], str] = {}


def _published(spark, folder, kind: str):
    """The regression (``glm``) or the trees (``gbt``), trained once per application and loaded from where they were published."""
    key = (spark.sparkContext.applicationId, folder, kind)
    if key not in _PUBLISHED:
        loans = _training_table(spark, folder)
        model = risk.train_glm(loans) if kind == "glm" else risk.train_gbt(loans)
        if kind == "glm":
            risk.best_threshold(model, loans)
        root = scratch_dir(spark, "risk_model")
        risk.publish_model(model, root, f"loan_{kind}", "production")
        _PUBLISHED[key] = root
    return risk.load_model(_PUBLISHED[key], f"loan_{kind}", "production")


def glm_scores(spark, folder):
    return risk.score(_published(spark, folder, "glm"), risk.label_loans(loan_book(spark, folder)))


def gbt_scores(spark, folder):
    return risk.score(_published(spark, folder, "gbt"), risk.label_loans(loan_book(spark, folder)))


def _checked_scores(spark, folder, kind: str, threshold: float) -> DataFrame:
    """Every labelled loan, and whether its scores are as they must be whatever the model has learned."""
    scored = _published(spark, folder, kind).transform(risk.label_loans(loan_book(spark, folder)))
    p = vector_to_array("probability")
    return scored.select("o_orderkey", "bad_loan", (F.abs(p[0] + p[1] - 1) < 1e-9).alias("sums_to_one"),
                         ((F.col("prediction") == 1) == (p[1] > threshold)).alias("follows_threshold"))


def glm_rows(spark, folder):
    return _checked_scores(spark, folder, "glm", _published(spark, folder, "glm").stages[-1].getThreshold())


def gbt_rows(spark, folder):
    return _checked_scores(spark, folder, "gbt", 0.5)


def scored_stream(spark, folder):
    """Every loan scored by the trees as a stream, and whether the batch says the same."""
    root, model = scratch_dir(spark, "scored_stream"), _published(spark, folder, "gbt")
    loans = loan_book(spark, folder)
    loans.repartition(4).write.parquet(f"{root}/loans")
    stream = spark.readStream.schema(loans.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/loans")
    streamed = _streamed(spark, risk.risk_predictions(model, stream), Dataset("scored"))
    batch = risk.risk_predictions(model, loans).select("o_orderkey", F.col("pred").alias("by_batch"))
    return streamed.join(batch, "o_orderkey").select("o_orderkey", (F.col("pred") == F.col("by_batch")).alias("same"))


def _features() -> str:
    return f"struct({', '.join([*risk.CATEGORICALS, *risk.NUMERICS])})"


def risk_functions_agree(spark, folder):
    """The published model, the SQL function and the pandas UDF give every loan the same label."""
    loans, model = loan_book(spark, folder), _published(spark, folder, "glm")
    risk.register_risk_function(spark, model, "tideline_loan_risk")
    spark.udf.register("tideline_loan_risk_udf", risk.loan_risk_udf(spark, model))
    scored = (risk.risk_predictions(model, loans)
              .withColumn("by_sql", F.expr(f"tideline_loan_risk({_features()})"))
              .withColumn("by_udf", F.expr(f"tideline_loan_risk_udf({_features()})")))
    wrong = (F.col("pred") != F.col("by_sql")) | (F.col("pred") != F.col("by_udf"))
    return scored.agg(F.count(F.lit(1)).alias("loans"), F.count_if(wrong).alias("disagreements"))


def tree_function_rows(spark, folder):
    """Every loan, and whether the trees as a SQL function say what the model says."""
    loans, model = loan_book(spark, folder), _published(spark, folder, "gbt")
    spark.udf.register("tideline_loan_trees", risk.loan_risk_udf(spark, model))
    return risk.risk_predictions(model, loans).select(
        "o_orderkey", F.expr(f"pred = tideline_loan_trees({_features()})").alias("same"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    ingest_stream_once, ingest_json_files, ingest_csv_files, csv_mixed_headers, rescue_fields, clean_txs,
    quarantine_txs, expectation_totals, fail_rule_passes, history_view, balance_by_location,
    partitioned_layout, clustered_stream, catalog_tables, live_table_refresh, scd1_users, scd2_users,
    scd2_in_buckets, scd2_tracked, scd2_hot_keys,
    scd2_text_sequence, orders_with_customer, sales_by_place, sales_table, log_update_events, log_user_actions,
    log_lineage, log_quality_totals, log_quality_runs, log_latest_version,
    log_latest_version_by_number, log_backlog, log_cluster_metrics, log_view_in_sql,
    log_of_own_run, log_rows_of_own_run, log_backlog_of_own_run, rescue_csv, rescue_nested, label_rows, sample_split, count_by_state, roc_by_bins, roc_exact,
    roc_null_scores, roc_stacked,
    roc_area, f_measure_by_threshold, confusion_totals, confusion_business_value, glm_scores,
    gbt_scores, glm_rows, gbt_rows, scored_stream, risk_functions_agree, tree_function_rows)}
