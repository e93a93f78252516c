import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tideline.operators import changes as ch
from tideline.operators.quality import quarantine
from tideline.plans import customers, event_log, loan, retail
import synthetic
from tideline.streaming import paths, writers

NOW = datetime(2022, 6, 15, 12, 0, 0)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


@pytest.fixture
def loan_inputs(spark, root):
    synthetic.write_account_batches(spark, f"{root}/landing", 3, 200, NOW, seed=1)
    synthetic.treatment_lookup(spark).write.parquet(f"{root}/treatments")
    put(f"{root}/stats/LoanStats_1.csv",
        "id,revol_bal,addr_state,last_pymnt_d\n1,100,CA,Jan-22\n2,50,CA,Jan-22\n99,7,NY,Feb-22\n")
    return root


def run_loans(spark, root, update_id, **more):
    tables = paths.Tables(spark, f"{root}/lake")
    loan.run(spark, tables, f"{root}/landing/*", f"{root}/stats/LoanStats_*", f"{root}/treatments",
             update_id, **more)
    return tables


def test_loan_tables(spark, loan_inputs):
    root = loan_inputs
    tables = run_loans(spark, root, "u1")

    def read(name):
        return writers.read_snapshot(spark, tables.path(name))

    raw = read("raw_txs")
    assert raw.count() == 600
    assert raw.where("_rescued_data IS NOT NULL").count() == 1800 - 1200 - 600
    joined = raw.where("accounting_treatment_id < 6")
    clean, held = read("cleaned_new_txs"), read("quarantined_cleaned_new_txs")
    assert clean.count() + held.count() == joined.count()
    assert clean.where("balance <= 0 OR next_payment_date < '2022-01-01'").count() == 0
    balances = read("loan_balance_by_location")
    assert balances.where("location_code = 'CA' AND last_payment_date = 'Jan-22'").first()["bal"] == 150.0
    assert balances.where("location_code = 'NY'").count() == 0
    total = clean.agg(F.sum("balance")).first()[0] + 150
    assert balances.agg(F.sum("bal")).first()[0] == total

    totals = rows(event_log.quality_totals(event_log.read_event_log(spark, tables.event_log), "u1"))
    assert len(totals) == 3
    assert all(passed + failed == joined.count() for _, _, passed, failed in totals)

    # A second update takes in only the new batch, and the log keeps both updates apart.
    put(f"{root}/landing/batch=9/new.json", json.dumps({"id": "n", "accounting_treatment_id": 1, "balance": 5,
        "arrears_balance": 5, "cost_center_code": "c", "next_payment_date": "2023-01-01T00:00:00Z",
        "country_code": "XX", "last_payment_date": "2020-01-01T00:00:00Z", "surprise": 1}) + "\n")
    run_loans(spark, root, "u2")
    assert read("raw_txs").count() == 601
    assert read("raw_txs").where("_rescued_data IS NOT NULL").count() == 1
    assert read("cleaned_new_txs").count() == clean.count() + 1
    second = rows(event_log.quality_totals(event_log.read_event_log(spark, tables.event_log), "u2"))
    assert [(p, f) for _, _, p, f in second] == [(1, 0)] * 3


def test_failing_loan_update_is_logged_and_quarantined(spark, loan_inputs):
    root = loan_inputs
    put(f"{root}/landing/batch=9/bad.json", json.dumps({
        "id": "bad", "accounting_treatment_id": 1, "balance": 5, "arrears_balance": 5,
        "next_payment_date": "2023-01-01T00:00:00Z"}) + "\n")
    with pytest.raises(Exception, match="Cost center must be specified"):
        run_loans(spark, root, "u1")
    tables = paths.Tables(spark, f"{root}/lake")
    held = writers.read_snapshot(spark, tables.path("quarantined_cleaned_new_txs"))
    assert held.where("id = 'bad'").count() == 1
    log = event_log.read_event_log(spark, tables.event_log)
    failed = log.where("get_json_object(details, '$.flow_progress.status') = 'FAILED'")
    assert "Cost center" in failed.first()["details"]


def test_loan_statistics_at_an_interval(spark, loan_inputs):
    tables = paths.Tables(spark, f"{loan_inputs}/lake")
    query = loan.follow_stats(spark, tables, f"{loan_inputs}/stats/LoanStats_*", interval="1 second")
    try:
        put(f"{loan_inputs}/stats/LoanStats_2.csv", "addr_state,id\nWA,5\n")
        for _ in range(120):
            query.processAllAvailable()
            if writers.read_snapshot(spark, tables.path("reference_loan_stats")).count() == 4:
                break
    finally:
        query.stop()
    stats = writers.read_snapshot(spark, tables.path("reference_loan_stats"))
    assert rows(stats, "id", "addr_state", "revol_bal") == [
        (1, "CA", 100), (2, "CA", 50), (5, "WA", None), (99, "NY", 7)]
    run_loans(spark, loan_inputs, "u1")
    log = event_log.read_event_log(spark, tables.event_log)
    noted = rows(event_log.backlog(log, "u1").where("backlog IS NOT NULL"), "backlog")
    assert noted and noted[0] == (0.0,)


def test_a_question_about_one_update_reads_its_directory(spark, root):
    for update in ("u1", "u2"):
        event_log.EventLog(spark, f"{root}/log", update).begin("ann")
    log = event_log.read_event_log(spark, f"{root}/log")
    plan = event_log.update_events(log, "u2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(update_id" in plan and "(update_id" in plan.split("PartitionFilters")[1][:120]
    assert event_log.update_events(log, "u2").count() == 2


def test_literal_quarantine_mode(spark, loan_inputs):
    tables = run_loans(spark, loan_inputs, "u1", quarantine_mode="literal")
    held = writers.read_snapshot(spark, tables.path("quarantined_cleaned_new_txs"))
    raw = writers.read_snapshot(spark, tables.path("raw_txs")).where("accounting_treatment_id < 6")
    assert held.count() == quarantine(raw, loan.LOAN_RULES, loan.LITERAL_INVERSE).count()


def test_customer_tables(spark, root):
    synthetic.write_change_feed(spark, f"{root}/feed", 400, 50, NOW, seed=2, files=(4, 2))
    bad = [{"id": None, "operation": "APPEND", "operation_date": "06-01-2022 00:00:00"},
           {"id": "w", "operation": "APPEND", "operation_date": "06-01-2022 00:00:00", "firstname": "W",
            "lastname": "W", "email": "w", "odd": 1}]
    put(f"{root}/feed/customers/part-z.json", "\n".join(map(json.dumps, bad)) + "\n")
    tables = paths.Tables(spark, f"{root}/lake")
    current, history = customers.run(spark, tables, f"{root}/feed/customers", "u1", max_files=2)

    feed = spark.read.json(f"{root}/feed/customers").where("id IS NOT NULL AND operation IS NOT NULL")
    whole = ch.ChangeSpec(("id",), F.try_to_timestamp("operation_date", F.lit("MM-dd-yyyy HH:mm:ss")),
                          "operation = 'DELETE'", ("operation", "operation_date", "odd"))
    expected = ch.visible(ch.latest_changes(ch.stamp_changes(feed, whole), whole), whole)
    names = ["id", "firstname", "lastname", "email", "address"]
    assert rows(current.read(), *names) == rows(expected, *names)
    assert rows(history.read().where(f"{ch.END} IS NULL"), *names) == rows(current.read(), *names)
    counted = event_log.read_event_log(spark, tables.event_log).where(
        "origin.dataset_name = 'scd2_customer' AND event_type = 'flow_progress'")
    assert counted.agg(F.sum(F.get_json_object("details", "$.flow_progress.metrics.num_output_rows"))).first()[0] > 0
    totals = {r["expectation"]: r for r in event_log.quality_totals(
        event_log.read_event_log(spark, tables.event_log), "u1").collect()}
    assert totals["valid_id"]["failing_records"] == 1
    assert totals["valid_address"]["failing_records"] >= 1
    transactions = spark.read.json(f"{root}/feed/transactions")
    assert transactions.count() == 50
    assert transactions.join(feed, transactions.customer_id == feed.id, "left_anti").count() <= 2


def test_retail_tables(spark, root):
    put(f"{root}/customers.csv",
        "customer_id,customer_name,state,city,lon,lat,units_purchased,loyalty_segment\n"
        "1,Ann,CA,Los Angeles,0,0,1,1\n2,Bob,IL,Chicago,0,0,1,1\n")

    def order(customer, name, number, products, at="1564617600"):
        return json.dumps({"customer_id": customer, "customer_name": name, "number_of_line_items": "1",
                           "order_datetime": at, "order_number": number, "ordered_products": products})
    item = {"curr": "USD", "price": 10, "qty": 2}
    put(f"{root}/orders/a.json", "\n".join([
        order("1", "Ann", 1, [item, item]), order("2", "Bob", 2, [item]), order("2", "Bob", 3, None),
        order("2", "Robert", 4, [item]), order("2", "Bob", None, [item]),
        order("2", "Bob", 5, [item, {"curr": "EUR", "price": 7, "qty": 1}], at="soon")]) + "\n")
    tables = paths.Tables(spark, f"{root}/lake")
    retail.run(spark, tables, f"{root}/orders", f"{root}/customers.csv", "u1")

    def read(name):
        return writers.read_snapshot(spark, tables.path(name))
    cleaned = read("sales_orders_cleaned")
    assert set(cleaned.columns) == set(retail.CLEANED_COLUMNS)
    assert rows(cleaned, "order_number", "city") == [
        (1, "Los Angeles"), (2, "Chicago"), (3, "Chicago"), (4, None), (5, "Chicago")]
    assert rows(read("sales_order_in_la"), "sales", "quantity") == [(20, 4)]
    in_chicago = rows(read("sales_order_in_chicago"), "order_date", "currency", "sales", "quantity")
    assert len(in_chicago) == 3 and sum(r[2] for r in in_chicago) == 27
    sales = read("sales")
    assert sales.schema.simpleString() == (
        "struct<customer_id:string,customer_name:string,order_date:date,currency:string,"
        "sales:bigint,order_day_of_week:int>")
    # 1 August 2019 was a Thursday.
    assert sales.where("order_date = '2019-08-01'").first()["order_day_of_week"] == 5


def test_log_queries_on_a_hand_written_log(spark, root):
    log = event_log.EventLog(spark, f"{root}/log", "u1")
    log.user_action("START", "ann")
    log.user_action("START", "ann")
    for number, version in enumerate(["9.1", "14.3"]):
        log.append([log.event("create_update", {"runtime_version": {"dbr_version": version}}, key=str(number))])
    log.append([
        log.event("flow_progress", {"metrics": {"backlog_bytes": 12.5}}, "a", "0"),
        log.event("flow_progress", {"metrics": {"backlog_bytes": "lots"}}, "a", "1"),
        log.event("cluster_utilization", {"num_executors": 4, "avg_num_queued_tasks": 1.5}, key="0")])
    events = event_log.read_event_log(spark, f"{root}/log")
    assert rows(event_log.user_actions(events), "action", "user_name") == [("START", "ann")]
    assert event_log.latest_version(events).first()[0] == "9.1"
    assert event_log.latest_version(events, by_number=True).first()[0] == "14.3"
    assert sorted(rows(event_log.backlog(events, "u1"), "backlog"), key=str) == [(12.5,), (None,)]
    metrics = rows(event_log.cluster_metrics(events, "u1"), "current_num_executors", "queue_size", "backlog")
    assert (4.0, 1.5, None) in metrics and len(metrics) == 3
    assert event_log.update_events(events, "u1").count() == 6
    assert event_log.update_events(events, "other").count() == 0
    log.create_update()
    assert event_log.read_event_log(spark, f"{root}/log").count() == 7


def test_lineage_of_a_run(spark, loan_inputs):
    tables = run_loans(spark, loan_inputs, "u1")
    lineage = {r["output_dataset"]: r for r in event_log.lineage(
        event_log.read_event_log(spark, tables.event_log)).collect()}
    assert json.loads(lineage["cleaned_new_txs"]["input_datasets"]) == ["raw_txs", "ref_accounting_treatment"]
    assert lineage["loan_balance_by_location"]["flow_type"] == "complete"
    assert json.loads(lineage["raw_txs"]["schema"])["type"] == "struct"
