import pytest
from pyspark.sql import Observation

from helpers import TESTDATA, rows
from tideline.operators.quality import (DROPPED_ROWS, INPUT_ROWS, Rule, apply_expectations, expect,
                                        expect_or_drop, expect_or_fail, expectation_counts, quarantine)
from tideline.plans import loan

SCHEMA = ("id string, next_payment_date string, balance long, arrears_balance long, "
          "cost_center_code string")
GOOD = ("good", "2022-01-01T00:00:00Z", 5, 5, "c")
NULL_DATE = ("null_date", None, 5, 5, "c")
LAST_DAY = ("last_day", "2021-12-31T10:00:00Z", 5, 5, "c")
LOW = ("low", "2023-01-01T00:00:00Z", 0, 5, "c")
NULL_BALANCE = ("null_balance", "2023-01-01T00:00:00Z", None, 5, "c")
BAD_DATE = ("bad_date", "not a date", 5, 5, "c")
NO_CENTER = ("no_center", "2023-01-01T00:00:00Z", 5, 5, None)
NO_CENTER_LOW = ("no_center_low", "2023-01-01T00:00:00Z", 0, 5, None)


def frame(spark, *records):
    return spark.createDataFrame(list(records), SCHEMA)


def ids(df):
    return [r[0] for r in rows(df, "id")]


def test_drop_rules_keep_only_rows_that_hold(spark):
    df = frame(spark, GOOD, NULL_DATE, LAST_DAY, LOW, NULL_BALANCE, BAD_DATE)
    assert ids(apply_expectations(df, loan.LOAN_RULES)) == ["good"]


def test_clean_and_quarantine_are_the_input(spark):
    df = frame(spark, GOOD, NULL_DATE, LAST_DAY, LOW, NULL_BALANCE, BAD_DATE)
    clean = ids(apply_expectations(df, loan.LOAN_RULES))
    assert sorted(clean + ids(quarantine(df, loan.LOAN_RULES))) == sorted(ids(df))


def test_literal_inverse_misses_null_and_boundary_rows(spark):
    df = frame(spark, GOOD, NULL_DATE, LAST_DAY, LOW)
    kept = ids(quarantine(df, loan.LOAN_RULES, loan.LITERAL_INVERSE))
    assert kept == ["low"]


def test_fail_rule_aborts_and_names_itself(spark):
    with pytest.raises(Exception, match="Cost center must be specified"):
        apply_expectations(frame(spark, GOOD, NO_CENTER), loan.LOAN_RULES).collect()


def test_drop_rule_does_not_hide_a_failing_row(spark):
    with pytest.raises(Exception, match="Cost center must be specified"):
        apply_expectations(frame(spark, NO_CENTER_LOW), loan.LOAN_RULES).collect()


def test_failing_row_is_quarantined(spark):
    assert ids(quarantine(frame(spark, GOOD, NO_CENTER), loan.LOAN_RULES)) == ["no_center"]


def test_warn_rule_keeps_and_counts_the_row(spark):
    rules = (expect("balance known", "balance IS NOT NULL"), expect_or_drop("low", "balance > 0 OR balance IS NULL"))
    observation = Observation("warned")
    df = apply_expectations(frame(spark, GOOD, NULL_BALANCE, LOW), rules, observation)
    assert ids(df) == ["good", "null_balance"]
    assert observation.get == {INPUT_ROWS: 3, DROPPED_ROWS: 1, "failed_0": 1, "failed_1": 1}


def test_counts_add_up(spark):
    df = frame(spark, GOOD, NULL_DATE, LAST_DAY, LOW, NO_CENTER)
    counted = expectation_counts(df, loan.LOAN_RULES, "d").collect()
    assert [r["name"] for r in counted] == [r.name for r in loan.LOAN_RULES]
    assert all(r["passed_records"] + r["failed_records"] == 5 for r in counted)
    assert [r["failed_records"] for r in counted] == [2, 1, 1]


def test_drop_rules_reach_the_scan(spark):
    df = spark.read.parquet(f"{TESTDATA}/lineitem.parquet")
    rule = expect_or_drop("discounted", "l_discount > 0.05")
    plan = apply_expectations(df, [rule])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_discount,0.05)" in plan


def test_unknown_action_is_rejected():
    with pytest.raises(ValueError):
        Rule("r", "true", "ignore")


def test_lookup_join_keeps_only_known_treatments(spark):
    txs = spark.createDataFrame([(5, "a"), (6, "b")], "accounting_treatment_id long, id string")
    lookup = spark.createDataFrame([(5, "x"), (0, "y")], "id long, accounting_treatment string")
    joined = loan.with_lookup(txs, lookup, "accounting_treatment_id", "id", "accounting_treatment")
    assert joined.columns == ["accounting_treatment_id", "id", "accounting_treatment"]
    assert rows(joined) == [(5, "a", 5)]


def test_history_repeats_rows_for_repeated_keys_and_skips_bad_ids(spark):
    stats = spark.createDataFrame([("1", 10), ("x", 20), ("9", 30)], "id string, revol_bal int")
    lookup = spark.createDataFrame([(1,), (1,)], "id long")
    assert rows(loan.historical(stats, lookup)) == [("1", 10), ("1", 10)]


def test_union_of_balances_removes_equal_rows(spark):
    branch = spark.createDataFrame([(1.0, "US", "2022-01-01")], "bal double, location_code string, last_payment_date string")
    assert loan.balance_by_location([branch, branch]).count() == 1


def test_fail_rule_is_not_pruned_by_a_narrow_select(spark):
    df = apply_expectations(frame(spark, GOOD, NO_CENTER), [expect_or_fail("center", "cost_center_code IS NOT NULL")])
    with pytest.raises(Exception, match="expectation failed: center"):
        df.select("id").collect()
