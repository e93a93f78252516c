"""The declared shape of loan account records."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Names, types and order of the fields in an account file.
ACCOUNT_FIELDS = """
id STRING, date STRING, acc_fv_change_before_taxes LONG, accounting_treatment_id LONG, accrued_interest LONG,
arrears_balance LONG, balance LONG, base_rate STRING, behavioral_curve_id STRING, country_code STRING,
cost_center_code STRING, currency_code STRING, customer_id STRING, end_date STRING, encumbrance_amount LONG,
encumbrance_type STRING, fvh_level LONG, first_payment_date STRING, guarantee_amount LONG, guarantee_scheme STRING,
impairment_amount LONG, insolvency_rank LONG, last_payment_date STRING, ledger_code STRING, limit_amount LONG,
next_payment_date STRING, next_withdrawal_date STRING, on_balance_sheet BOOLEAN, prev_payment_date STRING,
product_name STRING, purpose STRING, rate DOUBLE, rate_type STRING, reporting_entity_name STRING,
reporting_id STRING, risk_country_code STRING, source STRING, start_date STRING, status STRING, type STRING,
trade_date STRING, uk_funding_type STRING, version_id STRING, withdrawal_penalty LONG, count LONG,
minimum_balance_eur LONG, next_repricing_date STRING, risk_weight_std DOUBLE
"""


def account_schema() -> StructType:
    return StructType.fromDDL(ACCOUNT_FIELDS)
