"""Generated input: loan accounts, a treatment lookup, and customer and transaction feeds.

Every value is an arithmetic function of a row id, a column name and a seed. Rows therefore come
out the same however the ids are partitioned and however often a task is retried, and no Python
runs per row.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, LongType, StringType, StructField,
                               StructType)

from tideline.functions.parsing import CHANGE_TIME_FORMAT

# --- Fixed values: the accounting treatments and the account record -----------------------------

TREATMENTS = ((0, "held_to_maturity"), (1, "available_for_sale"), (2, "amortised_cost"),
              (3, "loans_and_recs"), (4, "held_for_hedge"), (5, "fv_designated"))
# Treatment ids are drawn from 0..8, so a third of the accounts has no entry in the lookup.
TREATMENT_IDS = 9

BASE_RATES = ("ZERO", "UKBRBASE", "FDTR")
ENCUMBRANCE_TYPES = ("repo", "covered_bond", "derivative", "none", "other")
GUARANTEE_SCHEMES = (
    "be_pf", "bg_dif", "hr_di", "cy_dps", "cz_dif", "dk_gdfi", "ee_dgs", "fi_dgf", "fr_fdg",
    "gb_fscs", "de_edb", "de_edo", "de_edw", "gr_dgs", "hu_ndif", "ie_dgs", "it_fitd", "lv_dgf",
    "lt_vi", "lu_fgdl", "mt_dcs", "nl_dgs", "pl_bfg", "pt_fgd", "ro_fgdb", "sk_dpf", "si_dgs",
    "es_fgd", "se_ndo", "us_fdic")
PURPOSES = (
    "admin", "annual_bonus_accruals", "benefit_in_kind", "capital_gain_tax", "cash_management",
    "cf_hedge", "ci_service", "clearing", "collateral", "commitments", "computer_and_it_cost",
    "corporation_tax", "credit_card_fee", "critical_service", "current_account_fee", "custody",
    "employee_stock_option", "dealing_revenue", "dealing_rev_deriv", "dealing_rev_deriv_nse",
    "dealing_rev_fx", "dealing_rev_fx_nse", "dealing_rev_sec", "dealing_rev_sec_nse", "deposit",
    "derivative_fee", "dividend", "div_from_cis", "div_from_money_mkt", "donation", "employee",
    "escrow", "fees", "fine", "firm_operating_expenses", "firm_operations", "fx", "goodwill",
    "insurance_fee", "intra_group_fee", "investment_banking_fee", "inv_in_subsidiary",
    "investment_property", "interest", "int_on_bond_and_frn", "int_on_bridging_loan",
    "int_on_credit_card", "int_on_ecgd_lending", "int_on_deposit", "int_on_derivative",
    "int_on_deriv_hedge", "int_on_loan_and_adv", "int_on_money_mkt", "int_on_mortgage",
    "int_on_sft", "ips", "loan_and_advance_fee", "ni_contribution", "manufactured_dividend",
    "mortgage_fee", "non_life_ins_premium", "occupancy_cost", "operational",
    "operational_excess", "operational_escrow", "other", "other_expenditure", "other_fs_fee",
    "other_non_fs_fee", "other_social_contrib", "other_staff_rem", "other_staff_cost",
    "overdraft_fee", "own_property", "pension", "ppe", "prime_brokerage", "property", "recovery",
    "redundancy_pymt", "reference", "reg_loss", "regular_wages", "release", "rent",
    "restructuring", "retained_earnings", "revaluation", "revenue_reserve", "share_plan",
    "staff", "system", "tax", "unsecured_loan_fee", "write_off")
RATE_TYPES = ("fixed", "variable", "tracker", "combined", "preferential")
STATUSES = ("active", "cancelled", "cancelled_payout_agreed", "transactional", "other")
ACCOUNT_TYPES = (
    "bonds", "call", "cd", "credit_card", "current", "depreciation", "internet_only", "ira",
    "isa", "money_market", "non_product", "deferred", "expense", "income", "intangible",
    "prepaid_card", "provision", "reserve", "suspense", "tangible", "non_deferred",
    "retail_bonds", "savings", "time_deposit", "vostro", "other", "amortisation")
UK_FUNDING_TYPES = ("a", "b")

# Column name and how it is filled: ("int", low, high), high excluded; ("enum", values); or a kind.
ACCOUNT_FIELDS = (
    ("id", "id"),
    ("date", "now"),
    ("acc_fv_change_before_taxes", ("int", -10000, 100000)),
    ("accounting_treatment_id", ("int", 0, TREATMENT_IDS)),
    ("accrued_interest", ("int", -10000, 100000)),
    ("arrears_balance", ("int", -10000, 100000)),
    ("balance", ("int", -10000, 100000)),
    ("base_rate", ("enum", BASE_RATES)),
    ("behavioral_curve_id", "word"),
    ("country_code", "country"),
    ("cost_center_code", "word"),
    ("currency_code", "currency"),
    ("customer_id", "word"),
    ("end_date", "date"),
    ("encumbrance_amount", ("int", 0, 100000)),
    ("encumbrance_type", ("enum", ENCUMBRANCE_TYPES)),
    ("fvh_level", ("int", 1, 3)),
    ("first_payment_date", "date"),
    ("guarantee_amount", ("int", 0, 100000)),
    ("guarantee_scheme", ("enum", GUARANTEE_SCHEMES)),
    ("impairment_amount", ("int", 0, 100000)),
    ("insolvency_rank", ("int", 1, 100000)),
    ("last_payment_date", "date"),
    ("ledger_code", "word"),
    ("limit_amount", ("int", -10000, 100000)),
    ("next_payment_date", "date"),
    ("next_withdrawal_date", "date"),
    ("on_balance_sheet", "boolean"),
    ("prev_payment_date", "date"),
    ("product_name", "word"),
    ("purpose", ("enum", PURPOSES)),
    ("rate", "number"),
    ("rate_type", ("enum", RATE_TYPES)),
    ("reporting_entity_name", "word"),
    ("reporting_id", "text"),
    ("risk_country_code", "country"),
    ("source", "word"),
    ("start_date", "date"),
    ("status", ("enum", STATUSES)),
    ("type", ("enum", ACCOUNT_TYPES)),
    ("trade_date", "date"),
    ("uk_funding_type", ("enum", UK_FUNDING_TYPES)),
    ("version_id", "word"),
    ("withdrawal_penalty", ("int", -10000, 100000)),
    ("count", ("int", 1, 100000)),
    ("minimum_balance_eur", ("int", -10000, 100000)),
    ("next_repricing_date", "date"),
    ("risk_weight_std", "number"),
)
# Dates fall between ten years before and thirty years after `now`; numbers between 0.00 and 4.99.
DATE_BACK_DAYS, DATE_SPAN_DAYS = 3652, 14610
NUMBER_STEPS = 500
DATE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Weights of the operations in the change feeds; the last one is a missing operation.
OPERATIONS = (("APPEND", 50), ("DELETE", 10), ("UPDATE", 30), (None, 1))

# --- Own values: words for free-text columns ----------------------------------------------------

WORDS = ("amber", "basin", "cedar", "delta", "ember", "fjord", "grove", "harbor", "inlet",
         "juniper", "kelp", "lagoon", "marsh", "nectar", "orchard", "prairie", "quarry", "reef",
         "summit", "tundra", "upland", "valley", "willow", "yarrow", "zephyr")
FIRST_NAMES = ("Ada", "Bela", "Caro", "Dita", "Edon", "Fenn", "Gala", "Hale", "Iris", "Jory",
               "Kian", "Lumi", "Mika", "Nell", "Odin", "Pia")
LAST_NAMES = ("Ashby", "Brook", "Colby", "Dalton", "Easton", "Farrow", "Granger", "Holt",
              "Irving", "Jarvis", "Kendal", "Lowell", "Marsh", "Norwood", "Oakes", "Preston")

# Customers a change feed is about, by default.
KEY_SPACE = 20_000
# Draws are computed modulo this prime; products of two residues fit a BIGINT.
PRIME = 2147483647


def salt(name: str, seed: int) -> int:
    return zlib.crc32(f"{seed}/{name}".encode()) % PRIME


def numbered(rows: DataFrame, row: str, seed: int) -> DataFrame:
    """``__row`` and two hashes of it that all draws of the row are combined from.

    Row ids must not be negative.
    """
    number = F.col(row).cast("bigint")
    folded = (number % PRIME + F.call_function("div", number, F.lit(PRIME)) * 7919
              + salt("row", seed)) % PRIME
    first = rows.select(number.alias("__row"), folded.alias("__f"),
                        ((folded * 48271 + 11) % PRIME).alias("__m"))
    second = first.select("__row", "__f", ((F.col("__m") * F.col("__m") + F.col("__f")) % PRIME).alias("__a"))
    mixed = (F.col("__a") * 69621 + F.col("__f")) % PRIME
    return second.select("__row", "__a", ((mixed * mixed + F.col("__a")) % PRIME).alias("__b"))


def draw(name: str, seed: int) -> Column:
    """A pseudo-random BIGINT in [0, PRIME) for a column name, on ``numbered`` rows.

    Any two columns are different linear forms of two hashes, hence pairwise independent.
    """
    return (F.col("__a") * salt(name, seed) + F.col("__b")) % PRIME


def _one_of(values: Sequence[str], drawn: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (drawn % len(values) + 1).cast("int"))


def _after(start: datetime, seconds: Column, text_format: str) -> Column:
    """``start`` plus some seconds as text, the same in every session time zone."""
    base = F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return F.date_format(F.timestamp_add("SECOND", seconds.cast("int"), base), text_format)


def iso_countries(spark: SparkSession) -> list[str]:
    """Two-letter country codes known to the Java runtime."""
    return sorted(spark._jvm.java.util.Locale.getISOCountries())


def iso_currencies(spark: SparkSession) -> list[str]:
    """Three-letter currency codes known to the Java runtime."""
    return sorted(c.getCurrencyCode()
                  for c in spark._jvm.java.util.Currency.getAvailableCurrencies())


def account_schema() -> StructType:
    def kind(rule):
        if isinstance(rule, tuple) and rule[0] == "int":
            return LongType()
        return {"boolean": BooleanType(), "number": DoubleType()}.get(rule, StringType())
    return StructType([StructField(name, kind(rule)) for name, rule in ACCOUNT_FIELDS])


def accounts(rows: DataFrame, row: str, now: datetime, seed: int = 0,
             countries: Sequence[str] | None = None,
             currencies: Sequence[str] | None = None) -> DataFrame:
    """One loan account per row of ``rows``, whose BIGINT column ``row`` is its number."""
    spark = rows.sparkSession
    countries = countries or iso_countries(spark)
    currencies = currencies or iso_currencies(spark)
    earliest = now - timedelta(days=DATE_BACK_DAYS)

    def value(name, rule) -> Column:
        drawn = draw(name, seed)
        if rule == "id":
            return F.col("__row").cast("string")
        if rule == "now":
            return F.lit(now.strftime("%Y-%m-%dT%H:%M:%SZ"))
        if rule == "date":
            return _after(earliest, drawn % (DATE_SPAN_DAYS * 86400), DATE_TIME_FORMAT)
        if rule == "word":
            return _one_of(WORDS, drawn)
        if rule == "text":
            return F.concat_ws(" ", _one_of(WORDS, drawn), _one_of(WORDS, F.floor(drawn / 1000)))
        if rule == "boolean":
            return drawn % 2 == 1
        if rule == "number":
            return (drawn % NUMBER_STEPS) / F.lit(100.0)
        if rule == "country":
            return _one_of(countries, drawn)
        if rule == "currency":
            return _one_of(currencies, drawn)
        if rule[0] == "enum":
            return _one_of(rule[1], drawn)
        _, low, high = rule
        return low + drawn % (high - low)

    return numbered(rows, row, seed).select(
        *[value(name, rule).alias(name) for name, rule in ACCOUNT_FIELDS])


def write_account_batches(spark: SparkSession, path: str, batches: int, records: int,
                          now: datetime, seed: int = 0) -> None:
    """JSON lines, one folder per batch; account ids restart at 0 in each batch."""
    rows = spark.range(batches * records).select(
        F.floor(F.col("id") / records).alias("batch"), F.col("id").alias("row"))
    made = accounts(rows.select("row"), "row", now, seed)
    made = made.withColumn("batch", F.floor(F.col("id").cast("bigint") / records))
    made = made.withColumn("id", (F.col("id").cast("bigint") % records).cast("string"))
    made.write.partitionBy("batch").mode("overwrite").json(path)


def treatment_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TREATMENTS), "id long, accounting_treatment string")


def _operation(drawn: Column) -> Column:
    drawn, below, column = drawn % sum(w for _, w in OPERATIONS), 0, None
    for name, weight in OPERATIONS:
        below += weight
        branch = (drawn < below, F.lit(name).cast("string"))
        column = F.when(*branch) if column is None else column.when(*branch)
    return column


def _this_month(drawn: Column, now: datetime) -> Column:
    start = now.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    span = max(1, int((now - start).total_seconds()))
    return _after(start, drawn % span, CHANGE_TIME_FORMAT)


def _key_text(key: Column, seed: int) -> Column:
    """A stable id in UUID form for a key number."""
    digest = F.md5(F.concat(F.lit(f"{seed}/"), key.cast("string")))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def customer_changes(rows: DataFrame, row: str, now: datetime, seed: int = 0,
                     key_space: int = KEY_SPACE) -> DataFrame:
    """One customer change per row. Ids repeat within ``key_space``, so updates and deletes meet
    earlier records of the same customer."""
    def drawn(name: str) -> Column:
        return draw(name, seed)

    first, last = _one_of(FIRST_NAMES, drawn("firstname")), _one_of(LAST_NAMES, drawn("lastname"))
    street = F.concat_ws(" ", (drawn("street_no") % 999 + 1).cast("string"),
                         F.initcap(_one_of(WORDS, drawn("street"))), F.lit("Road"))
    return numbered(rows, row, seed).select(
        _key_text(drawn("key") % key_space, seed).alias("id"),
        first.alias("firstname"), last.alias("lastname"),
        F.lower(F.concat(first, F.lit("."), last, F.lit("@"), _one_of(WORDS, drawn("email")),
                         F.lit(".example"))).alias("email"),
        street.alias("address"),
        _operation(drawn("operation")).alias("operation"),
        _this_month(drawn("operation_date"), now).alias("operation_date"))


def transaction_changes(rows: DataFrame, row: str, now: datetime, customers: DataFrame,
                        customer_row: str, seed: int = 0) -> DataFrame:
    """One transaction change per row that has a customer of the same row number.

    ``customers`` carries its row number as ``customer_row`` and the customer id as ``id``.
    """
    def drawn(name: str) -> Column:
        return draw(f"t_{name}", seed)

    made = numbered(rows, row, seed).select(
        "__row", _key_text(F.col("__row"), seed + 1).alias("id"),
        _this_month(drawn("transaction_date"), now).alias("transaction_date"),
        F.round(drawn("amount") / F.lit(float(PRIME)) * 1000).alias("amount"),
        F.round(drawn("item_count") / F.lit(float(PRIME)) * 10).alias("item_count"),
        _operation(drawn("operation")).alias("operation"),
        _this_month(drawn("operation_date"), now).alias("operation_date"))
    owners = customers.select(F.col(customer_row).alias("__row"), F.col("id").alias("customer_id"))
    return made.join(owners, "__row").drop("__row")


def write_change_feed(spark: SparkSession, path: str, customers: int, transactions: int,
                      now: datetime, seed: int = 0, files: tuple[int, int] = (100, 10)) -> None:
    """Customer and transaction feeds as JSON files."""
    rows = spark.range(customers)
    people = customer_changes(rows, "id", now, seed)
    people.repartition(files[0]).write.mode("overwrite").json(f"{path}/customers")
    owners = numbered(rows, "id", seed).select(
        F.col("__row").alias("row"), _key_text(draw("key", seed) % KEY_SPACE, seed).alias("id"))
    deals = transaction_changes(spark.range(transactions), "id", now, owners, "row", seed)
    deals.repartition(files[1]).write.mode("overwrite").json(f"{path}/transactions")
