from datetime import datetime

from pyspark.sql import functions as F

from helpers import rows
import synthetic

NOW = datetime(2022, 6, 15, 12, 0, 0)


def test_accounts_do_not_depend_on_partitioning(spark):
    few = synthetic.accounts(spark.range(500, numPartitions=1), "id", NOW, seed=4)
    many = synthetic.accounts(spark.range(500).repartition(7), "id", NOW, seed=4)
    assert rows(few) == rows(many)
    assert rows(few) != rows(synthetic.accounts(spark.range(500), "id", NOW, seed=5))
    assert few.schema.simpleString() == synthetic.account_schema().simpleString()


def test_account_values_stay_in_range(spark):
    made = synthetic.accounts(spark.range(5000), "id", NOW)
    low_high = made.agg(F.min("balance"), F.max("balance"), F.min("accounting_treatment_id"),
                        F.max("accounting_treatment_id"), F.min("fvh_level"), F.max("fvh_level"),
                        F.min("rate"), F.max("rate")).first()
    assert low_high[0] >= -10000 and low_high[1] < 100000
    assert (low_high[2], low_high[3], low_high[4], low_high[5]) == (0, 8, 1, 2)
    assert low_high[6] >= 0 and low_high[7] <= 4.99
    dates = made.select(F.min("end_date"), F.max("end_date")).first()
    assert "2012" <= dates[0][:4] <= dates[1][:4] <= "2052"
    lost = made.where("accounting_treatment_id > 5").count()
    assert 0.25 < lost / 5000 < 0.42


def test_batches_restart_their_ids(spark, root):
    synthetic.write_account_batches(spark, root, 3, 10, NOW)
    back = spark.read.json(root)
    assert rows(back.groupBy("batch").agg(F.count("*"), F.min(F.col("id").cast("int")))) == [(b, 10, 0) for b in range(3)]


def test_change_feed_repeats_keys_with_weighted_operations(spark):
    made = synthetic.customer_changes(spark.range(20000), "id", NOW, key_space=300)
    assert made.select("id").distinct().count() == 300
    share = {r["operation"]: r["count"] / 20000 for r in made.groupBy("operation").count().collect()}
    assert abs(share["APPEND"] - 50 / 91) < .03 and abs(share["DELETE"] - 10 / 91) < .02
    assert abs(share["UPDATE"] - 30 / 91) < .03 and 0 < share[None] < .03
    assert made.where(~F.col("operation_date").rlike(r"^06-\d\d-2022 \d\d:\d\d:\d\d$")).count() == 0


def test_transactions_follow_their_customer_row(spark):
    owners = spark.range(10).select(F.col("id").alias("row"), F.concat(F.lit("c"), "id").alias("id"))
    made = synthetic.transaction_changes(spark.range(20), "id", NOW, owners, "row")
    assert made.count() == 10
    assert rows(made, "customer_id") == [(f"c{i}",) for i in range(10)]


def test_lookup(spark):
    assert synthetic.treatment_lookup(spark).count() == 6
    assert len(synthetic.iso_countries(spark)) > 200
