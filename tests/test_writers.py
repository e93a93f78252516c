import glob
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tideline.operators.quality import expect_or_drop, expect_or_fail
from tideline.plans import retail
from tideline.spec import Dataset
from tideline.streaming import catalog, paths, writers


def test_refresh_replaces_and_a_failed_refresh_keeps_the_old_version(spark, root):
    dataset = Dataset("t", rules=(expect_or_fail("positive", "n > 0"),))
    path = f"{root}/t"
    writers.write_live_table(spark.createDataFrame([(1,)], "n int"), path, dataset)
    writers.write_live_table(spark.createDataFrame([(2,), (3,)], "n int"), path, dataset)
    assert rows(writers.read_snapshot(spark, path)) == [(2,), (3,)]
    with pytest.raises(Exception, match="positive"):
        writers.write_live_table(spark.createDataFrame([(-1,)], "n int"), path, dataset)
    assert rows(writers.read_snapshot(spark, path)) == [(2,), (3,)]
    paths.drop_versions_before(spark, path, 1)
    assert paths.committed_versions(spark, path) == [1]


def test_failed_stream_writes_no_row(spark, root):
    spark.createDataFrame([(1,), (-1,)], "n int").coalesce(1).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("n int").parquet(f"{root}/in")
    dataset = Dataset("t", rules=(expect_or_fail("positive", "n > 0"),))
    with pytest.raises(Exception, match="positive"):
        writers.write_streaming_table(stream, f"{root}/t", f"{root}/ck", dataset)
    assert writers.read_snapshot(spark, f"{root}/t").count() == 0


def test_stream_counts_every_batch(spark, root):
    for n in range(3):
        spark.createDataFrame([(n,), (n - 2,)], "n int").coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema("n int").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    dataset = Dataset("t", rules=(expect_or_drop("not negative", "n >= 0"),))
    progress = writers.write_streaming_table(stream, f"{root}/t", f"{root}/ck", dataset)
    assert len(progress) == 3
    assert sum(p.output_rows for p in progress) == 4
    assert sum(p.dropped_rows for p in progress) == 2
    assert sum(e["failed_records"] for p in progress for e in p.expectations) == 2
    assert writers.write_streaming_table(stream, f"{root}/t", f"{root}/ck", dataset) == progress
    progress.settle()
    assert writers.write_streaming_table(stream, f"{root}/t", f"{root}/ck", dataset) == []


def test_interval_trigger_returns_a_running_query(spark, root):
    spark.range(5).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("id long").parquet(f"{root}/in")
    query = writers.write_streaming_table(stream, f"{root}/t", f"{root}/ck", Dataset("t"), trigger="1 hour")
    try:
        deadline = time.time() + 60
        while query.lastProgress is None and time.time() < deadline:
            time.sleep(0.2)
        assert writers.read_snapshot(spark, f"{root}/t").count() == 5
    finally:
        query.stop()


def test_layout_partitions_and_sorts(spark, root):
    df = spark.range(1000).select((F.col("id") % 3).alias("p").cast("string"),
                                  (F.col("id") * 7919 % 1000).alias("c"), F.lit("x").alias("v"))
    dataset = Dataset("t", partition_by=("p",), cluster_by=("c",))
    writers.write_live_table(df, root, dataset)
    back = writers.read_snapshot(spark, root)
    assert back.schema["p"].dataType.typeName() == "string"
    assert rows(back, "p", "c", "v") == rows(df)
    for file in glob.glob(f"{root}/v00000000/p=*/*.parquet"):
        values = [r["c"] for r in spark.read.parquet(file).collect()]
        assert values == sorted(values)


def test_one_value_spreads_over_several_files(spark, root):
    df = spark.range(20000).select(F.lit("only").alias("c"), F.col("id"))
    laid = writers.lay_out(df, Dataset("t", cluster_by=("c",)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["n"] for r in laid.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 5000


def test_shape_checks_declared_columns(spark):
    dataset = Dataset("t", schema="a INT, day INT", generated={"day": "dayofweek(d)"})
    df = spark.sql("SELECT '7' AS a, DATE'2024-01-07' AS d")
    assert rows(dataset.shape(df)) == [(7, 1)]
    with pytest.raises(ValueError, match="no column a"):
        dataset.shape(df.drop("a"))
    with pytest.raises(ValueError, match="no column z"):
        Dataset("t", cluster_by=("z",)).shape(df)


def test_live_table_is_not_a_stream(spark, root):
    writers.write_live_table(spark.range(3), root, Dataset("t"))
    with pytest.raises(ValueError):
        writers.read_stream(spark, root)


def test_streamed_aggregate_equals_batch(spark, root):
    rng = random.Random(1)
    schema = ("city string, order_date date, customer_id string, customer_name string, "
              "ordered_products array<struct<curr: string, price: bigint, qty: bigint>>")
    for _ in range(3):
        orders = [(rng.choice(["LA", "CH"]), None, str(rng.randrange(3)), "n",
                   rng.choice([None, [], [("USD", rng.randrange(9), 1), ("EUR", 2, 2)]])) for _ in range(20)]
        spark.createDataFrame(orders, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    writers.write_stream_aggregate(retail.sales_by_city(stream, "LA"), f"{root}/t", f"{root}/ck", Dataset("t"))
    batch = retail.sales_by_city(spark.read.parquet(f"{root}/in"), "LA")
    assert rows(writers.read_snapshot(spark, f"{root}/t")) == rows(batch)
    assert paths.latest_version(spark, f"{root}/t") == 2


@pytest.mark.parametrize("by", [(), ("p",)])
def test_a_streaming_table_is_laid_out_batch_by_batch(spark, root, by):
    for n in range(3):
        (spark.range(1000).select(F.lit(n).alias("batch"), (F.col("id") % 3).cast("string").alias("p"),
                                  (F.col("id") * 7919 % 1000).alias("c"))
         .coalesce(1).write.mode("append").parquet(f"{root}/in"))
    source = spark.read.parquet(f"{root}/in")
    stream = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    dataset = Dataset("t", partition_by=by, cluster_by=("c",), rules=(expect_or_drop("small", "c < 900"),))
    progress = writers.write_streaming_table(stream, f"{root}/t", f"{root}/ck", dataset)
    # A range sort reads its input twice; rows are counted once.
    assert [(p.output_rows, p.dropped_rows) for p in progress] == [(900, 100)] * 3
    back = writers.read_snapshot(spark, f"{root}/t")
    assert rows(back, "batch", "p", "c") == rows(source.where("c < 900"), "batch", "p", "c")
    assert back.schema["p"].dataType.typeName() == "string"
    files = glob.glob(f"{root}/t/**/*.parquet", recursive=True)
    for file in files:
        values = [r["c"] for r in spark.read.parquet(file).collect()]
        assert values == sorted(values)
    follow = writers.read_stream(spark, f"{root}/t", max_files=2)
    writers.write_streaming_table(follow, f"{root}/u", f"{root}/uk", Dataset("u"))
    assert rows(writers.read_snapshot(spark, f"{root}/u"), "batch", "p", "c") == rows(back, "batch", "p", "c")


def test_a_clustered_live_table_counts_rows_once(spark, root):
    df = spark.range(1000).withColumn("c", F.col("id") * 7919 % 1000)
    dataset = Dataset("t", cluster_by=("c",), rules=(expect_or_drop("small", "c < 900"),))
    progress = writers.write_live_table(df, root, dataset)
    assert (progress.output_rows, progress.dropped_rows) == (900, 100)


def test_counters_of_a_killed_run_are_found_by_the_next(spark, root, monkeypatch):
    for n in range(4):
        spark.createDataFrame([(n,), (n - 2,)], "n int").coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema("n int").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    dataset = Dataset("t", rules=(expect_or_drop("not negative", "n >= 0"),))
    whole = writers._append_batch

    def killed(when):
        def append(batch, batch_id, *rest):
            if when == "before" and batch_id == 2:
                raise RuntimeError("killed")
            whole(batch, batch_id, *rest)
            if when == "after" and batch_id == 2:
                raise RuntimeError("killed")
        return append

    for when in ("before", "after"):
        monkeypatch.setattr(writers, "_append_batch", killed(when))
        with pytest.raises(Exception):
            writers.write_streaming_table(stream, f"{root}/{when}", f"{root}/{when}_ck", dataset)
        monkeypatch.setattr(writers, "_append_batch", whole)
        progress = writers.write_streaming_table(stream, f"{root}/{when}", f"{root}/{when}_ck", dataset)
        assert [p.batch_id for p in progress] == [0, 1, 2, 3]
        assert sum(p.output_rows for p in progress) == 6 and sum(p.dropped_rows for p in progress) == 2
        assert sum(e["failed_records"] for p in progress for e in p.expectations) == 2
        assert writers.read_snapshot(spark, f"{root}/{when}").count() == 6
        progress.settle()
        assert writers.unsettled(spark, f"{root}/{when}", f"{root}/{when}_ck") == []


def test_backlog_is_what_later_batches_hold(spark, root):
    os.makedirs(f"{root}/in")
    for i, size in enumerate((10, 20, 30)):
        with open(f"{root}/in/f {i}.json", "w") as out:
            out.write('{"id": %d}'.ljust(size + 1) % i)
        os.utime(f"{root}/in/f {i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    sizes = [os.path.getsize(f"{root}/in/f {i}.json") for i in range(3)]
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).json(f"{root}/in")
    progress = writers.write_streaming_table(stream, f"{root}/t", f"{root}/ck", Dataset("t"))
    assert [p.input_bytes for p in progress] == sizes
    assert [p.backlog_bytes for p in progress] == [sizes[1] + sizes[2], sizes[2], 0]


@pytest.mark.parametrize("compact_every", [None, 2])
def test_stream_sums_equal_batch(spark, root, compact_every):
    rng = random.Random(4)
    schema = "city string, day int, price decimal(18,2), qty bigint, ratio double"
    for n in range(5):
        lines = [(rng.choice(["a", "b", None, f"c{n}"]), rng.randrange(3), rng.randrange(99), rng.choice([1, None]), 0.5)
                 for _ in range(40)]
        (spark.createDataFrame(lines, "city string, day int, price int, qty bigint, ratio double")
         .withColumn("price", F.col("price").cast("decimal(18,2)")).coalesce(1).write.mode("append").parquet(f"{root}/in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    keys, sums = ["city", "day"], ["price", "qty", "ratio"]
    dataset = Dataset("t", rules=(expect_or_drop("priced", "price > 9"),))
    for _ in range(2):
        done = writers.write_stream_sums(stream, keys, sums, f"{root}/t", f"{root}/ck", dataset,
                                         compact_every=compact_every, bucket_rows=3)
    assert done == []
    batch = spark.read.parquet(f"{root}/in").where("price > 9").groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
    got = writers.read_snapshot(spark, f"{root}/t")
    assert got.schema.simpleString() == batch.schema.simpleString() and rows(got) == rows(batch)


def test_sums_of_nothing(spark, root):
    os.makedirs(f"{root}/in")
    stream = spark.readStream.schema("k string, v long").json(f"{root}/in")
    assert writers.write_stream_sums(stream, ["k"], ["v"], f"{root}/t", f"{root}/ck", Dataset("t")) == []
    assert rows(writers.read_sums(spark, f"{root}/t")) == []


def test_a_batch_of_sums_touches_its_own_buckets(spark, root):
    store = writers.SumTable(spark, root, ["k"], ["v"], compact_every=None, bucket_rows=5)
    store.add(spark.range(60).select(F.col("id").alias("k"), F.lit(1).alias("v")), 0)
    store.compact()
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/state/**/*.parquet", recursive=True)}
    store.add(spark.createDataFrame([(7, 10)], "k long, v int"), 1)
    store.add(spark.createDataFrame([(7, 99)], "k long, v int"), 1)
    store.compact()
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/state/**/*.parquet", recursive=True)}
    assert before.items() <= after.items() and len(after) - len(before) == 1
    assert {r["k"]: r["v"] for r in store.state().collect()} == {**{k: 1 for k in range(60)}, 7: 11}


def test_sums_of_a_large_file_are_shared_out(spark, root, monkeypatch):
    spark.range(40_000).select((F.col("id") % 30_000).alias("k"), F.lit(1).alias("v")).coalesce(1).write.parquet(f"{root}/in")
    given, totals = [], writers.SumTable._totals
    monkeypatch.setattr(writers.SumTable, "_totals", lambda self, found: given.append(found) or totals(self, found))
    sizes = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    for size in sizes:
        spark.conf.set(size, "16k")
    try:
        store = writers.SumTable(spark, f"{root}/t", ["k"], ["v"], compact_every=None)
        for batch in range(2):
            store.add(spark.read.parquet(f"{root}/in"), batch)
        store.compact()
        place = F.spark_partition_id()
        assert max(r["count"] for r in given[0].groupBy(place).count().collect()) < 20_000
        # When batches are folded, all rows of a group are in one task.
        assert given[2].withColumn("p", place).groupBy("k").agg(F.count_distinct("p").alias("n")).where("n > 1").count() == 0
    finally:
        for size in sizes:
            spark.conf.unset(size)
    assert rows(store.state().agg(F.count("k"), F.sum("v"), F.max("v"))) == [(30_000, 80_000, 4)]


def test_catalog_names_follow_refreshes(spark, root):
    for by in ((), ("p",)):
        dataset, path = Dataset("t", partition_by=by), f"{root}/{len(by)}"
        for n in (3, 5):
            df = spark.range(n).select("id", (F.col("id") % 2).cast("string").alias("p"))
            catalog.refresh(df, path, dataset, "tideline_followed")
            assert rows(spark.table("tideline_followed").select("id", "p")) == rows(df)
        catalog.drop(spark, "tideline_followed")
        assert writers.read_snapshot(spark, path).count() == 5
    copy = catalog.save_managed(spark.range(4), "tideline_managed", Dataset("m", cluster_by=("id",)))
    assert copy.count() == 4 == spark.sql("SELECT * FROM tideline_managed").count()
    catalog.save_managed(spark.range(2), "tideline_managed")
    assert spark.table("tideline_managed").count() == 2
    catalog.drop(spark, "tideline_managed")
    with pytest.raises(ValueError, match="no live table"):
        catalog.register(spark, "x", f"{root}/none")


def test_counters_of_every_batch_of_a_long_stream(spark, root):
    for i in range(105):
        os.makedirs(f"{root}/in", exist_ok=True)
        with open(f"{root}/in/f{i:03d}.json", "w") as out:
            out.write('{"id": %d}' % i)
    stream = (spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).json(f"{root}/in"))
    done = writers.write_streaming_table(stream, f"{root}/t", f"{root}/ck", Dataset("counted"))
    assert len(done) == 105 and sum(p.output_rows for p in done) == 105
