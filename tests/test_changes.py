import glob
import itertools
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tideline.functions.parsing import change_time
from tideline.operators import changes as ch
from tideline.streaming.change_target import ChangeTarget, apply_changes
from tideline.streaming.folded import BUCKET as ch_bucket

FEED = "id string, operation string, value string, at long"


def spec(scd_type=1, **more):
    return ch.ChangeSpec(keys=("id",), sequence_by="at", apply_as_deletes="operation = 'DELETE'",
                         except_columns=("operation", "at"), scd_type=scd_type, **more)


def target(spark, root, batches, options, **more):
    made = ChangeTarget(spark, root, options, **more)
    for number, batch in enumerate(batches):
        made.apply(spark.createDataFrame(batch, FEED), number)
    return made


def one_by_one(records):
    return [[r] for r in records]


APPEND1, UPDATE2, UPDATE3 = ("a", "APPEND", "v1", 1), ("a", "UPDATE", "v2", 2), ("a", "UPDATE", "v3", 3)
DELETE3, APPEND4 = ("a", "DELETE", None, 3), ("a", "APPEND", "v4", 4)


@pytest.mark.parametrize("records, expected", [
    ([APPEND1, UPDATE3, UPDATE2], [("a", "v3")]),
    ([APPEND1, DELETE3, UPDATE2], []),
    ([DELETE3, APPEND4], [("a", "v4")]),
])
def test_type1_golden(spark, root, records, expected):
    assert rows(target(spark, root, one_by_one(records), spec()).read()) == expected


@pytest.mark.parametrize("records, expected", [
    ([APPEND1, UPDATE3, UPDATE2], [("a", "v1", 1, 2), ("a", "v2", 2, 3), ("a", "v3", 3, None)]),
    ([APPEND1, ("a", "DELETE", None, 2), APPEND4], [("a", "v1", 1, 2), ("a", "v4", 4, None)]),
])
def test_type2_golden(spark, root, records, expected):
    assert rows(target(spark, root, one_by_one(records), spec(2)).read()) == expected


def test_replayed_batch_changes_nothing(spark, root):
    made = target(spark, root, one_by_one([APPEND1, UPDATE3, UPDATE2]), spec(2))
    before = rows(made.read())
    made.apply(spark.createDataFrame([("b", "APPEND", "other", 9)], FEED), 1)
    assert rows(made.read()) == before
    made.compact()
    made.apply(spark.createDataFrame([("b", "APPEND", "other", 9)], FEED), 1)
    assert rows(made.read()) == before


def test_delete_wins_a_tie(spark, root):
    made = target(spark, root, [[APPEND1, ("a", "DELETE", None, 1)]], spec())
    assert rows(made.read()) == []
    history = target(spark, f"{root}/2", [[APPEND1], [("a", "DELETE", None, 1)]], spec(2))
    assert rows(history.read()) == []


def test_missing_sequence_stops_the_update(spark, root):
    with pytest.raises(Exception, match="without a sequence"):
        target(spark, root, [[("a", "APPEND", "v", None)]], spec())


def test_sequence_text_orders_across_years(spark, root):
    feed = spark.createDataFrame(
        [("a", "APPEND", "old", "12-31-2022 00:00:00"), ("a", "UPDATE", "new", "01-01-2023 00:00:00")],
        "id string, operation string, value string, operation_date string")
    made = ChangeTarget(spark, root, ch.ChangeSpec(
        keys=("id",), sequence_by=change_time("operation_date"), except_columns=("operation", "operation_date")))
    made.apply(feed, 0)
    assert rows(made.read()) == [("a", "new")]


def test_tracked_columns_decide_versions(spark, root):
    schema = "id string, operation string, city string, note string, at long"
    feed = spark.createDataFrame([
        ("a", "APPEND", "x", "n1", 1), ("a", "UPDATE", "x", "n2", 2), ("a", "UPDATE", "y", "n3", 3),
        ("a", "DELETE", None, None, 4), ("a", "APPEND", "y", "n5", 5), ("a", "UPDATE", "y", "n6", 6)], schema)
    made = ChangeTarget(spark, root, spec(2, track_history=("city",)))
    made.apply(feed, 0)
    assert rows(made.read()) == [
        ("a", "x", "n2", 1, 3), ("a", "y", "n3", 3, 4), ("a", "y", "n6", 5, None)]


def brute_force(records, tracked):
    """Versions per key, computed record by record."""
    latest = {}
    for key, operation, value, at in records:
        candidate = (operation == "DELETE", operation, value)
        if (key, at) not in latest or candidate[0]:
            latest[key, at] = candidate
    found = []
    for key, group in itertools.groupby(sorted(latest.items()), key=lambda item: item[0][0]):
        open_version = None
        for (_, at), (gone, _, value) in group:
            if tracked and open_version and not gone and open_version[1] % 3 == value % 3:
                open_version = (open_version[0], value)
                continue
            if open_version:
                found.append((key, open_version[1], open_version[0], at))
            open_version = None if gone else (at, value)
        if open_version:
            found.append((key, open_version[1], open_version[0], None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("tracked", [False, True])
@pytest.mark.parametrize("min_hot_rows", [10, 10**9])
def test_random_feed_in_shuffled_batches(spark, root, tracked, min_hot_rows):
    rng = random.Random(7)
    records, seen = [], set()
    for _ in range(1500):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}"
        at = rng.randrange(4000)
        if (key, at) in seen:
            continue
        seen.add((key, at))
        operation = "DELETE" if rng.random() < 0.15 else "UPDATE"
        records.append((key, operation, rng.randrange(9), at))
    schema = "id string, operation string, value int, at long"
    options = ch.ChangeSpec(keys=("id",), sequence_by="at", apply_as_deletes="operation = 'DELETE'",
                            except_columns=("operation", "at"), scd_type=2, min_hot_rows=min_hot_rows,
                            track_history=("third",) if tracked else None)
    shuffled = records[:]
    rng.shuffle(shuffled)
    made = ChangeTarget(spark, root, options, compact_every=2)
    for number in range(3):
        batch = spark.createDataFrame(shuffled[number * 500:(number + 1) * 500] + shuffled[:20], schema)
        made.apply(batch.withColumn("third", F.col("value") % 3), number)
    got = rows(made.read(), "id", "value", ch.START, ch.END)
    assert got == brute_force(records, tracked)


def test_type1_is_the_open_part_of_type2(spark, root):
    rng = random.Random(3)
    records = [(f"k{rng.randrange(12)}", rng.choice(["UPDATE", "DELETE"]), str(i), i) for i in range(300)]
    rng.shuffle(records)
    batches = [records[:100], records[100:150], records[150:]]
    current = target(spark, f"{root}/1", batches, spec(1)).read()
    history = target(spark, f"{root}/2", batches, spec(2)).read()
    open_rows = history.where(f"{ch.END} IS NULL").drop(ch.START, ch.END)
    assert rows(current) == rows(open_rows)


def test_struct_sequence(spark, root):
    start = datetime(2024, 1, 1)
    feed = spark.createDataFrame(
        [("a", start, 1, "x"), ("a", start, 2, "y"), ("a", start + timedelta(1), 0, "z")],
        "id string, ts timestamp, n int, value string")
    made = ChangeTarget(spark, root, ch.ChangeSpec(
        keys=("id",), sequence_by=F.struct("ts", "n"), scd_type=2, min_hot_rows=1))
    made.apply(feed, 0)
    assert [r[3] for r in rows(made.read().orderBy(ch.START))] == ["x", "y", "z"]


def test_stream_of_files_equals_batch(spark, root):
    rng = random.Random(5)
    records = [(f"k{rng.randrange(10)}", rng.choice(["APPEND", "UPDATE", "DELETE"]), str(i), i) for i in range(120)]
    rng.shuffle(records)
    for part in range(4):
        (spark.createDataFrame(records[part * 30:(part + 1) * 30], FEED).coalesce(1)
         .write.mode("append").json(f"{root}/feed"))
    stream = spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).json(f"{root}/feed")
    common = dict(keys=["id"], sequence_by="at", apply_as_deletes="operation = 'DELETE'",
                  except_column_list=["operation", "at"])
    for scd_type in (1, 2):
        streamed = apply_changes(spark, f"{root}/s{scd_type}", stream, f"{root}/c{scd_type}",
                                 stored_as_scd_type=scd_type, compact_every=3, **common)
        whole = target(spark, f"{root}/b{scd_type}", [records], spec(scd_type))
        assert rows(streamed.read()) == rows(whole.read())
        streamed.clean_up()
        assert rows(streamed.read()) == rows(whole.read())


def test_only_changed_keys_are_recomputed(spark, root):
    made = target(spark, root, [[APPEND1, ("b", "APPEND", "w", 1)]], spec(2))
    made.compact()
    made.apply(spark.createDataFrame([UPDATE2], FEED), 1)
    plan = made.read()._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    assert rows(made.read()) == [("a", "v1", 1, 2), ("a", "v2", 2, None), ("b", "w", 1, None)]


def state_files(root):
    return {path: os.path.getmtime(path) for path in glob.glob(f"{root}/state/**/*.parquet", recursive=True)}


@pytest.mark.parametrize("scd_type", [1, 2])
def test_a_fold_leaves_untouched_buckets_alone(spark, root, scd_type):
    feed = [(f"k{i}", "APPEND", "v", 1) for i in range(40)]
    made = target(spark, root, [feed], spec(scd_type), bucket_rows=5)
    made.compact()
    before = state_files(root)
    held = made.manifest()["held"]
    assert len(held) == made.manifest()["buckets"] == 8 and sum(n for _, n in held.values()) == 40
    made.apply(spark.createDataFrame([("k1", "UPDATE", "w", 2)], FEED), 1)
    read = made.read()
    expected = rows(read)
    # The plan reads each bucket's files at most where they are needed: one bucket is folded.
    made.compact()
    after = state_files(root)
    assert all(after[path] == time for path, time in before.items())
    assert len({path.split(f"{ch_bucket}=")[1].split("/")[0] for path in after.keys() - before.keys()}) == 1
    assert sum(v == 1 for v, _ in made.manifest()["held"].values()) == 1
    assert rows(made.read()) == expected and len(expected) == 39 + scd_type
    made.clean_up()
    assert rows(made.read()) == expected and len(state_files(root)) < len(after)


def test_buckets_follow_the_rows(spark, root):
    made = target(spark, root, [[(f"k{i}", "APPEND", "v", 1) for i in range(10)]], spec(), bucket_rows=10)
    made.compact()
    assert made.manifest()["buckets"] == 1
    for batch in range(1, 5):
        feed = [(f"k{batch * 10 + i}", "APPEND", "v", 1) for i in range(10)]
        made.apply(spark.createDataFrame(feed, FEED), batch)
        made.compact()
    assert made.manifest()["buckets"] == 5
    made.clean_up()
    assert rows(made.read()) == sorted((f"k{i}", "v") for i in range(50))


def test_a_fold_that_broke_off_is_done_again(spark, root):
    made = target(spark, root, [[APPEND1, ("b", "APPEND", "w", 1)]], spec(2))
    made.compact()
    made.apply(spark.createDataFrame([UPDATE2], FEED), 1)
    expected = rows(made.read())
    # Files of a fold whose manifest was never written.
    spark.createDataFrame([("x", 0)], f"id string, {ch_bucket} int").write.partitionBy(ch_bucket).parquet(
        f"{root}/state/v00000001")
    assert rows(made.read()) == expected
    made.compact()
    assert rows(made.read()) == expected and made.folded_version() == 1


def test_batches_are_trimmed_before_the_shuffle(spark):
    stamped = ch.stamp_changes(spark.createDataFrame([APPEND1], FEED), spec())
    for reduced in (ch.latest_changes(stamped, spec()), ch.distinct_changes(stamped, spec())):
        plan = reduced._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_bad_options_are_rejected():
    with pytest.raises(ValueError):
        spec(3)
    with pytest.raises(ValueError):
        spec(1, track_history=("value",))


def test_missing_key_stops(spark):
    spec = ch.ChangeSpec(("k",), "s")
    feed = spark.createDataFrame([(None, 1)], "k string, s int")
    with pytest.raises(Exception, match="without a key"):
        ch.stamp_changes(feed, spec).collect()


@pytest.mark.parametrize("kind", ["string", "struct<day: int, n: int>"])
def test_any_sorted_sequence_gives_the_same_versions_hot_and_cold(spark, kind):
    items = [("k", f"{i * 7919 % 200:04d}" if kind == "string" else (i % 3, i * 7919 % 200), i) for i in range(200)]
    feed = spark.createDataFrame(items, f"k string, s {kind}, v int")
    got = []
    for limit in (10, 1_000_000):
        spec = ch.ChangeSpec(("k",), "s", scd_type=2, min_hot_rows=limit)
        versions = ch.close_versions(ch.distinct_changes(ch.stamp_changes(feed, spec), spec), spec)
        got.append(rows(ch.visible(versions, spec)))
    assert got[0] == got[1] and len(got[0]) == 200


def test_empty_target_is_readable(spark, root):
    feed = spark.createDataFrame([], "k string, s int, v int")
    for kind in (1, 2):
        target = ChangeTarget(spark, f"{root}/t{kind}", ch.ChangeSpec(("k",), "s", scd_type=kind), feed=feed)
        assert target.read().collect() == []
