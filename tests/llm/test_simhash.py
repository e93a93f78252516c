import random
import re

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from tideline.llm import common
from tideline.llm import components as graph
from tideline.llm import simhash
from tideline.llm.components import components


def brute_print(text, shingle=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    """Smallest id reachable, for (id, fingerprint) rows."""
    unique = np.array(sorted({p for _, p in prints}), np.uint64)
    root = list(range(len(unique)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(unique)):
        for j in np.flatnonzero(np.bitwise_count(unique[i] ^ unique) <= radius):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    place = {int(p): find(i) for i, p in enumerate(unique)}
    low = {}
    for i, p in prints:
        if i is not None:
            low[place[p]] = min(i, low.get(place[p], i))
    return [(i, f"{p:016x}", low.get(place[p])) for i, p in prints]


@pytest.mark.parametrize("text", ["", None, "one", "a b c", "a b c d", "a b c d e", "ÄB c\x1cd\x85e f g",
                                  "Wörd " * 700, "x y " * 70_000, "\t\x0b a \n B c D  e"])
def test_fingerprint(text):
    if text and len(text) > 100_000:
        # Two shingles in turn; the first stands once more, so its bits decide.
        assert simhash.fingerprint(text, 4) % 2**64 == xxhash.xxh64_intdigest(b"x y x y", 42)
    else:
        assert simhash.fingerprint(text, 4) % 2**64 == brute_print(text)


def test_forest_joins_what_all_links_join():
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64))
    values = np.unique(np.concatenate([seeds, np.repeat(seeds, 10) ^ flips]))
    half = len(values) // 2
    edges = [simhash.links(values[:half], None, 3), simhash.links(values[half:], None, 3),
             simhash.links(values[:half], values[half:], 3)]
    found = {int(v): {int(v)} for v in values}
    for u, v in zip(np.concatenate([e[0] for e in edges]).tolist(), np.concatenate([e[1] for e in edges]).tolist()):
        assert (u ^ v).bit_count() <= 3
        merged = found[u] | found[v]
        for x in merged:
            found[x] = merged
    expected = brute_components([(int(v), int(v)) for v in values], 3)
    assert {v: min(found[v]) for v in found} == {i: c for i, _, c in expected}


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(200, 260)] + \
        [(x, 300 + (x - 299) % 20) for x in range(300, 320)] + [(5, 5), (7, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, 7: 7, **{x: 7 for x in range(200, 260)},
                   **{x: 300 for x in range(300, 320)}}


def test_small_tiles_copies_nulls_and_repeated_rows(spark):
    rng = random.Random(1)
    words = ["w%d" % i for i in range(300)]
    rows = [(None, "a b c d", 1), (9, None, 1), (8, "", 1), (3, "solo", 1), (3, "solo", 1)]
    for i in range(60):
        text = [rng.choice(words) for _ in range(80)]
        for _ in range(rng.choice([1, 2, 5])):
            copy = list(text)
            copy[rng.randrange(80)] = "new"
            rows.append((100 + len(rows), " ".join(copy), 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int").repartition(4)
    got = [tuple(r) for r in simhash.near_duplicates(df, tile=16).collect()]
    assert sorted(got, key=repr) == sorted(brute_components([(i, brute_print(t)) for i, t, _ in rows]), key=repr)


def test_keep_one_of_each_group(spark):
    same = "one two three four five six"
    rows = [(5, same, "a"), (3, same, "b"), (3, same, "b"), (None, same, "c"), (7, "", "d"), (8, None, "e"),
            (None, "x y", "f"), (None, "x y", "f"), (9, "quite another text here", "g"), (3, "and an other one", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, bits string").repartition(3)
    got = simhash.keep_one(df, radius=0)
    assert got.columns == df.columns
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        [(3, same, "b"), (7, "", "d"), (None, "x y", "f"), (9, "quite another text here", "g"),
         (3, "and an other one", "h")], key=repr)
    assert simhash.keep_one(df.limit(0)).collect() == []


def test_clashing_columns_and_equal_rows(spark):
    rows = [(5, "one two three four five", "b", 1), (5, "one two three four five", "a", 2), (9, "one two three four five", "c", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __hash string, __id int")
    kept = [simhash.keep_one(df.repartition(n)) for n in (1, 3)]
    assert kept[0].columns == df.columns
    assert kept[0].collect() == kept[1].collect() and kept[0].first()["doc_id"] == 5 and len(kept[0].collect()) == 1


def test_a_hub_can_be_split(spark):
    hub = spark.range(1, 20000).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v"))
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        low = common.checkpointed(graph._lowest(hub))
        joined = common.checkpointed(hub).join(low, "u")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark, folder):
    texts = spark.read.parquet(f"{folder}/documents.parquet").collect()
    expected = brute_components([(r.doc_id, brute_print(r.text)) for r in texts])
    assert sorted(tuple(r) for r in simhash.op2_simhash(spark, folder).collect()) == sorted(expected)
