import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import topk, vectors


def brute(rows, queries, k):
    """(query_id, rank, vec_id, score) by sorting everything."""
    whole = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, v in whole:
        if queries(i):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i and len(w) == len(v))
            out |= {(i, tuple(v), r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])}
    return sorted((i, r, j, s) for i, _, r, j, s in out)


@pytest.mark.parametrize("tile, group", [(7, 20), (64, 1000)])
def test_against_brute_force(spark, monkeypatch, tile, group):
    monkeypatch.setattr(vectors, "TILE_ROWS", tile)
    monkeypatch.setattr(vectors, "QUERY_ROWS", 3)
    monkeypatch.setattr(vectors, "GROUP_ROWS", group)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=20).round(1)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(10)] + [(5, [0.5] * 20), (0, [1.0] * 20), (0, [1.0] * 20)]
    rows += [(300, None), (301, []), (302, [1.0, None]), (303, [float("nan")] * 20), (304, [float("inf")] * 20),
             (None, [1.0] * 20), (310, [1.0, 2.0]), (311, [2.0, -1.0]), (320, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).repartition(5)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k=4, id_col="vec_id").collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, lambda i: i % 10 == 0, 4)


def test_pruning_keeps_the_best():
    rng = np.random.default_rng(9)
    q, c = np.floor(256 * rng.normal(size=(64, 30))), np.floor(256 * rng.normal(size=(64, 5000)))
    c[:, 100:130] = q + rng.integers(-40, 40, q.shape)
    at, to, score = topk.products(5)(q, np.arange(30), c, np.arange(30, 5030), np.full(30, -np.inf))
    full = q.T @ c
    assert (full[at, to] == score).all()
    for i in range(30):
        assert set(np.argsort(-full[i])[:5]) <= set(to[at == i])
    assert len(at) < 0.2 * full.size


def large_rows(rng):
    rows = [(i, [float(x) for x in rng.normal(size=6) * 10.0 ** rng.integers(-2, 14)]) for i in range(60)]
    rows += [(60 + i, [float(x) for x in rng.normal(size=6) * 10.0 ** rng.integers(0, 300)]) for i in range(30)]
    # Products that differ by less than a double can tell, copies, the ends of a long, and what scaling makes infinite.
    rows += [(100 + i, [2.0**45 + i, 1.0, 0.0, 0.0, 0.0, 2.0**-8]) for i in range(8)]
    rows += [(110 + i, rows[70][1]) for i in range(9)]
    return rows + [(120, [2.0**55, 0.0, 0.0, 0.0, 0.0, 0.0]), (121, [-1.0, 0.0, 0.0, 0.0, 0.0, 0.0]),
                   (122, [0.0] * 6), (130, [1.7e308] + [0.0] * 5)]


@pytest.mark.parametrize("tile, group", [(7, 20), (1000, 1000)])
def test_products_of_any_size(spark, monkeypatch, tile, group):
    monkeypatch.setattr(vectors, "TILE_ROWS", tile)
    monkeypatch.setattr(vectors, "GROUP_ROWS", group)
    rows = large_rows(np.random.default_rng(6))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k=5).collect()
    wanted = brute([r for r in rows if r[0] != 130], lambda i: i % 10 == 0, 5)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [
        (q, rank, i, min(max(score, -2**63), 2**63 - 1)) for q, rank, i, score in wanted]


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 50 == 0).collect() == []


def test_query(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    assert sorted(tuple(r) for r in topk.op6_top_k(spark, folder).collect()) == sorted(con.execute(topk.ORACLE_SQL).fetchall())
