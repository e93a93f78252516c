import zlib

import numpy as np
import pytest

from tideline.llm import quality


@pytest.mark.parametrize("size", [0, 1, 7, 1023, 1024, 1025, 5000])
def test_every_window_is_in_a_chunk(size):
    text = "".join(chr(97 + i % 26) for i in range(size))
    chunks = quality.chunks_of(text)
    assert len(chunks) == 1 + max(0, -(-(size - quality.CHUNK) // (quality.CHUNK - quality.WIDTH + quality.STEP)))
    net = quality.Network.initial(np.random.default_rng(0))
    seen = {w.tobytes() for w in net.windows(chunks).reshape(-1, quality.WIDTH * quality.EMBEDDED)}
    raw = np.frombuffer(text.encode(), np.uint8)
    for at in range(0, size - quality.WIDTH + 1, quality.STEP):
        assert net.weights["embed"][raw[at:at + quality.WIDTH]].tobytes() in seen


def test_held_out_accuracy_and_nulls(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    net = quality.train(docs, labels)
    odd = spark.createDataFrame([(None, None, 1.0), (5, "", 2.0), (5, "", 2.0), (6, "Xx!! " * 40_000, 1.0)],
                                "doc_id long, text string, old double")
    out = quality.score(odd, net).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
    got = {r.doc_id: r for r in quality.op5_quality(spark, folder).collect()}
    assert len(got) == docs.count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert r.predicted == (r.score >= 0.3)
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([q == r.predicted for q, r in held]) >= 0.9
    assert np.mean([r.predicted for q, r in held if q == 1]) >= 0.97
    # Scoring rows one at a time gives the same scores.
    some = docs.limit(20).collect()
    alone = [net.scores([r.text])[0] for r in some]
    assert np.allclose(alone, [got[r.doc_id].score for r in some], atol=1e-4)


@pytest.mark.parametrize("rows, expected", [([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (None, 1), (2, None)], 0.0)])
def test_too_few_labels(spark, rows, expected):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    net = quality.train(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
    assert [r.score for r in quality.score(docs, net).collect()] == [expected] * 2


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    net = quality.Network.initial(np.random.default_rng(0))
    assert quality.score(docs, net).collect() == []
