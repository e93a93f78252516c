import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tideline.llm import common, packing, simhash
from tideline.llm.common import vocabulary

TEXTS = ["", None, "it's We'LL ok", "a\x1cb c\x85d\xa0e", "İstanbul ΣΑΣ é é", "<|endoftext|> x<|startoftext|>",
         "日本 語", "w " * 5000, "x" * 9000, " ", "a", "a"]


def brute(text):
    ids = Tokenizer.from_file(P.path(packing.VOCABULARY)).encode(text or "", add_special_tokens=False).ids + [1]
    for n, at in enumerate(range(0, len(ids), 4096)):
        cut = ids[at:at + 4096]
        yield n, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())


def check_layout(rows, capacity=4096):
    """Sequences are gapless from 0; returns their number."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for items in by.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_pieces_equal_the_library(spark):
    df = spark.createDataFrame([(i // 2, t, 9) for i, t in enumerate(TEXTS)] + [(None, "z", 1)],
                               "doc_id long, text string, length int").repartition(3)
    rows = packing.pack(packing.tokenize(df, with_tokens=True)).collect()
    expected = sorted(((i // 2, *x) for i, t in enumerate(TEXTS) for x in brute(t)), key=repr)
    expected += [(None, *x) for x in brute("z")]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(zlib.crc32(np.array(r.tokens, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    check_layout(rows)


def test_empty(spark):
    assert packing.pack(packing.tokenize(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


@pytest.mark.parametrize("lengths", [[0], [11], [None]])
def test_bad_lengths_stop(spark, lengths):
    df = spark.createDataFrame([(x,) for x in lengths], "length long")
    with pytest.raises(Exception, match="length"):
        packing.pack(df, capacity=10).collect()


def test_plan_uses_every_piece_and_few_sequences():
    rng = random.Random(5)
    for _ in range(30):
        capacity = rng.choice([10, 97, 512])
        lengths = Counter(min(capacity, int(rng.expovariate(3 / capacity)) + 1) for _ in range(rng.choice([1, 60, 3000])))
        steps = packing.plan(dict(lengths), capacity)
        used = Counter()
        for combination, times in steps:
            assert sum(combination) <= capacity and times > 0
            for n in combination:
                used[n] += times
        assert used == lengths
        bins, least = sum(t for _, t in steps), math.ceil(sum(n * c for n, c in lengths.items()) / capacity)
        assert bins <= least * 1.1 + 1


def test_exact_complements_of_one_two_and_three():
    assert packing.plan({7: 2, 3: 1, 2: 1, 1: 1}, 10) == [((7, 3), 1), ((7, 2, 1), 1)]
    assert packing.plan({6: 1, 2: 1, 1: 2}, 10) == [((6, 2, 1, 1), 1)]
    assert packing.plan({4: 3}, 8) == [((4, 4), 1), ((4,), 1)]


def test_hot_length_over_many_partitions(spark):
    df = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 ELSE 1 + id % 50 END AS length")
    rows = packing.pack(df.repartition(13), capacity=100).collect()
    assert len(rows) == 30_000 and len({r.id for r in rows}) == 30_000
    total = sum(r.length for r in rows)
    assert check_layout(rows, 100) <= math.ceil(total / 100) + 1


def test_query(spark, folder):
    rows = packing.op1_best_fit_packing(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == Counter((i, *x) for i, t in texts.items() for x in brute(t))
    total = sum(r.length for r in rows)
    assert check_layout(rows) <= math.ceil(total / 4096) + 1


def test_other_operators_free_the_words(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    steps = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, step, schema: steps.append(step) or self)
    simhash.fingerprints(docs)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["some words"]})
    for step in steps:
        assert len(list(packing._pieces(iter([batch]), vocabulary(packing.VOCABULARY), 4096, 1, False))) == 1
        assert len(common._kept) == 1
        assert list(step(iter([]))) == [] and not common._kept


def test_plain_words_are_encoded_as_the_tokenizer_does():
    raw = vocabulary(packing.VOCABULARY)
    words = packing._Words(raw)
    assert words.plain.able
    shown = [chr(c) for c in range(0x21, 0x250)]
    tried = [a + b for a in shown for b in shown[::9]] + [
        "don't", "I'll", "İstanbul", "x\u0301y", "\u65e5\u672c", "\u212b", "a1b22c", "e-mail@x.org", "...", "THE***", "\ufb01n", "Ǆ"]
    sizes, values = words.encode_words(tried)
    expected = [e.ids for e in words.tokenizer.encode_batch_fast(tried, add_special_tokens=False)]
    assert sizes.tolist() == [len(ids) for ids in expected]
    assert values.tolist() == [i for ids in expected for i in ids]
    assert words.encode_words([])[0].tolist() == []
