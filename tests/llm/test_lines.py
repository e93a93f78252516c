import random
from collections import defaultdict

import pytest

from tideline.llm import lines


def brute(rows, min_words):
    """Texts after deletion; a document is its id and text, in the order of ids and of the given hashes."""
    keys = sorted({k for k, _ in rows}, key=lambda k: (k[0] is not None, k[0] or 0, k[1]))
    texts = dict(rows)
    where = defaultdict(list)
    split = {k: texts[k].split("\n") for k in keys if texts[k] is not None}
    for order, k in enumerate(keys):
        for i, line in enumerate(split.get(k, [])):
            where[line].append((order, k, i))
    out = {}
    for order, k in enumerate(keys):
        if k not in split:
            out[k] = None
            continue
        own, gone = split[k], set()
        for i in range(len(own)):
            longest = 0
            for other, k2, j in where[own[i]]:
                if (other, j) < (order, i):
                    n = 0
                    while i + n < len(own) and j + n < len(split[k2]) and own[i + n] == split[k2][j + n]:
                        n += 1
                    longest = max(longest, n)
            if longest and sum(len(x.split()) for x in own[i:i + longest]) >= min_words:
                gone |= set(range(i, i + longest))
        out[k] = "\n".join(x for i, x in enumerate(own) if i not in gone)
    return out


def compare(spark, texts, min_words, partitions):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, copy string, line int")
    df = df.repartition(partitions)
    keyed = [((r.doc_id, r.h), r.text) for r in
             df.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()]
    expected = brute(keyed, min_words)
    got = lines.deduplicate(df, min_words=min_words)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == \
        sorted(((k[0], expected[k]) for k, _ in keyed), key=repr)


@pytest.mark.parametrize("seed, words, alphabet", [(1, 1, 3), (2, 6, 3), (3, 4, 12)])
def test_random_sequences(spark, seed, words, alphabet):
    rng = random.Random(seed)
    letters = ["l%d %s" % (i, "w " * (i % 3)) for i in range(alphabet)] + [""]
    texts = []
    for i in range(25):
        text = [rng.choice(letters) for _ in range(rng.randrange(1, 14))]
        if texts and rng.random() < 0.5:
            other = (rng.choice(texts)[1] or "").split("\n")
            at = rng.randrange(len(other))
            text[rng.randrange(len(text)):0] = other[at:at + rng.randrange(1, 12)]
        if rng.random() < 0.4:
            text.insert(rng.randrange(len(text)), f"only {i}")
        texts.append((rng.choice([i, i, i, i, None, 3]), "\n".join(text)))
    compare(spark, texts + [texts[0], texts[1], (90, None), (None, None), (91, "")], words, 3)


def test_long_copies_and_a_hot_line(spark):
    long = "\n".join(f"line {i} of a long text" for i in range(70))
    texts = [(i, "the same first line\n" + ("own %d\n" % i) + "the same last line") for i in range(300)]
    texts += [(1000 + i, long) for i in range(5)] + [(2000, "x\n" + long[200:900] + "\ny"), (3000, "a b\n" * 40)]
    compare(spark, texts, 50, 4)
    compare(spark, texts, 4, 4)


@pytest.mark.parametrize("first", [1, 2, 16])
def test_many_slices(spark, monkeypatch, first):
    """Groups of equal suffixes go on across slices."""
    monkeypatch.setattr(lines, "FIRST", first)
    rng = random.Random(first)
    long = [f"line {i % 37}" for i in range(45)]
    texts = [(i, "\n".join(long[:rng.randrange(20, 45)])) for i in range(6)]
    texts += [(10 + i, "\n".join(rng.choices(["a", "b", "a b"], k=rng.randrange(1, 9)))) for i in range(30)]
    texts += [(50 + i, "a\nb\na") for i in range(30)] + [(i, "x\n" + "\n".join(long[9:40])) for i in (None, 3)]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        compare(spark, texts, 2, 3)
    finally:
        spark.conf.unset(name)


def tables_of(spark, monkeypatch, texts):
    """Labels of the tables that are stored on the way, with their rows."""
    found = {}

    def stored(df, label, write=lines.stored):
        out = write(df, label)
        found[label] = out.count()
        return out

    monkeypatch.setattr(lines, "stored", stored)
    lines.deduplicate(spark.createDataFrame(texts, "doc_id long, text string"))
    return found


def test_short_runs_are_sorted_once(spark, monkeypatch):
    """Before, runs of 12 lines took four rounds over all places and a look at the ranks of each."""
    texts = [(i, "\n".join(f"line {j} of words" for j in range(i, i + 12))) for i in range(20)]
    found = tables_of(spark, monkeypatch, texts)
    assert found["places"] == found["prefixes"] == 20 * 12 - 2
    assert not [x for x in found if x.startswith("pairs-")] and "prefixes-1" not in found


def test_rounds_keep_long_runs_only(spark, monkeypatch):
    texts = [(i, "\n".join(["hot"] * 3)) for i in range(200)] + [(300 + i, "\n".join(f"l{j}" for j in range(40))) for i in range(2)]
    found = tables_of(spark, monkeypatch, texts)
    assert found["places"] == 680
    assert {x: n for x, n in found.items() if x.startswith("pairs-")} == {"pairs-16": 50, "pairs-32": 18}


def test_clashing_columns(spark):
    text = "\n".join(f"line {i} of words" for i in range(30))
    df = spark.createDataFrame([(1, text, "x", 1, 2), (2, text, "y", 3, 4)],
                               "doc_id long, text string, __hash string, __doc int, __runs int")
    got = {r.doc_id: r for r in lines.deduplicate(df).collect()}
    assert got[1].text == text and got[2].text == "" and got[2]["__hash"] == "y" and got[2]["__runs"] == 4


def test_nothing_repeats_and_empty(spark):
    compare(spark, [(1, "a\nb"), (2, "c")], 1, 1)
    assert lines.deduplicate(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    keyed = [((r.doc_id, r.h), r.text) for r in docs.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()]
    expected = brute(keyed, lines.MIN_WORDS)
    got = lines.op9_lines(spark, folder)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == {k[0]: t for k, t in expected.items()}
