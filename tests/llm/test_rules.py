import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import rules

WORD = re.compile("[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t\r\n", "one", "a b c d e f g h i j", "a b c d e f a b c d e f", "x y\nx y\n\nx y \n x y\nx y",
         "a a a a a a", "# * $ % & | < >", "é ü ß\nÉ ü", "a\x0bb\x0cc\x1cd", "l1\n\n\n", "MENU | HOME | LOGIN\n" * 3,
         "The river ran past the old mill and on to the sea. It was late.\nBUY!! NOW!! CHEAP!! DEALS!!\nWe walked home.",
         "one two three four five six one two three four five " * 3, "w " * 20_000, "long" * 50_000 + " z"]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


def field_of(rng):
    return rules.Field(rng.normal(size=(len(rules.FEATURES), 2)), rng.normal(size=(2, 2)), rng.normal(size=2))


def scores(field, features, states):
    emitted = features @ field.weights
    total = field.first[states[0]] + sum(emitted[i, s] for i, s in enumerate(states))
    return total + sum(field.moves[a, b] for a, b in zip(states, states[1:]))


def test_counts_against_brute_force():
    for together in (TEXTS, TEXTS[::-1], *[[t] for t in TEXTS]):
        seen = rules.look(together)
        for i, text in enumerate(together):
            assert tuple(seen.counts[c][i] for c in rules.COUNTS) == brute(text)[:5], (text or "")[:50]
        lines = [n for t in together for n, line in enumerate((t or "").split("\n")) if WORD.search(line)]
        assert seen.places.tolist() == lines and len(seen.features) == len(lines)


def test_features_do_not_depend_on_neighbours():
    together = rules.look(TEXTS)
    alone = [rules.look([t]) for t in TEXTS]
    assert np.array_equal(together.features, np.concatenate([a.features for a in alone]))


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    sizes = np.array([3, 0, 7, 1, 5])
    features = rng.normal(size=(sizes.sum(), len(rules.FEATURES)))
    for _ in range(10):
        field = field_of(rng)
        got, at = field.decode(features, sizes), 0
        for n in sizes:
            if n:
                best = max(itertools.product((0, 1), repeat=int(n)), key=lambda s: scores(field, features[at:at + n], s))
                assert got[at:at + n].tolist() == list(best)
            at += n


def test_gradient_and_likelihood_against_all_paths():
    rng = np.random.default_rng(5)
    sizes = np.array([4, 1, 3])
    features = rng.normal(size=(8, len(rules.FEATURES)))
    states = rng.integers(0, 2, 8)
    field = field_of(rng)

    def likelihood(f):
        total, at = 0.0, 0
        for n in sizes:
            paths = [scores(f, features[at:at + n], s) for s in itertools.product((0, 1), repeat=int(n))]
            total += scores(f, features[at:at + n], states[at:at + n]) - np.logaddexp.reduce(paths)
            at += n
        return total

    value, slope = field.gradient(features, sizes, states)
    assert value == pytest.approx(likelihood(field))
    for name in ("weights", "moves", "first"):
        for place in np.ndindex(getattr(field, name).shape):
            held = getattr(field, name)[place]
            getattr(field, name)[place] = held + 1e-5
            up = likelihood(field)
            getattr(field, name)[place] = held - 1e-5
            down = likelihood(field)
            getattr(field, name)[place] = held
            assert getattr(slope, name)[place] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_held_out_accuracy_on_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality IS NOT NULL")
    found = rules.op13_quality_rules(spark, folder).join(labels, "doc_id").collect()
    sample = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and not r.base_failed]
    good = [r.kept for r in sample if r.quality == 1]
    bad = [r.kept for r in sample if r.quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2 and len(good) > 20 and bad


def test_a_bad_line_among_good_ones(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    field = rules.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = docs.where("lang = 'en' AND n_chars BETWEEN 500 AND 2000 AND NOT text RLIKE '[#*$%&|<>!]'").first()["text"]
    junk = "\n".join("reo | then | heed | shand | oned | the | nd | aner | whst | inou | thes" for _ in range(3))
    mixed = spark.createDataFrame([(1, good), (2, good + "\n" + junk)], "doc_id long, text string")
    rows = {r.doc_id: r for r in rules.judge(mixed, field).collect()}
    at = len(good.split("\n"))
    assert rows[1].kept and not set(rows[1].boilerplate) & set(range(at))
    assert set(rows[2].boilerplate) == {at, at + 1, at + 2}


def test_clashing_columns_nulls_and_partitions(spark):
    rows = [(i if i % 7 else None, t, "x", True, 1) for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, base_failed boolean, n_words int")
    field = field_of(np.random.default_rng(1))
    names = [*rules.COUNTS, "base_failed"]
    got = [tuple(r[c] for c in names) for r in rules.judge(df.repartition(3), field).collect()]
    assert sorted(got) == sorted(brute(t) for _, t, *_ in rows)
    one = sorted(map(str, rules.judge(df.coalesce(1), field).collect()))
    assert one == sorted(map(str, rules.judge(df.repartition(9), field).collect()))
    kept = rules.retain(df, field)
    assert kept.columns == df.columns
    assert kept.count() == sum("kept=True" in r for r in one)


@pytest.mark.parametrize("marks", [[], [(1, 1), (2, 1)], [(1, None), (None, 0), (2, 5)], [(1, 0), (1, 1)]])
def test_without_usable_labels_all_lines_are_content(spark, marks):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "| | |")], "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    rows = rules.judge(docs, rules.train(docs, labels)).collect()
    assert [(r.doc_id, r.kept, r.boilerplate) for r in rows] == [(1, True, []), (2, False, [])]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert rules.judge(docs, rules.train(docs, labels)).count() == 0


def test_the_sample_is_bounded(spark):
    many = spark.range(20_000).withColumn("quality", F.lit(1))
    assert rules.drawn(many, 100, "id").count() == 100 and rules.drawn(many.limit(50), 100, "id").count() == 50
