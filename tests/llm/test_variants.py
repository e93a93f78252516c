import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideline.llm import variants


def one_edit(x, y):
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    long, short = sorted((x, y), key=len, reverse=True)
    at = 0
    while at < len(short) and long[at] == short[at]:
        at += 1
    return long[at + 1:] == (short[at + 1:] if len(x) == len(y) else short[at:])


def brute_words(rows, least=7, twice=2):
    met = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode("utf-8"))
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            met[run] += 1
    return {w: n for w, n in met.items() if len(w) >= least and n >= twice}


def brute(words, ratio=10):
    """{word: (n, n_near, form, form_n, root)} by comparing all pairs."""
    form, near = {}, {}
    for w, n in words.items():
        found = [v for v in words if one_edit(v, w)]
        near[w] = len(found)
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (n, near[w], form[w], words.get(form[w]), root(w)) for w, n in words.items()}


def result(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def sample(rng, size, letters, least, most):
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(size)}
    for w in list(words):
        for _ in range(2):
            at, c = rng.randrange(len(w) + 1), rng.choice(letters)
            words.add(rng.choice([w[:at] + c + w[at:], w[:at] + c + w[at + 1:], (w[:at] + w[at + 1:]) or c]))
    return sorted(words)


@pytest.mark.parametrize("follows", ["", "a", "é"])
def test_composition_against_all_pairs(follows):
    rng = random.Random(2)
    for letters, size in (("ab", 12), ("abé", 40), ("abcdefgh", 60)):
        for _ in range(30):
            words = sample(rng, size, letters, 0 if letters == "ab" else 1, 6)
            got = Counter(tuple(sorted((words[i], words[j]))) for i, j in variants.near_pairs(words, follows))
            # The pair's common beginning must end inside the words, not in what follows.
            expected = Counter()
            for i, x in enumerate(words):
                for y in words[i + 1:]:
                    long, short = sorted((x, y), key=len, reverse=True)
                    if one_edit(x, y) and not (follows and len(long) > len(short) and long[:-1] == short
                                               and long[-1] == follows):
                        expected[x, y] += 1
            assert got == expected


def test_acceptor_is_minimal():
    words = sorted(a + b for a in ("un", "re", "over") for b in ("load", "loads", "loaded"))
    a = variants.Acceptor(words)
    assert a.count[a.start] == len(words) and sum(not arcs for arcs in a.arcs) == 1
    languages = set()
    for s in range(len(a.arcs)):
        def accepted(t):
            return frozenset(([""] if a.final[t] else []) + [c + w for c, u in a.arcs[t] for w in accepted(u)])
        languages.add(accepted(s))
    assert len(languages) == len(a.arcs)


@pytest.mark.parametrize("limit", [3, 20, 20_000])
def test_against_brute_force(spark, limit):
    rng = random.Random(7)
    words = {w: rng.choice([2, 2, 3, 19, 20, 21, 200, 200, 2000]) for w in sample(rng, 150, "abñ", 5, 9)}
    # A third of the words begin alike.
    words |= {"same" * 3 + w: 5 for w in sample(rng, 60, "ab", 1, 5)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").withColumn("size", F.lit("x"))
    assert result(variants.variants(df.repartition(5), limit=limit)) == brute(words)


def test_chains_lead_to_the_root(spark):
    words = {"aaaaaaa": 10 ** 6, "aaaaaab": 10 ** 5, "aaaaabb": 10 ** 4, "aaaabbb": 1000, "aaabbbb": 100, "aabbbbb": 10,
             "zzzzzzz": 10, "zzzzzzzz": 10, "zzzzzzzzz": 100}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = result(variants.variants(df))
    assert got == brute(words) and got["aabbbbb"][4] == "aaaaaaa"


ROWS = [(1, None), (2, ""), (3, "internationalisation Internationalization INTERNATIONALIZATION"), (None, "internationalization"),
        (4, "straße Straßen straßen ÀÉÎÕÜÿ×÷ ÀÉÎÕÜÿ×÷ a1b2"), (5, "naïveté naïvete naïvetéĀnaïvete"), (6, "x" * 5000),
        (7, "x" * 5000), (8, "y" + "x" * 4999), (9, "y" + "x" * 4999), (10, "X" * 5001 + "ÿ " + "x" * 5001 + "ÿ")]


def test_vocabulary_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(variants, "HELD", 3)
    rng = random.Random(5)
    rows = ROWS + [(i, " ".join(rng.choice(["internationalization", "Organisation", "organization", "the", "colours", "colour"])
                                for _ in range(20))) for i in range(100, 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2))
    words = variants.vocabulary(df.repartition(6))
    expected = brute_words(rows)
    assert dict(map(tuple, words.collect())) == expected
    assert result(variants.variants(words)) == brute(expected)


def test_query_against_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    words = brute_words(rows)
    # Near words by deleted letters, to spare most of the pairs.
    keys = {}
    for w in words:
        for key in {w[:i] + w[i + 1:] for i in range(len(w))} | {w}:
            keys.setdefault(key, []).append(w)
    near = {w: {v for key in {w[:i] + w[i + 1:] for i in range(len(w))} | {w} for v in keys[key] if one_edit(v, w)}
            for w in words}
    got = result(variants.op12_variants(spark, folder))
    assert set(got) == set(words)
    for w, (n, n_near, form, form_n, root) in got.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        best = best if best is not None and words[best] >= 10 * words[w] else None
        assert (n, n_near, form, form_n) == (words[w], len(near[w]), best, words.get(best))
        assert root == (got[form][4] if form else w)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    got = variants.variants(variants.vocabulary(df))
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"] and got.count() == 0
