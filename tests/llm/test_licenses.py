import math
import re
import textwrap

import pytest

from tideline.llm import licenses

TEXTS = ["", None, "all rights reserved", "All Rights\nReserved. all rights reserved all rights", "cc by cc by",
         "CC-BY: general public\n\nlicense", "ccc by", "cc byé", "Released under\nthe MIT\nLicense.", "the mit license",
         "x\n" * 50 + "Licensed under the Apache License, Version 2.0. and more words " + "y " * 9000,
         "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "licensed under the " * 40 + "apache", "the " * 500 + "license apache version under the " * 2,
         " ".join(t for _, t in licenses.TEMPLATES) + "\n" + " filler ".join(licenses.TEMPLATES[1][1].split())]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def brute(text, threshold=licenses.THRESHOLD, stretch=licenses.STRETCH):
    found = tokens(text)
    hits = [(label, i) for phrase, label in licenses.PHRASES.items() for i in range(len(found))
            if found[i:i + len(phrase.split())] == phrase.split()]
    matches = set()
    for n, (label, template) in enumerate(licenses.TEMPLATES):
        wanted, size = set(tokens(template)), math.ceil(stretch * len(tokens(template)) - 1e-9)
        run = None
        for at in range(max(1, len(found) - size + 1)):
            held = len(wanted.intersection(found[at:at + size]))
            if held >= threshold * len(wanted) - 1e-9:
                run = (run[0], max(run[1], held)) if run else (at, held)
            elif run:
                matches.add((label, n, run[0], run[1] / len(wanted)))
                run = None
        if run:
            matches.add((label, n, run[0], run[1] / len(wanted)))
    return len(found), sorted(hits), sorted(matches)


def expected(i, text):
    n, hits, matches = brute(text)
    spots, base = [w for _, w in hits], {label for label, _ in hits}
    score = 1.0 if hits else max([m[3] for m in matches], default=0.0)
    return (i, n, len(hits), min(spots, default=None), max(spots, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {m[0] for m in matches})), score)


@pytest.mark.parametrize("threshold, stretch", [(0.8, 1.5), (0.5, 1.0), (1.0, 3.0), (0.1, 0.4)])
def test_every_match_is_found(spark, threshold, stretch):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[2], "x"), (2, TEXTS[2], "x")],
                               "doc_id long, text string, matches string")
    rows = licenses.scan(df, threshold=threshold, stretch=stretch).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        n, hits, matches = brute(TEXTS[2 if r.doc_id is None else r.doc_id], threshold, stretch)
        assert (r.n_words, sorted(tuple(p) for p in r.phrases)) == (n, hits)
        assert sorted(tuple(m) for m in r.matches) == matches


@pytest.mark.parametrize("width", [1, 12, 30, 40, 200])
def test_wrapped_notices(width):
    index = licenses.Index(licenses.TEMPLATES, {}, licenses.THRESHOLD)
    for n, (_, template) in enumerate(licenses.TEMPLATES):
        text = "before\n" + "\n".join(" # " + line for line in textwrap.wrap(template, width, break_long_words=False)) + "\nafter"
        assert (n, 1.0) in {(m[0], m[2]) for m in index.matches(licenses.words(text))}


def test_empty(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark, folder):
    texts = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = sorted(tuple(r) for r in licenses.op8_licenses(spark, folder).collect())
    assert got == sorted(expected(r.doc_id, r.text) for r in texts)
    assert {"mit", "apache"} <= {x for r in got for x in r[6].split(",")}
