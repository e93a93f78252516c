import hashlib
import random
import re

import numpy as np
import pytest

from tideline.llm import pii


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute_base(text):
    """The patterns as given, by plain search."""
    out = [("email", *m.span()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 16, 19),
                                     ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                out.append((kind, *m.span()))
    return out


def test_base_spans_on_random_marks():
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choice("aB9.@-_+%( )12\né") for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == brute_base(text), text
    for _ in range(3000):
        text = "".join(rng.choice("0123456789  -.+(") for _ in range(rng.randrange(90)))
        assert pii.base_spans(text) == brute_base(text), text


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "1 " * 150_000):
        pii.base_spans(text)


def test_crf_gradient():
    rng = np.random.default_rng(0)
    scores, move = rng.normal(size=(6, 3, pii.TAGS)), rng.normal(size=(pii.TAGS, pii.TAGS))
    tags = rng.integers(0, pii.TAGS, (3, 6))
    _, grad, moves = pii._crf(scores, tags, move)
    for place in [(0, 1, 2), (3, 0, 0), (5, 2, 4)]:
        up, down = scores.copy(), scores.copy()
        up[place] += 1e-4
        down[place] -= 1e-4
        slope = (pii._crf(up, tags, move)[0] - pii._crf(down, tags, move)[0]) / 2e-4
        assert abs(slope - grad[place]) < 1e-5
    up, down = move.copy(), move.copy()
    up[1, 2] += 1e-4
    down[1, 2] -= 1e-4
    assert abs((pii._crf(scores, tags, up)[0] - pii._crf(scores, tags, down)[0]) / 2e-4 - moves[1, 2]) < 1e-4


def test_decoding_equals_trying_all_paths():
    rng = np.random.default_rng(1)
    scores, move = rng.normal(size=(4, 5, pii.TAGS)).astype(np.float32), rng.normal(size=(pii.TAGS, pii.TAGS))
    got = pii._best(scores, move)
    for n in range(5):
        best = max(np.ndindex(*(pii.TAGS,) * 4), key=lambda p: sum(scores[t, n, p[t]] for t in range(4))
                   + sum(move[p[t], p[t + 1]] for t in range(3)))
        assert tuple(got[n]) == best


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_learned_spans(spark, tagger):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    base = [pii.base_spans(t) for t in texts]
    free = tagger.added(texts, [[] for _ in texts])
    known = [(i, s) for i, b in enumerate(base) for s in b]
    assert np.mean([s in free[i] for i, s in known]) >= 0.8
    assert sum(map(len, tagger.added(texts, base))) <= 0.01 * len(texts)
    # The search for paths is only left out where it would find nothing.
    windows = np.array([pii.classes(t[:200].ljust(200)) for t in texts[:300]])
    best = pii._best(tagger.tag_scores(windows).transpose(0, 2, 1), tagger.weights["transitions"])
    assert (tagger.paths(windows) == best).all()


def test_a_span_across_windows_and_odd_rows(spark, tagger):
    mail = "ab " * 168 + "some.name@mail5.example.com " + "and more " * 9000
    rows = [(1, mail, "x"), (None, None, "x"), (2, "", "x"), (3, "no", "x"), (3, "no", "x"),
            (4, "call +1 (168) 555-5254 or 4.3.2.1", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    with pytest.raises(ValueError, match="already has a column spans"):
        pii.find(df, tagger)
    got = {r.doc_id: r.found for r in pii.find(df, tagger, spans_col="found").collect()}
    assert [(s.kind, s.start, s.end, s.base) for s in got[1]] == [("email", 504, 531, True)]
    assert got[None] == got[2] == got[3] == []
    clean = {r.doc_id: r.text for r in pii.redact(df, tagger).collect()}
    assert clean[4] == "call [PHONE] or [IP]" and clean[None] is None and clean[3] == "no"
    assert [(k, a) for k, a, _ in tagger.added([mail], [[]])[0]] == [("email", 504)]


def test_spans_do_not_depend_on_other_texts(spark, tagger, folder):
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").where("text RLIKE '[0-9@]'").collect()][:60]
    base = [pii.base_spans(t) for t in texts]
    for t in texts[:20]:
        codes = pii.classes(t)[:pii.WINDOW]
        padded = np.zeros((1, len(codes) + 90), np.uint8)
        padded[0, :len(codes)] = codes
        alone, wide = tagger.tag_scores(codes[None]), tagger.tag_scores(padded)
        assert np.allclose(alone[:, :, 0], wide[:len(codes), :, 0], atol=1e-5)
    together = tagger.added(texts, base)
    assert together == [tagger.added([t], [b])[0] for t, b in zip(texts, base)]


def test_a_path_that_pays_only_as_a_whole_is_searched():
    rng = np.random.default_rng(0)
    for _ in range(200):
        tagger = pii.Tagger.initial(rng)
        tagger.weights["transitions"] = rng.normal(0, 1.5, (pii.TAGS, pii.TAGS)).astype(np.float32)
        tagger.weights["bias"][0] = rng.uniform(0, 4)
        windows = rng.integers(1, pii.CLASSES, (8, 12)).astype(np.uint8)
        best = pii._best(tagger.tag_scores(windows).transpose(0, 2, 1), tagger.weights["transitions"])
        # Paths that stay on "none" throughout are not searched; all others are.
        assert (tagger.paths(windows) == best).all()


def test_nothing_to_learn_from_and_empty(spark):
    assert pii.train(spark.createDataFrame([("abc",), (None,)], "text string")) is None
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(empty, None).collect() == []
    assert pii.find(spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string"), None).first().spans[0].base


def test_query(spark, folder):
    got = {r.doc_id: r for r in pii.op3_pii(spark, folder).collect()}
    texts = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(texts)
    for r in texts:
        base, row = brute_base(r.text), got[r.doc_id]
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row.spans.split(",")) or not listed
