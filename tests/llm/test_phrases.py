import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest=3, least=2, share=50, top=5):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything in memory."""
    found = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = tuple(w for w in re.split(r"[ \t]+", piece) if w)
            for size in range(1, longest + 1):
                found[lang or "und"].update(words[i:i + size] for i in range(len(words) - size + 1))
    out = []
    for lang, f in found.items():
        n = sum(k for p, k in f.items() if len(p) == 1)
        scored = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            around = [q for q, k in f.items() if len(q) > len(p) and k >= least and 100 * k >= share * a
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not around:
                score, _, left, right = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                            for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s)
                for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def result(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


TEXTS = [
    ("en", "The cat sat. THE CAT SAT, the cat ran;the cat\tsat\nthe dog sat: a b c d a b c d a b c d"), ("en", None),
    ("en", ""), (None, "é a é a é A É a z"), ("und", "é a é a"), ("de", "x"), ("en", "one two"),
    ("en", "..,; !!\r\n"), ("fr", "a\x85b a\x85b  c a\x85b  c"), ("fr", "l'été l'été. a a a a a a a"),
    ("en", "tie one tie one. tie two tie two. tie tre tie tre"),
]


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_against_brute_force(spark, monkeypatch, longest):
    monkeypatch.setattr(phrases, "RUN_WORDS", 10)
    monkeypatch.setattr(phrases, "HELD", 5)
    monkeypatch.setattr(phrases, "BLOCK", 7)
    monkeypatch.setattr(phrases, "BUCKET_CHARS", 100)
    rows = TEXTS + [("en", "the cat sat on the mat " * 40)]
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("words", F.lit(1)).withColumn("n", F.lit("x"))
    got = phrases.collocations(df.repartition(4), longest=longest, least=2, top=50)
    assert result(got) == brute(rows, longest, 2, 50, 50)


def test_order_of_rows_and_slices_do_not_matter(spark):
    df = spark.createDataFrame(TEXTS * 3, "lang string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = result(phrases.collocations(df.repartition(7), least=2, top=50))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert many == brute(TEXTS * 3, 3, 2, 50, 50)


def test_blocks_lose_no_words(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 5)
    text = "Aa bbb, " * 9 + "verylongwordwithoutanybreak é\té"
    assert b"".join(phrases.blocks(text)) == text.encode().lower()
    words = [t for b in phrases.blocks(text) for t in phrases._TOKEN.findall(b) if t[0] not in phrases._ENDS]
    assert words == [w for w in re.split(rb"[ \t,]+", text.encode().lower()) if w]


def test_tokens_are_those_of_the_pattern():
    for text in ["", " ", ".", "a", " a", "Aa bbb,  c\t.;d\n\ne é\x85f! ", "\x0b\x0c\ra.b"]:
        raw = text.encode()
        words = [t for t in phrases._TOKEN.findall(raw) if t[0] not in phrases._ENDS]
        got = phrases.tokens(raw).to_pylist()
        assert [t for t in got if t[0] not in phrases._ENDS] == words
        assert [t for t in got if t[0] in phrases._ENDS] == [bytes([c]) for c in raw if c in phrases._ENDS]


def sent(rows, longest, buckets):
    batch = pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]})
    found = list(phrases._runs(iter([batch]), longest, buckets))
    return pa.Table.from_batches(found, schema=phrases._RUNS).sort_by("part")


def test_blocks_of_a_run_are_as_many_as_tasks_not_buckets():
    # Every bucket and language used to have its own, so that their number grew with the square of the texts.
    rows = [(lang, " ".join(f"{lang}{i}" for i in range(3000))) for lang in ("de", "en", "fr")]
    for tasks in (1, 4, 40):
        found = sent(rows, 3, tasks * phrases.TASK_BUCKETS)
        assert len(found) <= tasks
        assert sum(b.num_rows for b in phrases._merged(iter(found.to_batches()), 1)) == 3 * (1 + 3000 + 2999 + 2998)


@pytest.mark.parametrize("longest", [1, 2, 3, 4])
@pytest.mark.parametrize("words, bytes_, held", [(10, 1 << 20, 5), (1 << 20, 11, 1 << 20), (1, 1, 40)])
def test_runs_that_end_inside_texts(monkeypatch, longest, words, bytes_, held):
    for name, value in (("RUN_WORDS", words), ("RUN_BYTES", bytes_), ("HELD", held), ("BLOCK", 7), ("CUT_BYTES", 5),
                        ("SENT_BYTES", 50)):
        monkeypatch.setattr(phrases, name, value)
    rows = [(lang or "und", text) for lang, text in TEXTS * 2] + [("en", "the cat sat on the mat " * 40)]
    expected = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            found = [w for w in re.split(r"[ \t]+", piece) if w]
            expected[lang, ""] += len(found)
            expected.update((lang, " ".join(found[i:i + size])) for size in range(1, longest + 1)
                            for i in range(len(found) - size + 1))
    table = sent(rows, longest, 20)
    merged = pa.Table.from_batches(phrases._merged(iter(table.to_batches(max_chunksize=3)), 2))
    got = {(r["lang"], r["phrase"]): r["n"] for r in merged.to_pylist()}
    assert len(got) == len(merged)
    assert got == {k: n for k, n in expected.items() if n >= 2 or (n and not k[1])}


def test_last_ranking_gets_the_best_of_groups_only(spark):
    rows = [("en", ". ".join(f"a{i} b{i}. a{i} b{i}" for i in range(900)))]
    df = phrases.collocations(spark.createDataFrame(rows, "lang string, text string"), least=2, top=3)
    assert result(df) == brute(rows, top=3)
    # The rows of a language went to one task; now they meet in groups first, and three of each go on.
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(phrase" in plan and plan.count("Window [row_number()") == 2


def test_large_counts_are_exact(spark):
    row = spark.createDataFrame([(3_000_000_000_007, 3_000_000_000_011, 3_000_000_000_013)], "w long, x long, y long")
    got = row.select(phrases._score("w", "x", "y")).first()[0]
    assert got == 1000000 * 3_000_000_000_007 ** 2 // (3_000_000_000_011 * 3_000_000_000_013)


def test_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    got = phrases.collocations(df)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() == 0


def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    expected = con.execute(phrases.ORACLE_SQL)
    names = [c[0] for c in expected.description]
    got = phrases.op11_collocations(spark, folder)
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == sorted(expected.fetchall())
