from collections import defaultdict

import duckdb

from tideline.llm import chat


def brute(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is None, turn or 0, role is None, role or "", text or "", turn))
    out = []
    for conv, messages in by.items():
        messages.sort(key=lambda m: (*m[:4], m[4].encode()))
        for speaker in {m[3] for m in messages if not m[2]} - {"system"}:
            at = 0
            for seq, (_, _, unknown, author, text, turn) in enumerate(messages):
                role = "assistant" if author == speaker and not unknown else "system" if author == "system" else "user"
                name = author if role == "user" and not unknown else None
                head = f"<|im_start|>{role}" + (f" name={name}" if name is not None else "") + "\n"
                rendered = head + text.replace("<|", "< |") + "<|im_end|>\n"
                own = role == "assistant"
                out.append((conv, speaker, seq, turn, role, name, rendered, at, at + len(rendered),
                            at + len(head) if own else None, at + len(rendered) if own else None))
                at += len(rendered)
    return sorted(out, key=repr)


ROWS = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", "Grüße \U0001f600"), (1, 2, "cy", None),
        (1, None, "ann", "late"), (1, 3, None, "who"), (1, 3, "bob", ""), (2, 0, "system", "alone"),
        (None, 1, "ann", "x"), (None, 0, "bob", "y"), (3, 5, "ann", "same"), (3, 5, "ann", "same"), (4, 0, None, "n")]


def test_perspectives(spark):
    df = spark.createDataFrame([(*r, 1, "z") for r in ROWS],
                               "conv_id long, turn long, role string, text string, seq int, speaker string").repartition(4)
    assert sorted((tuple(r) for r in chat.rotate(df).collect()), key=repr) == brute(ROWS)


def test_a_long_conversation_is_cut_and_counted_through(spark):
    rows = [(7, i % 500, ("ann", "bob", "system")[i % 3], f"t{i % 7}") for i in range(3000)]
    rows += [(i, 0, "ann", "short") for i in range(100, 400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.rotate(df)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_empty(spark):
    assert chat.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    got = chat.op10_chat(spark, folder)
    found = con.execute(chat.ORACLE_SQL)
    assert got.columns == [c[0] for c in found.description]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(found.fetchall(), key=repr)
