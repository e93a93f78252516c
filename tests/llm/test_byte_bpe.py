import hashlib

import public_tokenizers as P
import tiktoken

from tideline.llm import byte_bpe

WEIRD = ["", None, " ", "a", "it's we'll I'M", "x" * 3000, " \n\n  \t a  ", "１２３ ½ ² abc", "Ⅷ ñandú Éa",
         "日本語 テキスト", "a b c\x1cd\x85e", "\U0001f600 ok <|endoftext|>", "ǅ ʰ ͅ", "\x00\x01 z",
         "word " * 5000, "  leading", "trailing  ", "é é"]


def library():
    ranks = byte_bpe.ranks_of(byte_bpe.vocabulary(byte_bpe.VOCABULARY))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library_and_exact_round_trip(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", 3000)
    monkeypatch.setattr(byte_bpe, "CHUNK_CHARS", 700)
    rows = [(i, t, "x") for i, t in enumerate(WEIRD)] + [(3, "a", None), (None, "it's", None), (3, "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tokens string").repartition(3)
    out = byte_bpe.decode(byte_bpe.encode(df)).collect()
    assert len(out) == len(rows)
    own = library()
    expected = sorted(((i, own.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.tokens, bytes(r.decoded)) for r in out), key=repr) == expected


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(df)).collect() == []


def test_query(spark, folder):
    got = {r.doc_id: r for r in byte_bpe.op4_byte_bpe(spark, folder).collect()}
    own = library()
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for r in texts:
        ids = own.encode_ordinary(r.text)
        digest = lambda b: hashlib.sha256(b).hexdigest()
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == digest(" ".join(map(str, ids)).encode())
        assert got[r.doc_id].decoded_sha256 == digest(r.text.encode())
