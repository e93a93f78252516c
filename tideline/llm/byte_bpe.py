"""Byte-level BPE encoding and decoding through a global shuffle of distinct words.

``encode`` cuts texts into pre-tokens, numbers the distinct ones of each block of documents and
keeps their positions as a sequence of those numbers. The words travel, by their hash, to the task that
owns them; there each distinct word of the corpus is encoded once. Its ids join the block again
and are placed by position. A word occurs once per block however often it stands in the texts,
so no frequent word makes a large group.

``decode`` joins ids with the table of token bytes. That table has one row per vocabulary entry
(50,256 entries, half a megabyte), a bound that does not depend on the data, so it is shipped to
every task.

Texts are read twice. The documents must come in the same order and partitions both times, as they
do from files; otherwise the blocks differ and ``encode`` stops with ``ValueError``.

Null and empty texts give no ids and decode to no bytes. Rows are treated one by one: repeated
rows and repeated or null ids give as many results. An empty table gives an empty result. Only
``id_col`` and ``text_col`` are read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StringType, StructField,
                               StructType)

from tideline.llm.common import small_batches, table, vocabulary

VOCABULARY = "byte_bpe_50k.tiktoken"
# A block ends after this many characters, a chunk of positions after that many.
BLOCK_CHARS = 32_000_000
CHUNK_CHARS = 2_000_000

# Letters and digits below U+0250. For texts of printable characters of that range the pattern is
# compiled with these classes, as `re` is twice as fast as `regex`; all others take the general one.
_LETTERS = "a-zA-Z" + "".join(chr(c) for c in range(0xAA, 0x250) if chr(c).isalpha())
_DIGITS = "0-9" + "".join(chr(c) for c in range(0xAA, 0x250) if chr(c).isnumeric())
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]")


def ranks_of(raw: bytes) -> dict[bytes, int]:
    """Token bytes and their ranks from the lines of a vocabulary file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


def splitters(pattern: str) -> tuple[re.Pattern, object]:
    import regex

    narrow = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^\\s{_LETTERS}{_DIGITS}]")
    narrow = narrow.replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", f"[{_DIGITS}]")
    return re.compile(narrow), regex.compile(pattern)


class Numbers(dict):
    """Numbers words in the order they first appear."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _packed(codes: np.ndarray) -> bytes:
    """Codes as four byte planes, compressed; most high bytes are zero."""
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, count * 4, codec="zstd"), np.uint8).reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str, buckets: int, schema: pa.Schema,
            positions: bool) -> Iterator[pa.RecordBatch]:
    """Documents with their positions, or the distinct words by bucket, block by block.

    A block is named by its place and its texts, so that both kinds only meet if they come from the
    same rows. Position codes number its words by falling frequency, so that they compress well;
    ``slots`` says where each number's word stands in the block's words, taken bucket by bucket.
    """
    narrow, wide = splitters(pattern)
    partition = TaskContext.get().partitionId()
    numbers, chunks, chars, made, seen = Numbers(), [], 0, 0, xxhash.xxh64()
    ids, sizes, codes, waiting = [], [], [], 0

    def row(**values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([values.get(f.name)], f.type) for f in schema], schema=schema)

    def close() -> None:
        nonlocal ids, sizes, codes, waiting
        if ids:
            chunks.append((ids, sizes, np.concatenate(codes)))
        ids, sizes, codes, waiting = [], [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal numbers, chunks, chars, made, seen
        close()
        seen.update(f"{partition} {made}")
        block = seen.intdigest() - (1 << 63)
        words = list(numbers)
        owner = np.fromiter((zlib.crc32(w.encode()) % buckets for w in words), np.int64, len(words))
        by_owner = np.argsort(owner, kind="stable")
        if not positions:
            ends = np.searchsorted(owner[by_owner], np.arange(buckets + 1))
            for bucket in np.flatnonzero(np.diff(ends)):
                yield row(block=block, bucket=int(bucket),
                          words=[words[i] for i in by_owner[ends[bucket]:ends[bucket + 1]]])
            numbers, chars, made, seen = Numbers(), 0, made + 1, xxhash.xxh64()
            return
        counts = np.zeros(len(words), np.int64)
        for _, _, found in chunks:
            counts += np.bincount(found, minlength=len(words))
        by_count = np.argsort(-counts, kind="stable")
        renamed = np.empty(len(words), np.uint32)
        renamed[by_count] = np.arange(len(words), dtype=np.uint32)
        slots = np.empty(len(words), np.uint32)
        slots[renamed[by_owner]] = np.arange(len(words), dtype=np.uint32)
        yield row(block=block, slots=_packed(slots), distinct=len(words))
        for keys, lengths, found in chunks:
            yield row(block=block, ids=keys, sizes=lengths, codes=_packed(renamed[found]))
        numbers, chunks, chars, made, seen = Numbers(), [], 0, made + 1, xxhash.xxh64()

    for batch in batches:
        for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = value.as_py() or ""
            seen.update(text)
            found = (wide if _UNUSUAL.search(text) else narrow).findall(text)
            chars += len(text)
            if positions:
                ids.append(key)
                sizes.append(len(found))
                codes.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
                waiting += len(text)
                if waiting >= CHUNK_CHARS:
                    close()
            else:
                # Words keep the order in which they first appear.
                numbers.update(dict.fromkeys(found))
            if chars >= BLOCK_CHARS:
                yield from flush()
    if ids or chunks or numbers:
        yield from flush()


def _encode_words(batches: Iterator[pa.RecordBatch], raw: bytes) -> Iterator[pa.RecordBatch]:
    """Ids of each word; all rows with a word are in this partition, which encodes it once."""
    import tiktoken

    # Every word is one pre-token, so the pattern takes the whole of it.
    whole = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks_of(raw),
                              special_tokens={}).encode_ordinary
    known: dict[str, list[int]] = {}
    for batch in batches:
        sizes, tokens = [], []
        for words in batch.column(2).to_pylist():
            found = []
            for word in words:
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = whole(word)
                found.append(ids)
            sizes.append([len(ids) for ids in found])
            tokens.append([i for ids in found for i in ids])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.list_(pa.int32())),
             pa.array(tokens, pa.list_(pa.int32()))], names=["block", "bucket", "sizes", "tokens"])


def gather(starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs that ``codes`` name, one after the other, and where each run ends."""
    taken = sizes[codes]
    ends = np.cumsum(taken)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts[codes] - (ends - taken), taken) + np.arange(total), ends


def _flat(column: pa.ChunkedArray, order: list[int]) -> np.ndarray:
    lists = [column[i].values for i in order]
    return np.concatenate([x.to_numpy(zero_copy_only=False) for x in lists]) if lists else np.zeros(0, int)


def _reassemble(chunks: pa.Table, words: pa.Table, schema: pa.Schema) -> pa.Table:
    """Put the ids of a block's words at their positions."""
    if not chunks.num_rows or sum(n or 0 for n in chunks.column("distinct").to_pylist()) and not words.num_rows:
        raise ValueError("the documents came in another order when read again; store them first")
    order = np.argsort(words.column("bucket").to_numpy()).tolist()
    sizes = _flat(words.column("sizes"), order).astype(np.int64)
    values = _flat(words.column("tokens"), order).astype(np.int32)
    slots = next(_unpacked(blob, n) for blob, n in zip(
        chunks.column("slots").to_pylist(), chunks.column("distinct").to_pylist()) if blob is not None)
    starts = (np.cumsum(sizes) - sizes)[slots]
    sizes = sizes[slots]
    out = []
    for ids, counts, blob in zip(chunks.column("ids"), chunks.column("sizes"), chunks.column("codes")):
        if not ids.is_valid:
            continue
        counts = np.array(counts.as_py(), np.int64)
        places, ends = gather(starts, sizes, _unpacked(blob.as_py(), int(counts.sum())))
        ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        tokens = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values[places]))
        out.append(pa.Table.from_arrays([ids.values.cast(schema.field(0).type),
                                         tokens.cast(schema.field(1).type)], schema=schema))
    return pa.concat_tables(out)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           raw: bytes | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """One row per document: its id and ``tokens``, the ids of the whole text."""
    raw = vocabulary(VOCABULARY) if raw is None else raw
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    schema = StructType([
        StructField("block", LongType()), StructField("slots", BinaryType()),
        StructField("distinct", IntegerType()), StructField("ids", ArrayType(id_type)),
        StructField("sizes", ArrayType(IntegerType())), StructField("codes", BinaryType()),
        StructField("bucket", IntegerType()), StructField("words", ArrayType(StringType()))])
    result = StructType([StructField("__id", id_type), StructField("tokens", ArrayType(IntegerType()))])
    arrow, arrow_result = to_arrow_schema(schema), to_arrow_schema(result)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(raw)
    # Cutting texts twice costs less than keeping positions and words on disk between the two uses.
    small_batches(spark)
    texts = docs.select(F.col(id_col), F.col(text_col))
    words, placed = (texts.mapInArrow(lambda b, p=p: _blocks(b, pattern, buckets, arrow, p), schema)
                     for p in (False, True))
    ids = (words.select("block", "bucket", "words").repartition(F.col("bucket"))
           .mapInArrow(lambda b: _encode_words(b, shared.value),
                       "block long, bucket int, sizes array<int>, tokens array<int>"))
    positions = placed.select("block", "slots", "distinct", "ids", "sizes", "codes")
    return (positions.groupBy("block").cogroup(ids.groupBy("block"))
            .applyInArrow(lambda c, w: _reassemble(c, w, arrow_result), result)
            .withColumnRenamed("__id", id_col))


def decode(encoded: DataFrame, tokens_col: str = "tokens", bytes_col: str = "decoded",
           raw: bytes | None = None) -> DataFrame:
    """Add ``bytes_col``: the bytes of the tokens, joined from the table of token bytes.

    An id outside the vocabulary raises ``KeyError``. A null list decodes to no bytes.
    """
    raw = vocabulary(VOCABULARY) if raw is None else raw
    small_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(raw)
    schema = StructType([*encoded.schema.fields, StructField(bytes_col, BinaryType())])
    place = encoded.columns.index(tokens_col)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(shared.value)
        sizes = np.full(max(ranks.values()) + 1, -1, np.int64)
        ordered = sorted(ranks.items(), key=lambda item: item[1])
        for token, rank in ordered:
            sizes[rank] = len(token)
        blob = np.frombuffer(b"".join(token for token, _ in ordered), np.uint8)
        starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
        for batch in batches:
            out = []
            for item in batch.column(place):
                ids = item.values.to_numpy(zero_copy_only=False) if item.is_valid else np.zeros(0, int)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(sizes) or (sizes[ids] < 0).any()):
                    raise KeyError("an id is not in the vocabulary")
                out.append(blob[gather(starts, sizes, ids)[0]].tobytes() if len(ids) else b"")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, bytes_col])

    return encoded.mapInArrow(joined, schema)


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts, and digests of ids and of the bytes they decode to, per document."""
    decoded = decode(encode(table(spark, folder, "documents")))
    listed = F.array_join(F.col("tokens").cast("array<string>"), " ")
    return decoded.select(
        "doc_id", F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
