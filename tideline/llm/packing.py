"""Best-fit packing of token sequences by exact complements.

``tokenize`` turns texts into pieces of at most ``capacity`` tokens; only longer documents are
cut. ``pack`` puts pieces into as few sequences of that capacity as it can:

1. Every piece gets its number among the pieces of its length: a local number inside its
   partition plus the count of that length in earlier partitions. No task holds one length's rows.
2. The histogram of lengths, at most ``capacity`` rows whatever the size of the data, is all that
   the plan needs. From the longest length down, the gap it leaves is looked up among the sums of
   one, two and three available lengths; a combination that fills the gap exactly is used as often
   as the counts of its lengths allow. What has no exact complement is then filled best-fit, and
   after each piece the remaining gap is looked up again. Each step uses up a length, so a plan
   has at most ``capacity`` steps.
3. A step says: numbers a..a+m of this length go to sequences s..s+m at this offset. The table
   of steps has at most a few thousand rows, a bound set by ``capacity``, and is shipped to tasks.

Null and empty texts make one piece that holds the closing id only. Rows are treated one by one, so
repeated rows and null ids are packed as often as they occur. Empty tables give empty results.
A length that is null, below 1 or above the capacity stops ``pack``.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tideline.llm.byte_bpe import Numbers, gather
from tideline.llm.common import kept, refuse, small_batches, stored, table, texts, vocabulary

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
# Distinct words a Python worker remembers (see _Words), and new ones it encodes at a time.
REMEMBERED = 450_000
FRESH = 16_384
# Texts are encoded together up to this many characters.
TOGETHER_CHARS = 1 << 20

# str.split() takes these for white space, the vocabulary's pattern does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_BLANKS = re.compile("[ \t\n\r]+")


# Letters that normalization leaves alone and that have one letter in lower case; ASCII signs but the apostrophe and
# the one that special tokens begin with.
_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-įı-ňŊ-ž", r"!-&(-/:;=-@\[-`{-~"
_PLAIN = re.compile(f"[{_LETTERS}0-9{_SIGNS}]+")
# The vocabulary's pre-tokens of such words.
_PIECES = re.compile(f"[{_LETTERS}]+|[0-9]|[{_SIGNS}]+")


def _byte_letters() -> np.ndarray:
    """The letter that stands for each byte: its own where that can be printed, else the next one from 256 on; the blank stays."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    letters = np.arange(256, dtype="<u4")
    letters[hidden] = 256 + np.arange(len(hidden))
    letters[32] = 32
    return letters


class _Plain:
    """Encodes many plain words at once, by the vocabulary's merges alone.

    A pre-token has one last token, which tells where it ends. The merges are those of ``whole``, not a copy of them.
    """

    def __init__(self, raw: bytes, whole):
        from tokenizers import Tokenizer, pre_tokenizers

        made = json.loads(raw)
        suffix = made["model"].get("end_of_word_suffix")
        kinds = [step["type"] for step in (made.get("normalizer") or {}).get("normalizers", [])]
        cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.able = bool(suffix and made["model"]["type"] == "BPE" and kinds == ["NFC", "Replace", "Lowercase"]
                         and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
                         and cuts[0]["pattern"].get("Regex", "").endswith("|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
                         and not cuts[1]["add_prefix_space"])
        self.able &= not any(_PLAIN.fullmatch(t["content"]) for t in made.get("added_tokens", []))
        if self.able:
            self.tokenizer = Tokenizer(whole.model)
            self.tokenizer.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
            vocabulary = made["model"]["vocab"]
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
            self.letters = _byte_letters()

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Sizes and ids of the words; None if that cannot be told."""
        spaced = _PIECES.sub(r"\g<0> ", "\n".join(words))
        signs = np.frombuffer(spaced.encode("utf-32-le"), "<u4")
        blanks, breaks = np.flatnonzero(signs == 32), np.flatnonzero(signs == 10)
        joined = spaced.replace("\n", "")[:-1].lower()
        if not joined.isascii():
            joined = self.letters[np.frombuffer(joined.encode(), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(blanks):
            return None
        # A word ends with its last piece.
        return np.diff(ends[np.searchsorted(blanks, np.append(breaks, len(signs))) - 1], prepend=0), ids


class _Words:
    """Ids by word. White space ends a pre-token, so a text's ids are those of its words in turn.

    A worker that remembers too many words forgets the least used ones, so its memory is bounded and frequent words
    are encoded once. What it remembers affects its speed only.
    """

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(raw)
        self.plain = _Plain(raw, self.tokenizer)
        self.codes = Numbers()
        self.starts = self.sizes = self.uses = np.zeros(0, np.int64)
        self.values = np.zeros(0, "<u4")

    def forget(self) -> None:
        """Keep the most used half, and of equally used words the newest."""
        newest = np.arange(len(self.codes))[::-1]
        kept = np.sort(newest[np.argsort(-self.uses[newest], kind="stable")[:REMEMBERED // 2]])
        words = list(self.codes)
        self.codes = Numbers(zip((words[i] for i in kept), range(len(kept))))
        self.values = self.values[gather(self.starts, self.sizes, kept)[0]]
        self.sizes, self.uses = self.sizes[kept], self.uses[kept] // 2
        self.starts = np.cumsum(self.sizes) - self.sizes

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of some words."""
        easy = [i for i, w in enumerate(words) if _PLAIN.fullmatch(w)] if self.plain.able else []
        done = self.plain.encode([words[i] for i in easy]) if easy else None
        chosen = np.zeros(len(words), bool)
        if done is not None:
            chosen[easy] = True
        hard = [w for w, is_easy in zip(words, chosen) if not is_easy]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(hard, add_special_tokens=False)] if hard else []
        sizes = np.zeros(len(words), np.int64)
        sizes[~chosen] = [len(ids) for ids in found]
        values = np.array([i for ids in found for i in ids], "<u4")
        if done is None:
            return sizes, values
        sizes[chosen] = done[0]
        # Both parts one after the other, then in the words' order.
        place = np.empty(len(words), np.int64)
        place[~chosen], place[chosen] = np.arange(len(hard)), len(hard) + np.arange(len(easy))
        parted = np.concatenate([sizes[~chosen], done[0]])
        return sizes, np.concatenate([values, done[1]])[gather(np.cumsum(parted) - parted, parted, place)[0]]

    def learn(self, fresh: list[str]) -> None:
        sizes, values = [self.sizes], [self.values]
        for first in range(0, len(fresh), FRESH):
            found = self.encode_words(fresh[first:first + FRESH])
            sizes.append(found[0])
            values.append(found[1])
        self.sizes, self.values = np.concatenate(sizes), np.concatenate(values)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.uses = np.append(self.uses, np.zeros(len(fresh), np.int64))

    def encode(self, text_list: list[str]) -> Iterator[np.ndarray]:
        if len(self.codes) > REMEMBERED:
            self.forget()
        split = [[w for w in _BLANKS.split(t) if w] if _SEPARATORS.search(t) else t.split()
                 for t in text_list]
        codes, known = self.codes, len(self.codes)
        numbered = [np.fromiter(map(codes.__getitem__, words), np.int64, len(words)) for words in split]
        del split
        if len(codes) > known:
            self.learn(list(islice(reversed(codes), len(codes) - known))[::-1])
        for found in numbered:
            self.uses[found] += 1
            yield self.values[gather(self.starts, self.sizes, found)[0]]


def _remembered(name: int, raw: bytes) -> _Words:
    """One per Python worker: words met in one task are known to the next."""
    return kept(("words", name), lambda: _Words(raw))


def _together(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with the place of their first; a run ends after ``TOGETHER_CHARS`` characters."""
    first, run, chars = 0, [], 0
    for text in texts(column):
        run.append(text)
        chars += len(text)
        if chars >= TOGETHER_CHARS:
            yield first, run
            first, run, chars = first + len(run), [], 0
    if run:
        yield first, run


def _pieces(batches: Iterator[pa.RecordBatch], raw: bytes, capacity: int, end_id: int,
            with_tokens: bool) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    words = _remembered(zlib.crc32(raw), raw)
    for batch in batches:
        keys = batch.column(0)
        for first, part in _together(batch.column(1)):
            rows, piece, start, length, crc, tokens = [], [], [], [], [], []
            for i, ids in enumerate(words.encode(part)):
                ids = np.append(ids, np.array([end_id], "<u4"))
                for n, at in enumerate(range(0, len(ids), capacity)):
                    cut = ids[at:at + capacity]
                    rows.append(first + i)
                    piece.append(n)
                    start.append(at)
                    length.append(len(cut))
                    crc.append(zlib.crc32(cut.tobytes()))
                    if with_tokens:
                        tokens.append(cut.astype(np.int32))
            columns = [keys.take(pa.array(rows)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_tokens:
                columns.append(pa.array(tokens, pa.list_(pa.int32())))
                names.append("tokens")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", raw: bytes | None = None,
             capacity: int = CAPACITY, end_id: int = END_ID, with_tokens: bool = False) -> DataFrame:
    """Pieces of every document: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``tokens`` if asked."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(VOCABULARY) if raw is None else raw)
    schema = StructType([
        StructField("id", docs.schema[id_col].dataType), StructField("piece", IntegerType()),
        StructField("start", LongType()), StructField("length", LongType()),
        StructField("ids_crc32", LongType()),
        *([StructField("tokens", ArrayType(IntegerType()))] if with_tokens else [])])
    made = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        lambda b: _pieces(b, shared.value, capacity, end_id, with_tokens), schema)
    return made.withColumnRenamed("id", id_col)


class _Sums:
    """Which lengths, and which sums of two, are available."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.refresh()

    def refresh(self) -> None:
        self.have = self.counts > 0
        size = 2 * len(self.have)
        wave = np.fft.rfft(self.have, size)
        self.pairs = np.fft.irfft(wave * wave, size)[:len(self.have)] > 0.5

    def allows(self, combination: tuple[int, ...], used: Counter) -> bool:
        return all(self.counts[n] >= k for n, k in (used + Counter(combination)).items())

    def pair(self, gap: int, used: Counter) -> tuple[int, ...] | None:
        half = np.arange(1, gap // 2 + 1)
        for a in half[self.have[half] & self.have[gap - half]]:
            if self.allows((int(gap - a), int(a)), used):
                return int(gap - a), int(a)
        return None

    def complement(self, gap: int, used: Counter) -> tuple[int, ...] | None:
        """One, two or three available lengths that fill the gap exactly, long ones first."""
        if gap <= 0:
            return () if gap == 0 else None
        if self.have[gap] and self.allows((gap,), used):
            return (gap,)
        if self.pairs[gap] and (found := self.pair(gap, used)):
            return found
        longest = np.arange(gap - 2, (gap - 1) // 3, -1)
        for a in longest[self.have[longest] & self.pairs[gap - longest]] if len(longest) else ():
            if self.allows((int(a),), used) and (rest := self.pair(int(gap - a), used + Counter([int(a)]))):
                return int(a), *rest
        return None


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of lengths and how many sequences each fills; together they use every piece."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        counts[length] = count
    sums, steps = _Sums(counts), []

    def use(combination: tuple[int, ...]) -> None:
        times = min(int(counts[n]) // k for n, k in Counter(combination).items())
        for n, k in Counter(combination).items():
            counts[n] -= times * k
        steps.append((combination, times))
        sums.refresh()

    for length in range(capacity, 0, -1):
        while counts[length]:
            rest = sums.complement(capacity - length, Counter([length]))
            if rest is None:
                break
            use((length, *rest))
    while (left := np.flatnonzero(counts)).size:
        combination = [int(left[-1])]
        while gap := capacity - sum(combination):
            used = Counter(combination)
            if (rest := sums.complement(gap, used)) is not None:
                combination.extend(rest)
                break
            fitting = [int(n) for n in left[left <= gap][::-1] if counts[n] > used[int(n)]][:1]
            if not fitting:
                break
            combination.extend(fitting)
        use(tuple(combination))
    return steps


def _number(batches: Iterator[pa.RecordBatch], place: int, capacity: int) -> Iterator[pa.RecordBatch]:
    """Add the partition and each row's number among the partition's rows of its length."""
    partition, met = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
    for batch in batches:
        if batch.column(place).null_count:
            raise ValueError("a piece has no length")
        lengths = batch.column(place).to_numpy().astype(np.int64)
        if len(lengths) and (lengths.min() < 1 or lengths.max() > capacity):
            raise ValueError(f"lengths must be from 1 to {capacity}")
        order = np.argsort(lengths, kind="stable")
        ordered = lengths[order]
        numbers = np.empty(len(lengths), np.int64)
        numbers[order] = np.arange(len(ordered)) - np.searchsorted(ordered, ordered) + met[ordered]
        met += np.bincount(lengths, minlength=capacity + 1)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(lengths), partition)), pa.array(numbers)],
            names=[*batch.schema.names, "__part", "__nth"])


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every piece; a table that has such a column is refused."""
    refuse(["sequence_id", "offset", "__part", "__nth"], pieces.columns)
    schema = StructType([*pieces.schema.fields, StructField("__part", LongType()), StructField("__nth", LongType())])
    place = pieces.columns.index(length_col)
    numbered = stored(pieces.mapInArrow(lambda b: _number(b, place, capacity), schema), "pieces")
    length = F.col(length_col).cast("long")
    counts = numbered.groupBy("__part", length.alias("__length")).agg(F.count(F.lit(1)).alias("__count"))
    earlier = Window.partitionBy("__length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("__part", "__length", F.coalesce(F.sum("__count").over(earlier), F.lit(0)).alias("__base"))
    histogram = {r[0]: r[1] for r in counts.groupBy("__length").agg(F.sum("__count")).collect()}

    taken, sequence, keys, to, offsets = Counter(), 0, [], [], []
    for combination, times in plan(histogram, capacity):
        offset = 0
        for n in combination:
            keys.append((n << 44) + taken[n])
            to.append(sequence - taken[n])
            offsets.append(offset)
            taken[n] += times
            offset += n
        sequence += times
    order = np.argsort(np.array(keys, np.int64))
    steps = tuple(np.array(x, np.int64)[order] for x in (keys, to, offsets))

    joined = numbered.withColumn("__length", length).join(bases, ["__part", "__length"])
    joined = joined.select(*pieces.columns, "__length", (F.col("__base") + F.col("__nth")).alias("__number"))
    result = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()),
                         StructField("offset", LongType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, shifts, places = steps
        for batch in batches:
            numbers = batch.column(batch.num_columns - 1).to_numpy()
            lengths = batch.column(batch.num_columns - 2).to_numpy()
            step = np.searchsorted(firsts, (lengths << 44) + numbers, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(numbers + shifts[step]), pa.array(places[step])],
                names=[*batch.schema.names[:-2], "sequence_id", "offset"])

    return joined.mapInArrow(assign, result)


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as pieces in sequences of 4096 tokens."""
    return pack(tokenize(table(spark, folder, "documents")))
