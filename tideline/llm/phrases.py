"""Phrase collocations from sorted streams of counts.

1. Tasks cut texts into words and count the phrases of up to ``longest`` words of a bounded run of text by sorting word
   numbers. What a run counted is sorted into buckets by a hash of the phrase and goes to tasks that own ``TASK_BUCKETS``
   buckets each, as one compressed block for each run and task. They merge the blocks bucket by bucket and keep phrases with
   ``least`` occurrences or more. A frequent phrase is one item of a run, however often it occurs, and there is a bucket for
   every ``BUCKET_CHARS`` characters of text, so no task grows with the data.
   A phrase's parts are at least as frequent as the phrase, so all counts that it needs are kept.
2. The streams of phrases of every length are merged into one order by words (prefix order) and one by words read
   from the end (suffix order). In prefix order a phrase follows its first words, and its extensions follow
   it; one pass therefore finds the counts of all its beginnings, and the largest count of an extension, among the rows
   that went before or come next. Suffix order gives the same for endings. Nothing is looked up by hash.
   The order is cut into slices of similar size wherever the cuts fall, also inside the phrases of one first
   word; a slice gets the last counts before it, and gives back what it holds for the last phrase before it. These
   tables have one row per slice.
3. The lowest score over all cuts is a phrase's score. A phrase is dropped if an extension by one word is frequent enough;
   longer phrases need no look, as the extension between has at least their count. A top-k per language follows, first
   in groups of a language's phrases, as many as keep the last step as small as a group.

Null texts count as empty, null languages as ``und``. Rows are counted as often as they occur. Texts without words and empty tables
add nothing. Other columns are not read. Texts of any length are read in blocks; phrases across blocks count.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.byte_bpe import Numbers
from tideline.llm.common import small_batches, stored, table

LONGEST = 3
LEAST = 10
# A phrase goes if an extension has this share of its occurrences, in percent.
SHARE = 50
TOP = 2000
SCALE = 1_000_000
# Words and bytes of a run, characters of a block of text, bytes that are cut into words at once, characters of text for
# each bucket, and buckets for each task.
RUN_WORDS = 1_000_000
RUN_BYTES = 32 << 20
BLOCK = 1 << 22
CUT_BYTES = 1 << 20
BUCKET_CHARS = 2 << 20
TASK_BUCKETS = 8
# Rows that a task holds before they are summed up, and bytes of its blocks that it hands over at once.
HELD = 6_000_000
SENT_BYTES = 4 << 20

_TOKEN = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r][ \t.,;:!?\n-\r]*")
_BREAK = re.compile(rb"[ \t.,;:!?\n-\r]")
_ENDS = b".,;:!?\n\x0b\x0c\r"
_WORD, _SPACE, _END = range(3)
_KINDS = np.full(256, _WORD, np.uint8)
_KINDS[list(b" \t")] = _SPACE
_KINDS[list(_ENDS)] = _END
_RUNS = pa.schema([("part", pa.int32()), ("langs", pa.list_(pa.string())), ("size", pa.int64()), ("block", pa.binary())])


def blocks(text: str) -> Iterator[bytes]:
    """A text's bytes with A-Z in lower case, in blocks that end between words."""
    raw, at = text.encode().lower(), 0
    while at < len(raw):
        found = _BREAK.search(raw, at + BLOCK)
        end = found.start() if found else len(raw)
        yield raw[at:end]
        at = end


def tokens(raw: bytes) -> pa.BinaryArray:
    """The words of ``_TOKEN``, and each character that ends a phrase as a token of its own."""
    data = np.frombuffer(raw, np.uint8)
    kinds = _KINDS[data]
    word, kept = kinds == _WORD, kinds != _SPACE
    starts = kept.copy()
    starts[1:] &= ~(word[1:] & word[:-1])
    at = np.flatnonzero(starts[kept])
    offsets = np.append(at, np.count_nonzero(kept)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data[kept])])


class _Run:
    """Counts of the phrases of some texts; word numbers are those of a language in the run."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets, self.size, self.bytes = longest, buckets, 0, 0
        self.waiting: dict[str, list[bytes]] = defaultdict(list)
        self.left = 0
        self.tokens: dict[str, list[pa.BinaryArray]] = defaultdict(list)
        self.known: dict[str, int] = {}

    def add(self, lang: str, raw: bytes) -> None:
        """Append text to that of a language."""
        self.waiting[lang].append(raw)
        self.left += len(raw)
        self.bytes += len(raw)
        if self.left >= CUT_BYTES:
            self.cut()

    def cut(self) -> None:
        for lang, parts in self.waiting.items():
            found = tokens(b"".join(parts))
            self.tokens[lang].append(found)
            self.size += len(found)
        self.waiting.clear()
        self.left = 0

    def full(self) -> bool:
        return self.size >= RUN_WORDS or self.bytes >= RUN_BYTES

    def next(self, lang: str) -> _Run:
        """A run that goes on with a text of a language; phrases that end in its first tokens were counted here."""
        self.cut()
        run, tail, parts = _Run(self.longest, self.buckets), [], self.tokens[lang]
        while len(tail) < self.longest - 1 and parts:
            tail = parts[-1][max(0, len(parts[-1]) - self.longest + 1 + len(tail)):].to_pylist() + tail
            parts = parts[:-1]
        if tail:
            run.tokens[lang].append(pa.array(tail, pa.binary()))
            run.known[lang] = len(tail)
        return run

    def counted(self) -> Iterator[pa.RecordBatch]:
        """The run's phrases in one block for each part of the buckets."""
        self.cut()
        langs, texts, mixed, counts = [], [], [], []
        for lang in list(self.tokens):
            for found in self._phrases(lang, pa.concat_arrays(self.tokens.pop(lang))):
                met = np.flatnonzero(found[2])
                if len(met) < len(found[2]):
                    found = found[0].take(pa.array(met)), found[1][met], found[2][met]
                langs.append(lang)
                texts.append(found[0])
                mixed.append(found[1])
                counts.append(found[2])
        if sum(map(len, texts)):
            yield from self._dealt(langs, texts, np.concatenate(mixed), np.concatenate(counts))

    def _phrases(self, lang: str, words: pa.BinaryArray) -> Iterator[tuple[pa.BinaryArray, np.ndarray, np.ndarray]]:
        """Phrases, their hashes and counts: all words as an empty phrase, then the phrases of each length."""
        coded = words.dictionary_encode()
        codes, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        n, known = max(1, len(names)), self.known.get(lang, 0)
        distinct = names.to_pylist()
        ends = np.array([w[0] in _ENDS for w in distinct], bool)
        hashes = np.array([zlib.crc32(w) for w in distinct], np.uint64)
        inside = ~ends[codes]
        counts = np.bincount(codes[known:][inside[known:]], minlength=len(names))
        yield pa.array([b""], pa.binary()), np.zeros(1, np.uint64), np.array([counts.sum()])
        yield names, hashes, counts
        number, valid, texts, mixed = codes, inside, names, hashes
        for size in range(2, self.longest + 1):
            valid = valid[:-1] & inside[size - 1:]
            pairs = number[:-1][valid] * n + codes[size - 1:][valid]
            found, order = np.unique(pairs, return_inverse=True)
            fresh = np.count_nonzero(valid[:max(0, known - size + 1)])
            counts = np.bincount(order[fresh:], minlength=len(found))
            first, last = found // n, found % n
            texts = pc.binary_join_element_wise(texts.take(pa.array(first)), names.take(pa.array(last)), b" ")
            mixed = (mixed[first] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + hashes[last]
            yield texts, mixed, counts
            number = np.zeros(len(valid), np.int64)
            number[valid] = order

    def _dealt(self, langs: list[str], texts: list[pa.BinaryArray], mixed: np.ndarray, counts: np.ndarray
               ) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        lang = np.repeat([numbers[x] for x in langs], [len(t) for t in texts])
        bucket = ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)).astype(np.int64) % self.buckets
        cell = bucket * len(numbers) + lang
        del mixed, bucket, lang
        order = np.argsort(cell.astype(np.uint16) if cell.max() < 1 << 16 else cell, kind="stable")
        parts = -(-self.buckets // TASK_BUCKETS)
        cells = np.bincount(cell, minlength=parts * TASK_BUCKETS * len(numbers)).astype("<i4").reshape(parts, -1)
        phrases = pa.concat_arrays(texts)
        texts.clear()
        phrases = phrases.take(pa.array(order))
        at = np.frombuffer(phrases.buffers()[1], np.int32, len(phrases) + 1, phrases.offset * 4)
        chars, sizes, counts = phrases.buffers()[2], np.diff(at).astype("<i4"), counts[order].astype("<i4")
        del cell, order
        ends = np.cumsum(cells.sum(1))
        rows, sent = [], 0
        for part in np.flatnonzero(cells.any(1)):
            a, b = ends[part] - cells[part].sum(), ends[part]
            raw = b"".join([cells[part], _planes(counts[a:b]), _planes(sizes[a:b]), chars[at[a]:at[b]]])
            rows.append((part, len(raw), pa.compress(raw, codec="zstd", asbytes=True)))
            sent += len(rows[-1][-1])
            if sent >= SENT_BYTES:
                yield _batch(rows, list(numbers))
                rows, sent = [], 0
        if rows:
            yield _batch(rows, list(numbers))


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers as four byte planes; most high bytes are zero."""
    return values.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes, count: int, at: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8, 4 * count, at).reshape(4, count).T.copy().view("<i4").ravel()


def _batch(rows: list[tuple[int, int, bytes]], langs: list[str]) -> pa.RecordBatch:
    part, size, block = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([langs] * len(rows), pa.list_(pa.string())),
                                       pa.array(size, pa.int64()), pa.array(block, pa.binary())], schema=_RUNS)


def _runs(batches: Iterator[pa.RecordBatch], longest: int, buckets: int) -> Iterator[pa.RecordBatch]:
    run = _Run(longest, buckets)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for block in blocks(text.as_py() or ""):
                run.add(lang, block)
                if run.full():
                    after = run.next(lang)
                    yield from run.counted()
                    run = after
            run.add(lang, b"\n")
    yield from run.counted()


class _Part:
    """Sums of the blocks of some buckets."""

    def __init__(self, least: int):
        self.least, self.names = least, Numbers()
        self.blocks, self.rows = [], 0
        self.sums: list[pa.Table | None] = [None] * TASK_BUCKETS

    def add(self, langs: list[str], raw: bytes) -> None:
        codes = np.array([self.names[x] for x in langs], np.int32)
        cells = np.frombuffer(raw, "<i4", TASK_BUCKETS * len(langs)).reshape(TASK_BUCKETS, -1)
        rows, at = int(cells.sum()), cells.nbytes
        counts, sizes = _from_planes(raw, rows, at), _from_planes(raw, rows, at + 4 * rows)
        ends = np.append(0, np.cumsum(cells.sum(1)))
        chars = at + 8 * rows + np.append(0, np.cumsum(sizes, dtype=np.int64))[ends]
        self.blocks.append((codes, cells, counts, sizes, ends, chars, raw))
        self.rows += rows
        if self.rows >= HELD:
            self.sums = [self.summed(bucket) for bucket in range(TASK_BUCKETS)]
            self.blocks, self.rows = [], 0

    def summed(self, bucket: int) -> pa.Table | None:
        """Language number, phrase and count of all that the blocks and the earlier sums have of a bucket."""
        met = [x for x in self.blocks if x[1][bucket].any()]
        found = [self.sums[bucket]] if self.sums[bucket] else []
        if not met:
            return self.sums[bucket]
        langs = np.repeat(np.concatenate([codes for codes, *_ in met]), np.concatenate([cells[bucket] for _, cells, *_ in met]))
        counts, sizes = (np.concatenate([x[i][x[4][bucket]:x[4][bucket + 1]] for x in met]) for i in (2, 3))
        chars = b"".join([raw[at[bucket]:at[bucket + 1]] for *_, at, raw in met])
        offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
        phrases = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(chars)])
        found.append(pa.table({"lang": langs, "phrase": phrases, "n": counts.astype(np.int64)}))
        return pa.concat_tables(found).group_by(["lang", "phrase"], use_threads=False).aggregate(
            [("n", "sum")]).rename_columns(["lang", "phrase", "n"])

    def kept(self) -> Iterator[pa.RecordBatch]:
        names = pa.array(list(self.names), pa.string())
        for bucket in range(TASK_BUCKETS):
            found = self.summed(bucket)
            if found:
                found = found.filter(pc.or_(pc.greater_equal(found["n"], self.least), pc.equal(found["phrase"], b"")))
                yield pa.RecordBatch.from_arrays(
                    [names.take(found["lang"].combine_chunks()), found["phrase"].combine_chunks().cast(pa.string()),
                     found["n"].combine_chunks()], names=["lang", "phrase", "n"])


def _merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Sums of the blocks of each part, which follow one another: those of ``least`` or more, and the number of words."""
    now, part = None, _Part(least)
    for batch in batches:
        for number, langs, size, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                              batch.column(2).to_pylist(), batch.column(3)):
            if number != now:
                yield from part.kept()
                now, part = number, _Part(least)
            part.add(langs, pa.decompress(block.as_buffer(), size, codec="zstd", asbytes=True))
    yield from part.kept()


def counted(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST,
            least: int = LEAST) -> DataFrame:
    """``lang``, ``words`` and ``n`` of all phrases with ``least`` occurrences; no words: ``n`` of all words."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    chars = texts.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    buckets = 1 + chars // BUCKET_CHARS
    runs = texts.mapInArrow(lambda b: _runs(b, longest, buckets), "part int, langs array<string>, size long, block binary")
    merged = (runs.repartitionById(-(-buckets // TASK_BUCKETS), "part").sortWithinPartitions("part")
              .mapInArrow(lambda b: _merged(b, least), "lang string, phrase string, n long"))
    return stored(merged.select("lang", F.when(F.col("phrase") == "", F.array().cast("array<string>"))
                                .otherwise(F.split("phrase", " ")).alias("words"), "n"), "phrases")


def lockstep(phrases: DataFrame, longest: int, backwards: bool) -> DataFrame:
    """Walk all streams in prefix order, or in suffix order if ``backwards``, and add what a phrase meets there.

    ``first_<m>`` (``last_<m>``): the count of its first (last) m words, for m below its length; ``longer_first``
    (``longer_last``): the largest count of a phrase that it begins (ends) and that has one word more.
    """
    side = "last" if backwards else "first"
    order = F.reverse("words") if backwards else F.col("words")
    rows = stored(phrases.withColumn("__key", order).repartitionByRange("lang", "__key")
                  .sortWithinPartitions("lang", "__key").drop("__key")
                  .withColumn("__slice", F.spark_partition_id()).withColumn("__place", F.monotonically_increasing_id()),
                  f"{side}-order")
    size = F.size("words")
    passed = Window.partitionBy("__slice").orderBy("__place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)

    def last(value: Column, over) -> Column:
        return F.last(value, ignorenulls=True).over(over)

    longer = range(2, longest)
    seen = rows.select("*", *[last(F.when(size == m, F.col("n")), passed).alias(f"__in_{m}") for m in range(longest)],
                       *[last(F.when(size <= m, F.col("__place")), passed).alias(f"__parent_{m}") for m in longer])
    # One row per slice: its last counts and places, and the largest extensions of phrases in earlier slices.
    ends = seen.groupBy("__slice").agg(
        *[F.max_by(f"__in_{m}", "__place").alias(f"__end_{m}") for m in range(longest)],
        *[F.max(f"__parent_{m}").alias(f"__open_{m}") for m in longer],
        *[F.max(F.when(F.col(f"__parent_{m}").isNull() & (size == m + 1), F.col("n"))).alias(f"__orphan_{m}")
          for m in longer])
    carried = stored(ends.select(
        "__slice", *[last(F.col(f"__end_{m}"), earlier).alias(f"__before_{m}") for m in range(longest)],
        *[last(F.col(f"__open_{m}"), earlier).alias(f"__owner_{m}") for m in longer],
        *[f"__orphan_{m}" for m in longer]), "slice-ends")
    out = seen.join(F.broadcast(carried.select("__slice", *[f"__before_{m}" for m in range(longest)])), "__slice")
    most = F.lit(None).cast("long")
    for m in longer:
        family = Window.partitionBy("__slice", f"__parent_{m}")
        adopted = (carried.where(F.col(f"__orphan_{m}").isNotNull())
                   .groupBy(F.col(f"__owner_{m}").alias("__place")).agg(F.max(f"__orphan_{m}").alias(f"__far_{m}")))
        out = (out.withColumn(f"__near_{m}", F.max(F.when(size == m + 1, F.col("n"))).over(family))
               .join(F.broadcast(adopted), "__place", "left"))
        most = F.when(size == m, F.greatest(f"__near_{m}", f"__far_{m}")).otherwise(most)
    return out.select(*phrases.columns,
                      *[F.when(size > m, F.coalesce(f"__in_{m}", f"__before_{m}")).alias(f"{side}_{m}")
                        for m in range(longest)], most.alias(f"longer_{side}"))


def _score(whole: str, left: str, right: str) -> Column:
    return F.expr(f"(CAST({SCALE} AS DECIMAL(38,0)) * CAST({whole} AS DECIMAL(19,0)) * CAST({whole} AS DECIMAL(19,0))) "
                  f"DIV (CAST({left} AS DECIMAL(19,0)) * CAST({right} AS DECIMAL(19,0)))")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST,
                 least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score."""
    streams = counted(docs, lang_col, text_col, longest, least)
    met = lockstep(lockstep(streams, longest, True), longest, False)
    cuts = F.lit(None)
    for size in range(2, longest + 1):
        split = [F.struct(_score("n", f"first_{k}", f"last_{size - k}").alias("score"), F.lit(k).alias("k"),
                          F.col(f"first_{k}").alias("l"), F.col(f"last_{size - k}").alias("r")) for k in range(1, size)]
        cuts = F.when(F.size("words") == size, F.array_min(F.array(*split))).otherwise(cuts)
    longer = F.coalesce(F.greatest("longer_first", "longer_last"), F.lit(0))
    scored = (met.where((F.size("words") > 1) & ~(100 * longer >= share * F.col("n")))
              .select("lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"),
                      F.col("first_0").alias("n"), cuts.alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
    # The best of a language are among the best of each of its groups; a group and what all groups leave are of one size.
    groups = 1 + math.isqrt(streams.count() // max(1, top))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(groups))).orderBy(*order)
    best = Window.partitionBy("lang").orderBy(*order)
    return (scored.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 strongest phrases of two and three words of each language, over all documents."""
    return collocations(table(spark, folder, "documents"))


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
cut AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
grams AS (
  SELECT lang, unnest(flatten(list_transform([1, 2, 3], lambda k: list_transform(
    range(1, len(words) - k + 2), lambda i: words[i:i + k - 1])))) AS words FROM cut),
f AS (SELECT lang, words, count(*)::HUGEINT AS n FROM grams GROUP BY lang, words),
totals AS (SELECT lang, sum(n) AS n FROM f WHERE len(words) = 1 GROUP BY lang),
longer AS (
  SELECT lang, part, max(n) AS n FROM (
    SELECT lang, words[1:2] AS part, n FROM f WHERE len(words) = 3 AND n >= 10
    UNION ALL SELECT lang, words[2:3], n FROM f WHERE len(words) = 3 AND n >= 10) GROUP BY lang, part),
cuts AS (
  SELECT c.lang, c.words, c.n AS a, k, x.n AS l, y.n AS r, (1000000 * c.n * c.n) // (x.n * y.n) AS score
  FROM (SELECT *, unnest(range(1, len(words))) AS k FROM f WHERE len(words) > 1 AND n >= 10) c
  JOIN f x ON x.lang = c.lang AND x.words = c.words[1:c.k]
  JOIN f y ON y.lang = c.lang AND y.words = c.words[c.k + 1:]
  LEFT JOIN longer ON longer.lang = c.lang AND longer.part = c.words
  WHERE longer.n IS NULL OR 100 * longer.n < 50 * c.n),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank FROM lowest)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
  totals.n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
