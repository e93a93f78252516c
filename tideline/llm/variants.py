"""Spelling variants: words one edit apart, by composing finite-state machines.

The words of the vocabulary are an acceptor A; a transducer T inserts, deletes or replaces one character. The paths of
A o T o A are the pairs of words one edit apart. Both words of a pair agree before the edit and after it, so the
composition starts with moves that copy, and the machine is cut by what they read:

1. With L the length of the longer word and p the number of characters before the edit (the longest common beginning), a pair
   belongs to the cell of L, of an interval that holds p, of the beginning up to the interval and the ending after it. Each word goes
   to the cells of both halves of its length, as longer or equal word and as shorter one. Exactly one cell has both words
   of a pair and its p, so no pair is missed or met twice.
2. A cell is the initial state of its part of the composition, and is handled by one task. A cell of more than
   ``CELL_WORDS`` words is cut again at the middle of its interval, as often as needed: an interval of one character leaves at most one
   word per letter of the alphabet. So no task holds more than a bounded number of words, however alike words are.
3. In a cell, what its words have between beginning and ending is made a minimal acceptor, which shares
   beginnings and endings of words. Its composition with T and itself is walked through once per pair of states; accepted
   paths are numbers of words. Each word's near words and the most frequent of them are summed up before anything is shuffled.
4. A word's form is its most frequent near word, if that is ``RATIO`` times as frequent. As counts rise along forms, chains are short;
   joins of words with words follow them to the end, doubling the steps each time.

Null and empty texts have no words. Rows are counted as often as they occur; a null id counts as the text ``null``. Equal counts go to the
word that is smaller by code points. Texts and words may have any length. Only the two columns are read. An empty table gives an empty one.
"""

from __future__ import annotations

import re
import sys
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import checkpointed, small_batches, stored, table

MIN_CHARS = 7
MIN_COUNT = 2
RATIO = 10
# One occurrence of so many loses a character, chosen by a checksum of document and word.
DAMAGED = 31
CELL_WORDS = 20_000
# Distinct words a task counts before it hands them on.
HELD = 400_000

_RUN = re.compile("[a-zÀ-ÿ]+")
CELL = ["size", "low", "high", "begins", "ends"]


def damaged(doc: object, run: str) -> str:
    """The run as it counts: without one character where the checksum says so."""
    h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
    at = h % len(run)
    return run if h % DAMAGED else run[:at] + run[at + 1:]


def _counted(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    met = Counter()

    def handed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(met), pa.string()), pa.array(list(met.values()), pa.int64())],
                                          names=["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            runs = Counter(_RUN.findall((text.as_py() or "").encode().lower().decode()))
            start = zlib.crc32(f"{'null' if doc is None else doc}:".encode())
            for run, n in runs.items():
                if len(run) >= least:
                    if not zlib.crc32(run.encode(), start) % DAMAGED:
                        run = damaged(doc, run)
                        if len(run) < least:
                            continue
                    met[run] += n
            if len(met) >= HELD:
                yield handed()
                met.clear()
    if met:
        yield handed()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               min_count: int = MIN_COUNT) -> DataFrame:
    """``word`` and ``n`` of the words that are long and frequent enough."""
    small_batches(docs.sparkSession)
    counts = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(lambda b: _counted(b, min_chars), "word string, n long")
    return stored(counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "vocabulary")


class Acceptor:
    """The minimal acyclic automaton of sorted distinct words; an accepted path has its word's number."""

    def __init__(self, words: list[str]):
        self.arcs: list[list[tuple[str, int]]] = []  # of each state, by character
        self.final: list[bool] = []
        self.count: list[int] = []  # words accepted from each state
        known: dict[tuple, int] = {}

        def made(final: bool, arcs: list[tuple[str, int]]) -> int:
            key = (final, *arcs)
            state = known.get(key)
            if state is None:
                state = known[key] = len(self.arcs)
                self.arcs.append(arcs)
                self.final.append(final)
                self.count.append(final + sum(self.count[t] for _, t in arcs))
            return state

        # States of the path of the last word; each is made when no word can add to it.
        path: list[list] = [[False, []]]
        last = ""
        for word in words:
            shared = 0
            while shared < len(last) and shared < len(word) and last[shared] == word[shared]:
                shared += 1
            for i in range(len(last), shared, -1):
                final, arcs = path.pop()
                path[-1][1].append((last[i - 1], made(final, arcs)))
            path.extend([False, []] for _ in word[shared:])
            path[-1][0] = True
            last = word
        for i in range(len(last), 0, -1):
            final, arcs = path.pop()
            path[-1][1].append((last[i - 1], made(final, arcs)))
        self.start = made(*path[0])
        # How many words come before those of each arc.
        self.before: list[list[int]] = []
        for final, arcs in zip(self.final, self.arcs):
            passed, at = [], int(final)
            for _, t in arcs:
                passed.append(at)
                at += self.count[t]
            self.before.append(passed)


def near_pairs(words: list[str], follows: str = "") -> Iterator[tuple[int, int]]:
    """Numbers of the words one edit apart, by the paths of A o T o A; the longer word first, or the smaller of equally long ones.

    The words all go on with an ending that starts with ``follows``. A pair counts where its longest common beginning ends, so a
    pair whose words agree into that ending is not one of these.
    """
    a = Acceptor(words)
    # Calls nest as deep as words are long.
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1000 + 2 * max(map(len, words), default=0)))
    arcs, before, final, count = a.arcs, a.before, a.final, a.count
    common: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def both(p: int, q: int) -> list[tuple[int, int]]:
        """After the edit: the words that both states accept, by their numbers from each."""
        if p == q:
            return [(i, i) for i in range(count[p])]
        found = common.get((p, q))
        if found is None:
            found = [(0, 0)] if final[p] and final[q] else []
            i, j, left, right = 0, 0, arcs[p], arcs[q]
            while i < len(left) and j < len(right):
                if left[i][0] == right[j][0]:
                    x, y = before[p][i], before[q][j]
                    found += [(x + m, y + n) for m, n in both(left[i][1], right[j][1])]
                    i, j = i + 1, j + 1
                elif left[i][0] < right[j][0]:
                    i += 1
                else:
                    j += 1
            common[p, q] = found
        return found

    edits: dict[int, list[tuple[int, int]]] = {}

    def edited(s: int) -> list[tuple[int, int]]:
        """The edit right at state ``s``: another character, or one that only the first word has."""
        found = edits.get(s)
        if found is None:
            found = []
            for i, (c, t) in enumerate(arcs[s]):
                for j in range(i + 1, len(arcs[s])):
                    found += [(before[s][i] + m, before[s][j] + n) for m, n in both(t, arcs[s][j][1])]
                if final[s] and final[t] and c != follows:
                    found.append((before[s][i], 0))
                for j, (e, u) in enumerate(arcs[t]):
                    if e != c:
                        k = bisect_left(arcs[s], (e, -1))
                        if k < len(arcs[s]) and arcs[s][k][0] == e:
                            x, y = before[s][i] + before[t][j], before[s][k]
                            found += [(x + m, y + n) for m, n in both(u, arcs[s][k][1])]
            edits[s] = found
        return found

    # The copying moves before the edit: every state along every word, once for each beginning.
    waiting = [(a.start, 0)]
    while waiting:
        s, number = waiting.pop()
        for m, n in edited(s):
            yield number + m, number + n
        waiting += [(t, number + passed) for (_, t), passed in zip(arcs[s], before[s]) if count[t] > 1]


def _best(old: tuple[int, str] | None, n: int, word: str) -> tuple[int, str]:
    return (n, word) if old is None or n > old[0] or (n == old[0] and word < old[1]) else old


def _cell(size: int, low: int, high: int, words: list[str], counts: list[int]) -> tuple[list, list, list, list]:
    """For the words of a cell: the word, its near words here, and count and name of the best."""
    tail = size - high
    inner = [w[low:len(w) - tail] for w in words]
    order = sorted(range(len(words)), key=inner.__getitem__)
    follows = words[0][len(words[0]) - tail] if tail else ""
    near: Counter = Counter()
    best: dict[int, tuple[int, str]] = {}
    for m, n in near_pairs([inner[i] for i in order], follows):
        i, j = order[m], order[n]
        # Two shorter words are a pair of the cells of their own length.
        if len(words[i]) == size or len(words[j]) == size:
            near[i] += 1
            near[j] += 1
            best[i] = _best(best.get(i), counts[j], words[j])
            best[j] = _best(best.get(j), counts[i], words[i])
    found = list(near)
    return ([words[i] for i in found], [near[i] for i in found], [best[i][0] for i in found], [best[i][1] for i in found])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk cells, whose rows follow one another."""
    now, words, counts = None, [], []
    out: tuple[list, list, list, list] = ([], [], [], [])

    def done() -> None:
        if len(words) > 1:
            for column, values in zip(out, _cell(*now[:3], words, counts)):
                column.extend(values)

    def handed() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
             pa.array(out[3], pa.string())], names=["word", "near", "best_n", "best"])
        for column in out:
            column.clear()
        return batch

    for batch in batches:
        for *cell, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if cell != now:
                done()
                now, words, counts = cell, [], []
            words.append(word)
            counts.append(n)
        if len(out[0]) >= 50_000:
            yield handed()
    done()
    if out[0]:
        yield handed()


def _keyed(rows: DataFrame) -> DataFrame:
    """Beginnings and endings of the words of ``size``, ``low``, ``high``, ``word`` and ``n``."""
    tail = F.col("size") - F.col("high")
    return rows.select("size", "low", "high", F.substring(F.col("word"), F.lit(1), F.col("low")).alias("begins"),
                       F.substring(F.col("word"), F.length("word") - tail + 1, tail).alias("ends"), "word", "n")


def _halved(rows: DataFrame, low: str, high: str) -> DataFrame:
    middle = ((F.col(low) + F.col(high)) / 2).cast("int")
    parts = F.array(F.struct(F.col(low).alias("low"), middle.alias("high")),
                    F.struct(middle.alias("low"), F.col(high).alias("high")))
    return rows.withColumn("__part", F.explode(parts)).select("size", "__part.low", "__part.high", "word", "n")


def cells(words: DataFrame, limit: int = CELL_WORDS) -> DataFrame:
    """Rows (cell, word, n): every word in all its cells; cells hold at most ``limit`` words, or one per letter."""
    sized = words.withColumn("size", F.explode(F.array(F.length("word"), F.length("word") + 1)))
    rows = _keyed(_halved(sized.withColumn("low", F.lit(0)), "low", "size"))
    done = []
    while True:
        rows = stored(rows, "cells")
        # Stored first, so that a join on a frequent cell can be split.
        crowded = stored(rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias("__count"))
                         .where((F.col("__count") > limit) & (F.col("high") - F.col("low") > 1)).select(*CELL), "crowded")
        if crowded.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(crowded, CELL, "left_anti"))
        rows = _keyed(_halved(rows.join(crowded, CELL, "left_semi"), "low", "high"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def neighbours(words: DataFrame, limit: int = CELL_WORDS) -> DataFrame:
    """``word``, ``n_near``, and ``form_n`` and ``form`` of the best near word, for the words that have one."""
    dealt = cells(words, limit).repartition(*CELL).sortWithinPartitions(*CELL)
    found = dealt.select(*CELL, "word", "n").mapInArrow(_cells, "word string, near long, best_n long, best string")
    # The largest count first, then the smallest word.
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("form")))
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("form_n"), F.col("b.form").alias("form")))


def variants(words: DataFrame, ratio: int = RATIO, limit: int = CELL_WORDS) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of (word, n)."""
    large = F.col("form_n") >= ratio * F.col("n")
    found = stored(words.join(neighbours(words, limit), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, F.col("form")).alias("form"), F.when(large, F.col("form_n")).alias("form_n")), "forms")
    ahead = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        step = ahead.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        moved = checkpointed(ahead.join(step, "root", "left"))
        ahead = moved.select("word", F.coalesce("__next", "root").alias("root"))
        if moved.where("__next IS NOT NULL").isEmpty():
            break
    return (found.join(ahead, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))


def op12_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the vocabulary of all documents, with its form and root."""
    return variants(vocabulary(table(spark, folder, "documents"))).select("word", "form", "root", "n", "n_near", "form_n")
