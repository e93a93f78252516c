"""Quality rules with a linear-chain conditional random field over lines.

1. Fixed counts of a text: words, their code points, symbols, lines that repeat an earlier line, and words in
   five-word windows that occur more than once. Two of them reject a text outright (``base_failed``).
2. The lines that have a word are a sequence. Each has features: shares of its characters by class, length and mean word length, how
   it begins and ends, whether it or its words repeat, at once or anywhere. A conditional random field with two states, content and
   boilerplate, scores a line by its features and a pair of neighbours by a transition; Viterbi decoding finds the best labels
   of all lines of the text together.
3. A text is kept if lines of content hold at least ``MIN_CONTENT`` of its words.

The field is fitted on the driver, on a bounded sample: at most ``FIT_ROWS`` labelled documents, half of each label, drawn by a hash of
their id, of each at most ``FIT_RUNS`` evenly spaced runs of ``FIT_LINES`` lines. All three are parameters of ``train``. Labels
are those of documents: lines of a good one are content; lines of a bad one start as boilerplate, and the fitted field
labels them anew, ``ROUNDS`` times, so that sound lines in bad documents are learned as content. Documents that the counts
reject say nothing about lines and are left out. Rows whose id's CRC-32 is divisible
by 5 are never learned from. Judging covers every line of every text.

Null and empty texts have no words, so they fail. Rows are judged one by one: repeated rows and null ids get a result each. Ties in decoding
go to content. Without usable labels of both kinds all lines are content. Labels that are null, contradict each other
or belong to null ids are not learned from; of documents that share an id the least text is. An empty table gives
an empty result. Other columns are not read, whatever their names; ``retain`` keeps them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from tideline.llm.byte_bpe import Numbers
from tideline.llm.common import drawn, small_batches, table

MIN_WORDS = 10
MAX_REPEATED = 20  # percent of a text's words
WINDOW = 5
MIN_CONTENT = 0.5
FIT_ROWS = 1000
FIT_LINES = 32
FIT_RUNS = 4
ROUNDS = 3
STEPS = 120
# Texts are looked at together up to this many characters.
TOGETHER_CHARS = 1 << 19

_WORD = re.compile("[^\x20\x09-\x0D]+")
_BLANK = " \t\n\x0b\x0c\r"
# Classes of bytes; bytes that go on with a character have none.
_CLASSES = ["blank", "lower", "upper", "digit", "symbol", "stop", "shout", "bar", "other", "wide", "inner"]
_CLASS = np.full(256, _CLASSES.index("other"), np.uint8)
for _name, _bytes in (("blank", b" \t\n\x0b\x0c\r"), ("lower", bytes(range(97, 123))), ("upper", bytes(range(65, 91))),
                      ("digit", b"0123456789"), ("symbol", b"#*$%&<>"), ("stop", b"."), ("shout", b"!?"), ("bar", b"|"),
                      ("inner", bytes(range(0x80, 0xC0))), ("wide", bytes(range(0xC0, 0x100)))):
    _CLASS[list(_bytes)] = _CLASSES.index(_name)
FEATURES = ["one", "words", "upper", "digit", "symbol", "shout", "bar", "other", "wide", "word_length", "capital",
            "ends", "repeated", "stutter", "duplicate"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass
class Lines:
    """The lines with a word of some texts, one text after the other."""

    sizes: np.ndarray  # lines of each text
    places: np.ndarray  # number of each line in its text, all lines counted
    words: np.ndarray  # words of each line
    features: np.ndarray
    counts: dict[str, np.ndarray]  # of each text


def _repeated(codes: np.ndarray) -> np.ndarray:
    """Which words lie in a window that occurs more than once. Texts do not share codes."""
    marks = np.zeros(len(codes) + 1, np.int64)
    if len(codes) >= WINDOW:
        n, number = int(codes[-WINDOW:].max(initial=0)) + int(codes.max()) + 1, codes
        for size in range(2, WINDOW + 1):
            _, number, times = np.unique(number[:-1] * n + codes[size - 1:], return_inverse=True, return_counts=True)
        twice = np.flatnonzero(times[number] > 1)
        np.add.at(marks, twice, 1)
        np.add.at(marks, twice + WINDOW, -1)
    return np.cumsum(marks)[:-1] > 0


def look(texts: list[str | None]) -> Lines:
    """Counts of texts and features of their lines."""
    split = [(t or "").split("\n") for t in texts]
    raw = np.frombuffer(("\n".join(t or "" for t in texts) + "\n").encode(), np.uint8)
    kinds = _CLASS[raw]
    ends = np.flatnonzero(raw == 10)
    starts = np.append(0, ends[:-1] + 1)
    # A line break belongs to the line before it.
    shares = {name: np.add.reduceat(kinds == i, starts, dtype=np.int64) for i, name in enumerate(_CLASSES)}
    inside = kinds != _CLASSES.index("blank")
    begins = inside & ~np.append(False, inside[:-1])
    words = np.add.reduceat(begins, starts, dtype=np.int64)
    firsts = np.flatnonzero(begins)
    text_of = np.repeat(np.arange(len(texts)), [len(lines) for lines in split])

    codes, known = [], 0
    for text in texts:
        found = _WORD.findall(text or "")
        numbers = Numbers()
        codes.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)) + known)
        known += len(numbers)
    codes = np.concatenate(codes)
    line_of_word = np.repeat(np.arange(len(words)), words)
    repeated_words = np.bincount(line_of_word[_repeated(codes)], minlength=len(words))
    stutters = np.bincount(line_of_word[1:][codes[1:] == codes[:-1]], minlength=len(words))

    duplicate = np.zeros(len(words), bool)
    at = 0
    for lines in split:
        seen = set()
        for line in lines:
            if words[at]:
                duplicate[at] = line in seen
                seen.add(line)
            at += 1

    def summed(values: np.ndarray) -> np.ndarray:
        return np.bincount(text_of, weights=values, minlength=len(texts)).astype(np.int64)

    chars = sum(shares[name] for name in _CLASSES if name not in ("blank", "inner"))
    counts = {"n_words": summed(words), "word_chars": summed(chars), "n_symbols": summed(shares["symbol"] + shares["bar"]),
              "n_dup_lines": summed(duplicate), "n_repeat_words": summed(repeated_words)}
    used = words > 0
    n, w = chars[used].astype(float), words[used].astype(float)
    first = raw[firsts[np.cumsum(words)[used] - words[used]]] if len(firsts) else np.zeros(0, np.uint8)
    # The last byte of a line's last word.
    last = np.maximum.accumulate(np.where(inside, np.arange(len(raw)), 0))[ends[used]]
    letters = np.maximum(1, shares["lower"] + shares["upper"] + shares["wide"])[used]
    features = np.stack([
        np.ones(len(n)), np.log1p(w) / 4, shares["upper"][used] / letters, shares["digit"][used] / n,
        np.minimum(1, shares["symbol"][used] / w), np.minimum(1, shares["shout"][used] / w),
        np.minimum(1, shares["bar"][used] / w), np.minimum(1, shares["other"][used] / w), shares["wide"][used] / letters,
        np.minimum(2, n / w / 10), (_CLASS[first] == _CLASSES.index("upper")).astype(float),
        np.isin(raw[last], np.frombuffer(b".!?", np.uint8)).astype(float),
        repeated_words[used] / w, stutters[used] / w, duplicate[used].astype(float)], axis=1)
    line_in_text = np.arange(len(words)) - np.repeat(np.cumsum([0, *map(len, split)])[:-1], list(map(len, split)))
    return Lines(np.bincount(text_of[used], minlength=len(texts)), line_in_text[used], words[used], features, counts)


def _longest_first(sizes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Where sequences start, long ones first, and how many have a line at each place."""
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    longest = int(sizes.max(initial=0))
    return starts, [int(k) for k in len(sizes) - np.searchsorted(np.sort(sizes), np.arange(longest), side="right")]


@dataclass
class Field:
    """A linear-chain conditional random field; state 0 is content, 1 is boilerplate."""

    weights: np.ndarray  # features x states
    moves: np.ndarray  # from state x to state
    first: np.ndarray

    @staticmethod
    def blank(features: int) -> Field:
        return Field(np.zeros((features, 2)), np.zeros((2, 2)), np.zeros(2))

    def decode(self, features: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The best states of all sequences, by Viterbi's recursion over all of them together."""
        emitted = features @ self.weights
        starts, active = _longest_first(sizes)
        states = np.zeros(len(features), np.int8)
        if not active:
            return states
        came = np.zeros((len(features), 2), np.int8)
        best = self.first + emitted[starts[:active[0]]]
        for t in range(1, len(active)):
            at = starts[:active[t]] + t
            paths = best[:active[t], :, None] + self.moves
            came[at] = paths.argmax(axis=1)
            best[:active[t]] = paths.max(axis=1) + emitted[at]
        last = starts[:active[0]] + np.sort(sizes)[::-1][:active[0]] - 1
        states[last] = best.argmax(axis=1)
        for t in range(len(active) - 1, 0, -1):
            at = starts[:active[t]] + t
            states[at - 1] = came[at, states[at]]
        return states

    def gradient(self, features: np.ndarray, sizes: np.ndarray, states: np.ndarray) -> tuple[float, Field]:
        """Log-likelihood of the states, and its gradient, by the forward-backward recursion."""
        emitted = features @ self.weights
        starts, active = _longest_first(sizes)
        forward, backward = np.zeros((len(features), 2)), np.zeros((len(features), 2))
        begin = starts[:active[0]]
        forward[begin] = self.first + emitted[begin]
        for t in range(1, len(active)):
            at = starts[:active[t]] + t
            forward[at] = np.logaddexp.reduce(forward[at - 1][:, :, None] + self.moves, axis=1) + emitted[at]
        for t in range(len(active) - 1, 0, -1):
            at = starts[:active[t]] + t
            backward[at - 1] = np.logaddexp.reduce(self.moves + (emitted[at] + backward[at])[:, None, :], axis=2)
        total = np.logaddexp.reduce(self.first + emitted[begin] + backward[begin], axis=1)
        follows = np.ones(len(features), bool)
        follows[begin] = False
        at = np.flatnonzero(follows)
        whole = np.zeros(len(features))
        whole[begin] = total
        whole = whole[np.maximum.accumulate(np.where(follows, 0, np.arange(len(features))))]
        share = np.exp(forward + backward - whole[:, None])
        pairs = np.exp(forward[at - 1][:, :, None] + self.moves + (emitted[at] + backward[at])[:, None, :]
                       - whole[at][:, None, None])
        seen = np.eye(2)[states]
        likelihood = (emitted[np.arange(len(states)), states].sum() + self.first[states[begin]].sum()
                      + self.moves[states[at - 1], states[at]].sum() - total.sum())
        met = np.zeros((2, 2))
        np.add.at(met, (states[at - 1], states[at]), 1)
        return likelihood, Field(features.T @ (seen - share), met - pairs.sum(axis=0), (seen - share)[begin].sum(axis=0))


def fit(features: np.ndarray, sizes: np.ndarray, states: np.ndarray, steps: int = STEPS, decay: float = 1e-4) -> Field:
    """The field of largest likelihood, less ``decay`` times the squared weights, by Adam."""
    field = Field.blank(features.shape[1])
    names = ("weights", "moves", "first")
    first = {k: np.zeros_like(getattr(field, k)) for k in names}
    second = {k: np.zeros_like(getattr(field, k)) for k in names}
    for step in range(1, steps + 1):
        _, slope = field.gradient(features, sizes, states)
        for k in names:
            g = getattr(slope, k) / len(features) - 2 * decay * getattr(field, k)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            moved = 0.2 * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
            setattr(field, k, getattr(field, k) + moved)
    return field


def _failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED * counts["n_words"])


def _drawn_runs(texts: list[str], labels: np.ndarray, lines: int, runs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, sizes and label of evenly spaced runs of lines of each text that the counts do not reject."""
    features, sizes, marks = [np.zeros((0, len(FEATURES)))], [], []
    for text, label in zip(texts, labels):
        seen = look([text])
        n = 0 if _failed(seen.counts)[0] else int(seen.sizes[0])
        pieces = -(-n // lines)
        for i in sorted({int(x) for x in np.linspace(0, pieces - 1, min(runs, pieces)).round()}) if n else ():
            part = seen.features[i * lines:(i + 1) * lines]
            features.append(part)
            sizes.append(len(part))
            marks.append(label)
    return np.concatenate(features), np.array(sizes, np.int64), np.array(marks, np.int64)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          rows: int = FIT_ROWS, lines: int = FIT_LINES, runs: int = FIT_RUNS, rounds: int = ROUNDS) -> Field:
    """Fit to at most ``rows`` labelled documents, none of them held out."""
    usable = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)
                           & (F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0))
              .groupBy(F.col(id_col).alias("__id"))
              .agg(F.min(label_col).cast("int").alias("__label"), F.max(label_col).cast("int").alias("__most"))
              .where(F.col("__label") == F.col("__most")).drop("__most"))
    sample = drawn(usable.where("__label = 0"), rows // 2, "__id").unionByName(
        drawn(usable.where("__label = 1"), rows // 2, "__id"))
    # At most `rows` ids, a bound that is a parameter.
    found = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(sample), "__id")
             .groupBy("__id", "__label").agg(F.min("__text").alias("__text")).orderBy("__id").collect())
    marks = np.array([1 - r["__label"] for r in found], np.int64)
    features, sizes, marks = _drawn_runs([r["__text"] for r in found], marks, lines, runs)
    if len(set(marks.tolist())) < 2:
        return Field.blank(len(FEATURES))
    bad = np.repeat(marks, sizes)
    states, field = bad.copy(), Field.blank(len(FEATURES))
    for _ in range(rounds):
        field = fit(features, sizes, states)
        again = np.where(bad == 1, field.decode(features, sizes), 0)
        # A run of a bad document in which nothing is found stays boilerplate.
        none = np.add.reduceat(again, np.cumsum(sizes) - sizes) == 0
        again = np.where(np.repeat(none, sizes) & (bad == 1), 1, again)
        if (again == states).all():
            break
        states = again
    return field


def _groups(column: pa.Array) -> Iterator[list[str | None]]:
    group, chars = [], 0
    for value in column:
        text = value.as_py()
        group.append(text)
        chars += len(text or "")
        if chars >= TOGETHER_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


def _judged(column: pa.Array, field: Field, share: float) -> dict[str, pa.Array]:
    """Result columns for a column of texts."""
    out = {name: [np.zeros(0, np.int64)] for name in [*COUNTS, "content_words"]}
    boilerplate = []
    for group in _groups(column):
        seen = look(group)
        states = field.decode(seen.features, seen.sizes)
        owner = np.repeat(np.arange(len(group)), seen.sizes)
        for name in COUNTS:
            out[name].append(seen.counts[name])
        out["content_words"].append(np.bincount(owner, weights=seen.words * (states == 0), minlength=len(group)).astype(np.int64))
        marked = states == 1
        cuts = np.cumsum(np.bincount(owner[marked], minlength=len(group)))[:-1]
        boilerplate += [part.astype(np.int32) for part in np.split(seen.places[marked], cuts)]
    found = {name: np.concatenate(parts) for name, parts in out.items()}
    failed = _failed(found)
    kept = ~failed & (found["content_words"] >= share * found["n_words"])
    return {**{name: pa.array(values) for name, values in found.items()}, "base_failed": pa.array(failed),
            "kept": pa.array(kept), "boilerplate": pa.array(boilerplate, pa.list_(pa.int32()))}


def judge(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text",
          share: float = MIN_CONTENT) -> DataFrame:
    """A row per document: its id, the counts, ``content_words``, ``base_failed``, ``kept``, and ``boilerplate``, the numbers of such lines."""
    small_batches(docs.sparkSession)
    schema = StructType([
        StructField(id_col, docs.schema[id_col].dataType), *[StructField(c, LongType()) for c in [*COUNTS, "content_words"]],
        StructField("base_failed", BooleanType()), StructField("kept", BooleanType()),
        StructField("boilerplate", ArrayType(IntegerType()))])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _judged(batch.column(1), field, share)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(found[f.name] for f in schema.fields[1:])],
                                             names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(judged, schema)


def retain(docs: DataFrame, field: Field, text_col: str = "text", share: float = MIN_CONTENT) -> DataFrame:
    """The rows whose texts are kept, with all their columns."""
    small_batches(docs.sparkSession)
    place = docs.columns.index(text_col)
    return docs.mapInArrow(lambda batches: (b.filter(_judged(b.column(place), field, share)["kept"]) for b in batches),
                           docs.schema)


def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict for all documents; the field learns from the labels that are not held out."""
    docs = table(spark, folder, "documents")
    field = train(docs, table(spark, folder, "labels"))
    return judge(docs, field).select("doc_id", *COUNTS, "base_failed", "kept", "content_words")
