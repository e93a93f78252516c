"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions, in numpy.

Characters are reduced to classes (lower case, upper case, digit, white space, each mark that matters, the rest).
A forward and a backward LSTM read a window and give each character a score per tag (none, e-mail, ip, card,
phone); the CRF's transitions weigh neighbouring tags and the best path is decoded. Gates are piecewise linear,
which numpy computes fast. Windows overlap and cover every character of every text. Where two windows overlap, the one whose
nearer edge lies further away decides, and spans are read off the tags of the whole text, so a span may
cross windows. A window needs no search for its path when a bound shows that no path can beat "none" throughout.

The network is trained from labelled spans: the patterns' matches in at most ``FIT_ROWS`` documents that hold
a digit or an at sign, in at most ``FIT_WINDOWS`` windows, fitted on the driver; both bounds are parameters. It
adds spans that the patterns miss; a pattern's match always stays, and an added span never overlaps one.

Null and empty texts have no spans. Rows are treated one by one: repeated rows and null ids each give a
result. Without any span to learn from nothing is added. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from tideline.llm.common import free, refuse, release, table

KINDS = ("email", "ip", "card", "phone")
WINDOW = 512
OVERLAP = 64
HIDDEN = 8
TAGS = 1 + len(KINDS)
FIT_ROWS = 2000
FIT_WINDOWS = 3000
FIT_LENGTH = 128
EXCERPT = 4000
FIT_SPANS = 20
STEPS = 220
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, so starts inside a run need no trial.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SEPARATORS = str.maketrans("", "", " +().-")

# Classes: 0 padding, 1 other, 2 lower case, 3 upper case, 4 digit, 5 white space, then single marks.
_MARKS = ".@-_+%(),:=\"/'"
_CLASS = np.ones(128, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[9, 10, 11, 12, 13, 32]] = 2, 3, 4, 5
for _i, _c in enumerate(_MARKS):
    _CLASS[ord(_c)] = 6 + _i
CLASSES = 6 + len(_MARKS) + 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
        end = match.end() if match else at + 1
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by kind and start."""
    out = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 16 <= len(m[0]) and 16 <= len(digits := m[0].translate(_SEPARATORS)) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(m[0].translate(_SEPARATORS)) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def classes(text: str) -> np.ndarray:
    """Class of every character; letters beyond ASCII count as lower case."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(codes < 128, _CLASS[np.minimum(codes, 127)], np.uint8(2))


def window_starts(length: int) -> np.ndarray:
    return np.arange(0, max(1, length - OVERLAP), WINDOW - OVERLAP)


@dataclass
class Tagger:
    """Weights of both directions, of the tag scores, and transitions between tags."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def initial(rng: np.random.Generator) -> Tagger:
        w = {"transitions": np.zeros((TAGS, TAGS), np.float32), "bias": np.zeros(TAGS, np.float32)}
        for side in ("forward", "backward"):
            inputs = rng.normal(0, 0.3, (CLASSES, 4 * HIDDEN)).astype(np.float32)
            # Gates are in, forget, out, then the candidate; a gate's linear part runs from 0 to 1.
            inputs[:, :3 * HIDDEN] = 0.3 * inputs[:, :3 * HIDDEN] + 0.5
            inputs[:, HIDDEN:2 * HIDDEN] += 0.3
            w[f"{side}_in"] = inputs
            w[f"{side}_state"] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            w[f"{side}_tags"] = rng.normal(0, 0.3, (HIDDEN, TAGS)).astype(np.float32)
        return Tagger(w)

    def tag_scores(self, windows: np.ndarray) -> np.ndarray:
        """Scores (length, tags, windows) of class windows (windows, length).

        Windows lie along the last axis, so that every step works on whole rows.
        """
        n, length = windows.shape
        out = np.empty((length, TAGS, n), np.float32)
        out[:] = self.weights["bias"][:, None]
        by_place = np.ascontiguousarray(windows.T)
        # One product does both the inputs, as columns that are 1 for a character's class, and the state.
        joined = np.zeros((CLASSES + HIDDEN, n), np.float32)
        chosen, hidden = joined[:CLASSES], joined[CLASSES:]
        names = np.arange(CLASSES, dtype=np.uint8)[:, None]
        gates, cell, fresh = (np.empty((k * HIDDEN, n), np.float32) for k in (4, 1, 1))
        sigmoid, candidate = gates[:3 * HIDDEN], gates[3 * HIDDEN:]
        tagged = np.empty((TAGS, n), np.float32)
        there = (by_place > 0).astype(np.float32)
        padded = (by_place == 0).any(axis=1)
        for side in ("forward", "backward"):
            both = np.ascontiguousarray(
                np.vstack([self.weights[f"{side}_in"], self.weights[f"{side}_state"]]).T)
            tags = np.ascontiguousarray(self.weights[f"{side}_tags"].T)
            cell[:], hidden[:] = 0, 0
            for t in range(length) if side == "forward" else range(length - 1, -1, -1):
                np.equal(by_place[t], names, out=chosen, casting="unsafe")
                np.matmul(both, joined, out=gates)
                np.clip(sigmoid, 0, 1, out=sigmoid)
                np.clip(candidate, -1, 1, out=candidate)
                cell *= gates[HIDDEN:2 * HIDDEN]
                np.multiply(gates[:HIDDEN], candidate, out=fresh)
                cell += fresh
                np.clip(cell, -1, 1, out=cell)
                np.multiply(gates[2 * HIDDEN:3 * HIDDEN], cell, out=hidden)
                # Padding leaves no trace, so a text's scores do not depend on the texts beside it.
                if padded[t]:
                    cell *= there[t]
                    hidden *= there[t]
                out[t] += np.matmul(tags, hidden, out=tagged)
        return out

    def paths(self, windows: np.ndarray) -> np.ndarray:
        """Best tags (windows, length); padding gets tag 0."""
        scores = self.tag_scores(windows)
        move = self.weights["transitions"]
        # A run of m tags gains on "none" throughout at most its characters' gains, m - 1 times the best move inside a
        # run, and the best moves into and out of it. Where no run gains anything, no path is searched.
        inside = move[1:, 1:].max() - move[0, 0]
        edges = max(0, move[0, 1:].max() - move[0, 0]) + max(0, move[1:, 0].max() - move[0, 0])
        gain = scores[:, 1:].max(axis=1) - scores[:, 0] + inside
        gain[windows.T == 0] = -np.inf
        run = most = np.full(len(windows), -np.inf, np.float32)
        for row in gain:
            run = np.maximum(run, 0) + row
            most = np.maximum(most, run)
        out = np.zeros(windows.shape, np.uint8)
        able = np.flatnonzero(most - inside + edges > 0)
        if len(able):
            out[able] = _best(scores[:, :, able].transpose(0, 2, 1), move)
        out[windows == 0] = 0
        return out

    def added(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """Spans per text that overlap no base span."""
        found = [classes(t) for t in texts]
        starts = [window_starts(len(c)) for c in found]
        tags = [np.zeros(len(c), np.uint8) for c in found]
        best = [np.full(len(c), -1, np.int32) for c in found]
        jobs = [(min(WINDOW, len(found[i]) - int(s)), i, int(s))
                for i, ss in enumerate(starts) for s in ss if len(found[i])]
        # Windows of like length together, so that little is padding.
        jobs.sort()
        for first in range(0, len(jobs), 1024):
            part = jobs[first:first + 1024]
            windows = np.zeros((len(part), part[-1][0]), np.uint8)
            for row, (size, i, s) in zip(windows, part):
                row[:size] = found[i][s:s + size]
            marked = self.paths(windows)
            hit = marked.any(axis=1)
            for row, any_, (size, i, s) in zip(marked, hit.tolist(), part):
                if len(starts[i]) == 1:
                    if any_:
                        tags[i][:] = row[:size]
                    continue
                near = np.minimum(np.arange(size), np.arange(size)[::-1])
                taken = near > best[i][s:s + size]
                if any_ or tags[i][s:s + size].any():
                    tags[i][s:s + size][taken] = row[:size][taken]
                best[i][s:s + size][taken] = near[taken]
        return [_spans(t, text, known) for t, text, known in zip(tags, texts, base)]


def _best(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best paths (windows, length) by dynamic programming."""
    length, n, k = scores.shape
    back = np.empty((length, n, k), np.uint8)
    total = scores[0]
    for t in range(1, length):
        steps = total[:, :, None] + move
        back[t] = steps.argmax(axis=1)
        total = steps.max(axis=1) + scores[t]
    out = np.empty((n, length), np.uint8)
    out[:, -1] = total.argmax(axis=1)
    rows = np.arange(n)
    for t in range(length - 1, 0, -1):
        out[:, t - 1] = back[t, rows, out[:, t]]
    return out


def _spans(tags: np.ndarray, text: str, base: list[Span]) -> list[Span]:
    """Runs of one tag, without outer white space, that can be of their kind and overlap no base span.

    A card must pass its checksum, an address hold an at sign, the others enough digits.
    """
    if not tags.any():
        return []
    cuts = np.flatnonzero(np.diff(tags)) + 1
    out = []
    for start, end in zip(np.append(0, cuts).tolist(), np.append(cuts, len(tags)).tolist()):
        kind = tags[start]
        if not kind:
            continue
        while start < end and text[start].isspace():
            start += 1
        while end > start and text[end - 1].isspace():
            end -= 1
        piece, name = text[start:end], KINDS[kind - 1]
        digits = "".join(c for c in piece if "0" <= c <= "9")
        if name == "card":
            able = 13 <= len(digits) <= 19 and _luhn(digits)
        elif name == "email":
            able = "@" in piece.strip("@")
        else:
            able = len(digits) >= (4 if name == "ip" else 8)
        if able and all(end <= a or start >= b for _, a, b in base):
            out.append((name, start, end))
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _crf(scores: np.ndarray, tags: np.ndarray, move: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss and its gradients by tag scores and by transitions."""
    length, n, k = scores.shape
    ahead, behind = np.empty_like(scores), np.zeros_like(scores)
    ahead[0] = scores[0]
    for t in range(1, length):
        ahead[t] = _logsum(ahead[t - 1][:, :, None] + move, 1) + scores[t]
    for t in range(length - 2, -1, -1):
        behind[t] = _logsum(move + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
    norm = _logsum(ahead[-1], 1)
    rows = np.arange(n)
    grad = np.exp(ahead + behind - norm[None, :, None])
    moves = np.zeros((k, k))
    loss = norm.sum()
    for t in range(length):
        loss -= scores[t, rows, tags[:, t]].sum()
        grad[t, rows, tags[:, t]] -= 1
        if t:
            pair = ahead[t - 1][:, :, None] + move + (scores[t] + behind[t])[:, None, :] - norm[:, None, None]
            moves += np.exp(pair).sum(axis=0)
            np.add.at(moves, (tags[:, t - 1], tags[:, t]), -1)
            loss -= move[tags[:, t - 1], tags[:, t]].sum()
    return loss / n, grad / n, (moves / n).astype(np.float32)


def _direction(w: dict, side: str, windows: np.ndarray) -> list[tuple]:
    """States of one direction, in reading order, kept for the way back."""
    inputs, recur = w[f"{side}_in"], w[f"{side}_state"]
    cell = hidden = np.zeros((len(windows), HIDDEN), np.float32)
    low = np.repeat(np.array([0, -1], np.float32), [3 * HIDDEN, HIDDEN])
    kept = []
    places = range(windows.shape[1])
    for t in places if side == "forward" else reversed(places):
        raw = inputs[windows[:, t]] + hidden @ recur
        gates = np.clip(raw, low, 1)
        i, f, o, g = np.split(gates, 4, axis=1)
        fresh = f * cell + i * g
        shown = np.clip(fresh, -1, 1)
        kept.append((t, raw, gates, cell, hidden, fresh, shown))
        cell, hidden = shown, o * shown
    return kept


def fit(windows: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = 3) -> Tagger:
    """Fit to class windows and their tags (both windows x length) by Adam."""
    rng = np.random.default_rng(seed)
    net = Tagger.initial(rng)
    w, batch = net.weights, min(96, len(windows))
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    low = np.repeat(np.array([0, -1], np.float32), [3 * HIDDEN, HIDDEN])
    limit = np.float32(3 / batch)  # of a gradient that travels back along a window
    for step in range(1, steps + 1):
        chosen = rng.choice(len(windows), batch, replace=False)
        seen, wanted = windows[chosen], tags[chosen]
        kept = {side: _direction(w, side, seen) for side in ("forward", "backward")}
        scores = np.empty((seen.shape[1], batch, TAGS), np.float32)
        scores[:] = w["bias"]
        for side, states in kept.items():
            for t, _, gates, _, _, _, shown in states:
                scores[t] += (gates[:, 2 * HIDDEN:3 * HIDDEN] * shown) @ w[f"{side}_tags"]
        _, down, moves = _crf(scores, wanted, w["transitions"])
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        grad["transitions"], grad["bias"] = moves, down.sum(axis=(0, 1))
        for side, states in kept.items():
            hidden_back = cell_back = np.zeros((batch, HIDDEN), np.float32)
            for t, raw, gates, cell, hidden, fresh, shown in reversed(states):
                i, f, o, g = np.split(gates, 4, axis=1)
                grad[f"{side}_tags"] += (o * shown).T @ down[t]
                to_hidden = np.clip(hidden_back + down[t] @ w[f"{side}_tags"].T, -limit, limit)
                # Outside its linear part a gate passes a tenth of the gradient, so that it can return.
                to_cell = np.clip(cell_back + to_hidden * o, -limit, limit) * np.where(np.abs(fresh) < 1, 1, np.float32(0.1))
                to_raw = np.hstack([to_cell * g, to_cell * cell, to_hidden * shown, to_cell * i])
                to_raw = to_raw * np.where((raw > low) & (raw < 1), 1, np.float32(0.1))
                grad[f"{side}_state"] += hidden.T @ to_raw
                one = np.zeros((batch, CLASSES), np.float32)
                one[np.arange(batch), seen[:, t]] = 1
                grad[f"{side}_in"] += one.T @ to_raw
                hidden_back, cell_back = to_raw @ w[f"{side}_state"].T, to_cell * f
        size = np.sqrt(sum(float((g.astype(np.float64) ** 2).sum()) for g in grad.values()))
        rate = 0.02 * (1 - 0.9 * step / steps)
        for k, g in grad.items():
            g = g * min(1.0, 5.0 / (size + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w[k] -= (rate * first[k] / (1 - 0.9 ** step)
                     / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return net


def labelled_windows(texts: list[str], most: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Windows around base spans, and one elsewhere for each text, with the spans as tags."""
    rng = np.random.default_rng(seed)
    windows, tags = [], []
    for text in texts:
        spans = base_spans(text)
        if len(windows) >= most:
            break
        codes = classes(text)
        marked = np.zeros(len(codes), np.uint8)
        for kind, a, b in spans:
            marked[a:b] = 1 + KINDS.index(kind)
        places = [a - int(rng.integers(0, FIT_LENGTH - 20)) for _, a, _ in spans[:FIT_SPANS]]
        places += [int(rng.integers(0, max(1, len(codes) - FIT_LENGTH))) for _ in range(2)]
        # Digits and marks that are no span teach most.
        loose = np.flatnonzero((codes >= 4) & (codes != 5) & (marked == 0))
        places += [int(p) - int(rng.integers(0, FIT_LENGTH)) for p in (rng.choice(loose, 2) if len(loose) else [])]
        for at in places:
            at = max(0, at)
            window, tag = np.zeros(FIT_LENGTH, np.uint8), np.zeros(FIT_LENGTH, np.uint8)
            cut = codes[at:at + FIT_LENGTH]
            window[:len(cut)], tag[:len(cut)] = cut, marked[at:at + FIT_LENGTH]
            windows.append(window)
            tags.append(tag)
    shape = (-1, FIT_LENGTH)
    return np.array(windows, np.uint8).reshape(shape)[:most], np.array(tags, np.uint8).reshape(shape)[:most]


def train(docs: DataFrame, text_col: str = "text", rows: int = FIT_ROWS, windows: int = FIT_WINDOWS,
          steps: int = STEPS) -> Tagger | None:
    """Fit to the spans of at most ``rows`` documents; None where they hold none.

    The documents are those with an e-mail's sign or a long number, in the order of a hash of their text. Of a longer one only
    a stretch of ``EXCERPT`` characters around its first such place is used, and of its spans the first ``FIT_SPANS``.
    Tasks give up little more than is wanted: first only hashes in a share of the range count, then four times as many
    until there are enough.
    """
    hint = r"[0-9A-Za-z]@[0-9A-Za-z]|\+[0-9]|[0-9][ .-]?[0-9][ .-]?[0-9][ .-]?[0-9][ .-]?[0-9]"
    text = F.col(text_col)
    at = F.greatest(F.lit(1), F.regexp_instr(text, F.lit(hint)) - 300)
    hashed = docs.select(F.xxhash64(text).alias("h"), text.alias("t"), at.alias("a"))
    share = min(1.0, 16 * rows / max(1, docs.count()))
    while True:
        near = hashed if share >= 1 else hashed.where(F.col("h") < int(-(1 << 63) + share * (1 << 64)))
        found = (near.where(F.col("t").rlike(hint)).select("h", F.substr("t", "a", F.lit(EXCERPT)).alias("t"))
                 .groupBy("h", "t").agg(F.count(F.lit(1)).alias("n")).orderBy("h", "t").limit(rows).collect())
        found = [r.t for r in found for _ in range(min(r.n, rows))][:rows]
        if share >= 1 or len(found) >= rows:
            break
        share *= 4
    seen, tags = labelled_windows(found, windows)
    return fit(seen, tags, steps) if tags.any() else None


def find(docs: DataFrame, tagger: Tagger | None, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """Add ``spans_col`` to every row: (kind, start, end, base), by kind and start, end exclusive, in code points."""
    refuse([spans_col], docs.columns)
    place = docs.columns.index(text_col)
    item = StructType([StructField("kind", StringType()), StructField("start", IntegerType()),
                       StructField("end", IntegerType()), StructField("base", BooleanType())])
    schema = StructType([*docs.schema.fields, StructField(spans_col, ArrayType(item))])
    kind = to_arrow_schema(schema).field(spans_col).type

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            out = []
            for i in range(0, batch.num_rows, 128):
                texts = [v.as_py() or "" for v in batch.column(place)[i:i + 128]]
                base = [base_spans(t) for t in texts]
                more = tagger.added(texts, base) if tagger else [[] for _ in texts]
                for b, m in zip(base, more):
                    marked = [(*s, True) for s in b] + [(*s, False) for s in m]
                    marked.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
                    out.append([dict(zip(("kind", "start", "end", "base"), s)) for s in marked])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)],
                                             names=[*batch.schema.names, spans_col])

    return docs.mapInArrow(found, schema)


def redact(docs: DataFrame, tagger: Tagger | None, text_col: str = "text") -> DataFrame:
    """The same rows with every span of ``text_col`` replaced by its kind in brackets; null stays null.

    Of spans that overlap, the one that starts first (then the longer one) is replaced.
    """
    spans = free("__spans", docs.columns)
    place = docs.columns.index(text_col)

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            out = []
            for value, marked in zip(batch.column(place), batch.column(batch.num_columns - 1)):
                text, end, parts = value.as_py(), 0, []
                for s in sorted(marked.as_py(), key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= end:
                        parts += [text[end:s["start"]], f"[{s['kind'].upper()}]"]
                        end = s["end"]
                out.append(text if text is None else "".join(parts) + text[end:])
            columns = list(batch.columns[:-1])
            columns[place] = pa.array(out, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return find(docs, tagger, text_col, spans).mapInArrow(replaced, docs.schema)


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents: base counts, a digest of the base spans, and all spans."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find(docs, train(docs)).select("doc_id", "spans")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
