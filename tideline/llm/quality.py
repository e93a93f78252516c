"""Text quality by a byte-level convolutional network, in numpy.

A text's UTF-8 bytes are cut into chunks that overlap by a filter's width less its step, so every window
of the whole document is seen once. Bytes are embedded, learned filters slide over them, and each filter's largest response
in a chunk is kept. The mean and the maximum of these over all chunks pass through a small hidden layer to one
probability.

The network is fitted on the driver, on at most ``FIT_ROWS`` labelled rows and ``FIT_CHUNKS`` evenly spaced
chunks of each; both bounds are parameters. Rows are drawn evenly from both labels, by a hash of their id, and
the last bias is moved to the shares that the labels have in all labelled rows, which Spark counts. Scoring
reads every byte of every row in tasks; the fitted network (some 20 kB) is shipped to them.

Null and empty texts are scored as a chunk of padding. Rows are treated one by one, so repeated rows and null ids
get a score each. Without labels, or with one label only, the score of every text is the share of label 1 (0.5
without labels). Labels that are null, and labels of null ids, are not learned from. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tideline.llm.common import refuse, release, table

CHUNK = 1024
WIDTH = 8
STEP = 2
EMBEDDED = 6
FILTERS = 24
HIDDEN = 16
FIT_ROWS = 3000
FIT_CHUNKS = 4
STEPS = 900
THRESHOLD = 0.3
_ADVANCE = CHUNK - WIDTH + STEP
_GROUP = 128


def chunks_of(text: str | None, most: int | None = None) -> np.ndarray:
    """Overlapping chunks (n, CHUNK) of a text's bytes, padded with zeros; ``most`` evenly spaced ones."""
    raw = (text or "").encode()
    n = 1 + max(0, -(-(len(raw) - CHUNK) // _ADVANCE))
    padded = np.zeros((n - 1) * _ADVANCE + CHUNK, np.uint8)
    padded[:len(raw)] = np.frombuffer(raw, np.uint8)
    views = np.lib.stride_tricks.as_strided(padded, (n, CHUNK), (_ADVANCE, 1))
    if most and n > most:
        views = views[np.linspace(0, n - 1, most).round().astype(int)]
    return views


@dataclass
class Network:
    """Weights; ``constant`` replaces the network where there was nothing to learn from."""

    weights: dict[str, np.ndarray]
    constant: float | None = None

    @staticmethod
    def initial(rng: np.random.Generator) -> Network:
        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        return Network({
            "embed": normal(256, EMBEDDED, scale=0.5), "filters": normal(WIDTH * EMBEDDED, FILTERS, scale=0.15),
            "bias": np.zeros(FILTERS, np.float32), "hidden": normal(2 * FILTERS + 1, HIDDEN, scale=0.2),
            "hidden_bias": np.zeros(HIDDEN, np.float32), "out": normal(HIDDEN, scale=0.3),
            "out_bias": np.zeros(1, np.float32)})

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        """Embedded windows (chunks, positions, width x embedding)."""
        embedded = self.weights["embed"][chunks]
        n, _, d = embedded.shape
        at = embedded.strides
        return np.ascontiguousarray(np.lib.stride_tricks.as_strided(
            embedded, (n, (CHUNK - WIDTH) // STEP + 1, WIDTH * d), (at[0], at[1] * STEP, at[2])))

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Each filter's largest response in each chunk."""
        out = np.empty((len(chunks), FILTERS), np.float32)
        for i in range(0, len(chunks), _GROUP):
            seen = self.windows(chunks[i:i + _GROUP])
            response = seen.reshape(-1, seen.shape[2]) @ self.weights["filters"]
            out[i:i + _GROUP] = response.reshape(*seen.shape[:2], FILTERS).max(axis=1)
        return np.maximum(out + self.weights["bias"], 0)

    def combined(self, pooled: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Mean and maximum over a document's chunks, and how much of one chunk its bytes fill."""
        sizes = np.diff(np.append(starts, len(pooled)))[:, None]
        filled = (np.log1p(np.minimum(lengths, CHUNK)) / np.log(CHUNK))[:, None]
        return np.hstack([np.add.reduceat(pooled, starts, axis=0) / sizes,
                          np.maximum.reduceat(pooled, starts, axis=0), filled]).astype(np.float32)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        parts = [chunks_of(t) for t in texts]
        pooled = np.concatenate([self.pooled(p) for p in _joined(parts)]) if parts else np.zeros((0, FILTERS))
        starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
        lengths = np.array([len((t or "").encode()) for t in texts])
        w = self.weights
        hidden = np.tanh(self.combined(pooled, starts, lengths) @ w["hidden"] + w["hidden_bias"])
        return 1 / (1 + np.exp(-(hidden @ w["out"] + w["out_bias"][0]).astype(np.float64)))


def _joined(parts: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Chunks of several texts together, in groups; long texts go in slices of a group."""
    waiting, n = [], 0
    for part in parts:
        for i in range(0, len(part), 4 * _GROUP):
            waiting.append(part[i:i + 4 * _GROUP])
            n += len(waiting[-1])
            if n >= 4 * _GROUP:
                yield np.concatenate(waiting)
                waiting, n = [], 0
    if waiting:
        yield np.concatenate(waiting)


def _cropped(chunks: np.ndarray, length: int, label: float, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """A short piece of a document, so that short texts are learned too; of a bad one from its end."""
    size = int(np.exp(rng.uniform(np.log(12), np.log(600))))
    last = chunks[-1][:min(length, CHUNK)] if len(chunks) == 1 else chunks[-1][:CHUNK // 2]
    at = int(rng.integers(0, max(1, len(last) - size))) if label else max(0, len(last) - size)
    piece = np.zeros((1, CHUNK), np.uint8)
    cut = last[at:at + size]
    piece[0, :len(cut)] = cut
    return piece, len(cut)


def fit(parts: list[np.ndarray], lengths: np.ndarray, labels: np.ndarray, share: float, steps: int = STEPS,
        seed: int = 7) -> Network:
    """Fit to documents given as chunks and byte lengths; gradients flow to the windows that won.

    Adam on the log loss. ``share`` is that of label 1 among all labelled rows; the last bias is moved from the
    sample's share to it.
    """
    rng = np.random.default_rng(seed)
    net = Network.initial(rng)
    w, batch = net.weights, 32
    cut = [i for i in range(len(parts)) if rng.random() < 0.3]
    crops = [_cropped(parts[i], int(lengths[i]), labels[i], rng) for i in cut]
    part = labels.mean()
    parts = [*parts, *(c for c, _ in crops)]
    lengths = np.concatenate([lengths, [n for _, n in crops]])
    labels = np.concatenate([labels, labels[cut]])
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    order = np.zeros(0, int)
    for step in range(1, steps + 1):
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(parts))])
        chosen, order = order[:batch], order[batch:]
        chunks = np.concatenate([parts[i] for i in chosen])
        starts = np.cumsum([0] + [len(parts[i]) for i in chosen[:-1]])
        sizes = np.diff(np.append(starts, len(chunks)))
        owner = np.repeat(np.arange(len(chosen)), sizes)
        won = np.empty((len(chunks), FILTERS), np.int64)
        raw = np.empty((len(chunks), FILTERS), np.float32)
        for i in range(0, len(chunks), _GROUP):
            seen = net.windows(chunks[i:i + _GROUP])
            response = (seen.reshape(-1, seen.shape[2]) @ w["filters"]).reshape(*seen.shape[:2], FILTERS)
            won[i:i + _GROUP] = response.argmax(axis=1)
            raw[i:i + _GROUP] = response.max(axis=1)
        pooled = np.maximum(raw + w["bias"], 0)
        features = net.combined(pooled, starts, lengths[chosen])
        hidden = np.tanh(features @ w["hidden"] + w["hidden_bias"])
        score = 1 / (1 + np.exp(-(hidden @ w["out"] + w["out_bias"][0])))

        error = ((score - labels[chosen]) / len(chosen)).astype(np.float32)
        grad = {"out": hidden.T @ error, "out_bias": error.sum(keepdims=True)}
        back = np.outer(error, w["out"]) * (1 - hidden * hidden)
        grad["hidden"], grad["hidden_bias"] = features.T @ back, back.sum(axis=0)
        back = back @ w["hidden"].T
        largest = features[:, FILTERS:2 * FILTERS][owner] == pooled
        down = (back[:, :FILTERS] / sizes[:, None])[owner] + back[:, FILTERS:2 * FILTERS][owner] * largest
        down *= pooled > 0
        grad["bias"] = down.sum(axis=0)
        # The window that won for each chunk and filter, as bytes.
        places = won[:, :, None] * STEP + np.arange(WIDTH)
        taken = chunks[np.arange(len(chunks))[:, None, None], places]
        inputs = w["embed"][taken].reshape(len(chunks), FILTERS, -1)
        grad["filters"] = np.einsum("nf,nfw->wf", down, inputs, optimize=True)
        to_bytes = (down[:, :, None] * w["filters"].T).reshape(-1, EMBEDDED)
        flat = taken.ravel()
        grad["embed"] = np.stack([np.bincount(flat, weights=to_bytes[:, d], minlength=256)
                                  for d in range(EMBEDDED)], axis=1).astype(np.float32)

        rate = 0.01 * (1 - 0.9 * step / steps)
        for k, g in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] -= (rate * (first[k] / (1 - 0.9 ** step))
                     / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    w["out_bias"] += np.float32(np.log(share / (1 - share)) - np.log(part / (1 - part)))
    return net


def held_out(id_col: str) -> Column:
    """Rows kept for measuring: those whose id's CRC-32 is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = FIT_ROWS, chunks: int = FIT_CHUNKS, steps: int = STEPS) -> Network:
    """Fit to at most ``rows`` labelled documents, half of each label, none of them held out."""
    usable = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
              .select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label")))
    shares = {r[0]: r[1] for r in usable.groupBy("__label").count().collect()}
    if len(shares) < 2:
        return Network({}, constant=float(next(iter(shares), 0.5)))
    mixed = F.xxhash64("__id")
    drawn = [usable.where(F.col("__label") == v).orderBy(mixed, "__id").limit(rows // 2) for v in (0, 1)]
    # At most `rows` ids, a bound that is a parameter.
    sample = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(
        F.broadcast(drawn[0].unionByName(drawn[1])), "__id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            found = [v.as_py() or "" for v in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunks_of(t, chunks).tobytes() for t in found], pa.binary()),
                 pa.array([len(t.encode()) for t in found], pa.int64()), *batch.columns[1:]],
                names=["chunks", "length", "label", "place"])

    found = (sample.select("__text", "__label", mixed.alias("place"))
             .mapInArrow(cut, "chunks binary, length long, label int, place long").collect())
    found.sort(key=lambda r: (r.place, bytes(r.chunks)))
    found = found[:2 * rows]  # ids that stand in several rows
    if len({r.label for r in found}) < 2:
        return Network({}, constant=shares.get(1, 0) / sum(shares.values()))
    target = np.array([r.label for r in found], np.float32)
    return fit([np.frombuffer(bytes(r.chunks), np.uint8).reshape(-1, CHUNK) for r in found],
               np.array([r.length for r in found]), target, shares[1] / sum(shares.values()), steps)


def score(docs: DataFrame, net: Network, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add ``score_col``, the probability of label 1, to every row; a table that has such a column is refused."""
    refuse([score_col], docs.columns)
    place = docs.columns.index(text_col)
    schema = StructType([*docs.schema.fields, StructField(score_col, DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            out = []
            for i in range(0, batch.num_rows, 256):
                out.append(net.scores([v.as_py() for v in batch.column(place)[i:i + 256]]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(out) if out else np.zeros(0))],
                names=[*batch.schema.names, score_col])

    return docs.mapInArrow(scored, schema)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of all documents, learned from the labels that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    net = train(docs, table(spark, folder, "labels"))
    return score(docs, net).select("doc_id", held_out("doc_id").alias("held_out"), "score",
                                   (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
