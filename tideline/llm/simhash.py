"""SimHash near-duplicates by tiled exact comparison of fingerprints.

``fingerprints`` lower-cases A-Z, cuts whole texts into words and word shingles (repeats count) and
sets each of 64 bits that more than half of the shingles' XXH64 values have set. A text with fewer
words than a shingle is one shingle; a text without words, or null, has fingerprint zero.

``near_duplicates`` links fingerprints that differ in at most ``radius`` bits. Equal fingerprints
are one node, however many documents share it. Nodes are dealt into tiles by the number of bits
they have set; two tiles whose numbers differ by more than the radius hold no link and are skipped,
all other pairs of tiles are compared by exclusive-or and bit count, in blocks. A pair of tiles
gives back a spanning forest of its links, never all of them, so a large group of copies costs no
more rows than it has members. Components of the forests are found by joins.

Every row is treated by itself: rows with repeated or null ids each get a result. The component of a
group is its smallest id that is not null (null if it has none). Empty tables give empty results.
Only ``id_col`` and ``text_col`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tideline.llm.common import free, release, stored, table
from tideline.llm.components import components

SEED = 42
# Fingerprints in a tile: half a megabyte. The rows moved fall with its square root's inverse, so
# it is large; a pair of tiles is still one short task.
TILE = 65_536
_STEP = 65_536


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit fingerprint of a whole text, as a signed integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    n = max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[:n].tolist()
    ends = (ends[shingle - 1:] - 1).tolist() if len(words) > shingle else [len(joined)]
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _STEP):
        hashed = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + _STEP], ends[at:at + _STEP])])
        bits = np.unpackbits(np.frombuffer(hashed, np.uint8)).view(np.uint64).reshape(-1, 8)
        # Eight counters of eight bits in each word; 255 rows can't overflow them.
        sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """One row per document: its id and ``bits``, the fingerprint as a long."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            bits = [fingerprint(value.as_py(), shingle) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.int64())], names=["id", "bits"])

    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("bits", LongType())])
    return (docs.select(F.col(id_col), F.col(text_col)).mapInArrow(hashed, schema)
            .withColumnRenamed("id", id_col))


class _Forest:
    """Joins nodes as links are found, and keeps the links that joined two trees."""

    def __init__(self, nodes: np.ndarray):
        self.nodes, self.label, self.links = nodes, np.arange(len(nodes)), []

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        a, b = self.label[left], self.label[right]
        apart = np.flatnonzero(a != b)
        if not len(apart):
            return
        low, high = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
        pairs, first = np.unique(low * len(self.nodes) + high, return_index=True)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for pair, at in zip(pairs.tolist(), apart[first].tolist()):
            x, y = find(pair // len(self.nodes)), find(pair % len(self.nodes))
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.links.append((int(left[at]), int(right[at])))
        names = np.arange(len(self.nodes))
        for x in parent:
            names[x] = find(x)
        self.label = names[self.label]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        links = np.array(self.links, np.int64).reshape(-1, 2)
        return self.nodes[links[:, 0]], self.nodes[links[:, 1]]


def _runs(values: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
    """Values by the bits set in their halves; for each run the two numbers and its ends."""
    halves = np.bitwise_count(values.view(np.uint32).reshape(-1, 2)).astype(np.int64)
    key = halves[:, 0] * 64 + halves[:, 1]
    order = np.argsort(key, kind="stable")
    names, starts = np.unique(key[order], return_index=True)
    ends = np.append(starts[1:], len(key))
    return values[order], [(int(k) // 64, int(k) % 64, int(s), int(e)) for k, s, e in zip(names, starts, ends)]


def links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two sets of fingerprints, or inside one."""
    left, left_runs = _runs(left)
    right, right_runs = (left, left_runs) if right is None else _runs(right)
    same = right is left
    forest = _Forest(left if same else np.concatenate([left, right]))
    shift = 0 if same else len(left)
    buffer = np.empty((256, 2048), np.uint64)
    for low, high, start, end in left_runs:
        for other_low, other_high, other_start, other_end in right_runs:
            if abs(low - other_low) + abs(high - other_high) > radius or same and other_start < start:
                continue
            for i in range(start, end, 256):
                rows = left[i:min(i + 256, end), None]
                for j in range(other_start, other_end, 2048):
                    columns = right[None, j:min(j + 2048, other_end)]
                    out = buffer[:rows.shape[0], :columns.shape[1]]
                    near = np.bitwise_count(np.bitwise_xor(rows, columns, out=out)) <= radius
                    if near.any():
                        a, b = np.nonzero(near)
                        forest.add(a + i, b + j + shift)
    return forest.edges()


def _tile_edges(prints: DataFrame, radius: int, tile: int) -> DataFrame:
    """Forest edges (u, v) of all pairs of tiles that may hold links; ``prints`` are distinct."""
    spark = prints.sparkSession
    counts = {r[0]: r[1] for r in prints.groupBy(F.bit_count("bits")).count().collect()}
    classes, base = [], 0
    for ones in range(65):
        tiles = -(-counts.get(ones, 0) // tile)
        classes.append((ones, base, tiles))
        base += tiles
    ends = {ones: first + tiles for ones, first, tiles in classes}
    # At most 65 rows: the tiles of each number of set bits, and the last tile within the radius.
    known = spark.createDataFrame([(ones, first, tiles, ends[min(64, ones + radius)] - 1)
                                   for ones, first, tiles in classes if tiles],
                                  "ones int, first long, tiles long, last long")
    dealt = (prints.withColumn("ones", F.bit_count("bits")).join(F.broadcast(known), "ones")
             .withColumn("tile", F.col("first") + F.pmod(F.xxhash64("bits"), F.col("tiles")))
             .groupBy("tile", "last").agg(F.collect_list("bits").alias("bits")))
    tiles = stored(dealt, "simhash-tiles")
    left = tiles.select(F.col("tile").alias("a"), F.explode(F.sequence("tile", "last")).alias("tile"),
                        F.col("bits").alias("left"))
    pairs = left.join(tiles.select("tile", F.col("bits").alias("right")), "tile")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                         batch.column(2), batch.column(3)):
                u, v = links(left.values.to_numpy().view(np.uint64),
                             None if a == b else right.values.to_numpy().view(np.uint64), radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    # One pair of tiles is a piece of work; they are dealt evenly.
    return (pairs.select("a", "tile", "left", "right").repartition(F.col("a"), F.col("tile"))
            .mapInArrow(compare, "u long, v long"))


def _components(prints: DataFrame, id_col: str, radius: int, tile: int) -> DataFrame:
    """For every fingerprint (``bits``): ``root``, which names its component, and ``first``, its smallest id."""
    nodes = prints.groupBy("bits").agg(F.min(id_col).alias("first"))
    roots = components(_tile_edges(nodes.select("bits"), radius, tile))
    return (nodes.join(roots.withColumnRenamed("node", "bits"), "bits", "left")
            .select("bits", "first", F.coalesce("root", "bits").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    radius: int = 4, tile: int = TILE) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    named = _components(prints, id_col, radius, tile)
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    known = named.join(lowest, "root").select("bits", "component_id")
    return (prints.join(known, "bits")
            .select(id_col, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
             radius: int = 4, tile: int = TILE) -> DataFrame:
    """The same columns, and of each component one row: that of the smallest id (null ids last).

    Among rows of one id the smallest hash of the text decides, and of rows that are equal in both the one with the
    smallest hash over all its columns (maps as JSON text).
    """
    own = free("__hash", docs.columns)
    known = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
                        F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                                 F.xxhash64(text_col).alias("hash")).alias("__key"))
    prints = stored(fingerprints(known, "__key", "__text", shingle), "simhash")
    named = _components(prints, "__key", radius, tile)
    winners = named.groupBy("root").agg(F.min("first").alias("key"))
    rows = prints.groupBy(F.col("__key").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    winners = stored(winners.join(rows, "key").select("key.id", "key.hash", "rows"), "simhash-kept")
    theirs = winners.select(F.col("id").alias(free("__id", docs.columns)), F.col("hash").alias(free("__other", docs.columns)))
    kept = docs.withColumn(own, F.xxhash64(text_col)).join(
        theirs, F.col(id_col).eqNullSafe(F.col(theirs.columns[0])) & (F.col(own) == F.col(theirs.columns[1])), "left_semi")
    if not winners.where("rows > 1").isEmpty():
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        whole = F.xxhash64(*[F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
                             for f in docs.schema.fields])
        return (kept.groupBy(F.col(id_col).alias("__key"), own).agg(F.min_by(row, whole).alias("__row"))
                .select("__row.*"))
    return kept.select(*docs.columns)


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and the components that links of 4 or fewer bits make."""
    return near_duplicates(table(spark, folder, "documents"), shingle=4, radius=4)
