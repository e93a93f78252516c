"""State that batches of reduced records are folded into, in buckets by key.

Under the folder, ``changes/v<batch id>`` holds the reduced records of one micro-batch. ``state``
holds what has been folded: rows lie in buckets by a hash of their key, and
``state/v<batch id>/__bucket=<n>`` is a bucket as the fold of that batch wrote it. The fold's
manifest, a small file that appears at once when the fold is complete, names for every bucket the
version that holds it. A fold reads and writes the buckets that its records touch; the files of
all other buckets stay as they are. Reading folds the few batches that came after the newest
manifest, again in touched buckets only.

The number of buckets follows the rows: a fold that finds buckets with over four times
``bucket_rows`` rows on average deals all rows anew, which happens once for each time the state
grows fourfold. Every directory is written once under the id of its batch, so a replayed batch is
recognised and skipped. A folder belongs to one checkpoint.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.streaming import paths

BUCKET = "__bucket"
BUCKET_ROWS = 1_000_000
_MANIFEST = re.compile(r"^v(\d{8,})\.json$")


class FoldedTable:
    """``fold(state or None, records)`` gives the new state of the buckets that records fall into.

    Rows of one key must not depend on rows of another.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str],
                 fold: Callable[[DataFrame | None, DataFrame], DataFrame],
                 compact_every: int | None = 20, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.path, self.keys, self.fold = spark, path.rstrip("/"), list(keys), fold
        self.compact_every, self.bucket_rows = compact_every, bucket_rows

    @property
    def _changes(self) -> str:
        return f"{self.path}/changes"

    @property
    def _state(self) -> str:
        return f"{self.path}/state"

    @property
    def _manifests(self) -> str:
        return f"{self.path}/manifests"

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(buckets)).cast("int")

    def record(self, batch_id: int, reduced: Callable[[], DataFrame]) -> int | None:
        """Keep the records of one micro-batch; returns how many, or None if the batch is known."""
        folded = self.folded_version()
        if folded is not None and batch_id <= folded:
            return None
        new = not paths.is_committed(self.spark, self._changes, batch_id)
        if new:
            reduced().write.mode("overwrite").parquet(paths.version_path(self._changes, batch_id))
        # File footers tell the count.
        count = self._recorded([batch_id]).count()
        if self.compact_every and len(self._pending(folded)) >= self.compact_every:
            self.compact()
        return count if new else None

    def folded_version(self) -> int | None:
        found = [int(m.group(1)) for m in map(_MANIFEST.match, paths.children(self.spark, self._manifests)) if m]
        return max(found, default=None)

    def manifest(self) -> dict:
        """``version``, ``buckets``, ``schema`` and ``held``: for each bucket its version and rows."""
        folded = self.folded_version()
        if folded is None:
            return {"version": None, "buckets": 0, "schema": None, "held": {}}
        found = json.loads(paths.read_text(self.spark, f"{self._manifests}/v{folded:08d}.json"))
        return {**found, "held": {int(b): tuple(v) for b, v in found["held"].items()}}

    def _pending(self, folded: int | None) -> list[int]:
        batches = paths.committed_versions(self.spark, self._changes)
        return [b for b in batches if folded is None or b > folded]

    def _recorded(self, batches: list[int]) -> DataFrame:
        return self.spark.read.parquet(*[paths.version_path(self._changes, b) for b in batches])

    def _touched(self, records: DataFrame, buckets: int) -> set[int]:
        """Buckets that records fall into; at most as many as there are."""
        return {r[0] for r in records.select(self._bucket(buckets)).distinct().collect()}

    def _stored(self, manifest: dict, wanted: set[int] | None = None) -> DataFrame | None:
        """Rows of some buckets, or of all."""
        if manifest["version"] is None:
            return None
        schema = StructType.fromJson(manifest["schema"])
        folders = [f"{paths.version_path(self._state, v)}/{BUCKET}={b}"
                   for b, (v, _) in sorted(manifest["held"].items()) if wanted is None or b in wanted]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def compact(self) -> None:
        """Fold the pending batches into the buckets they touch."""
        manifest = self.manifest()
        pending = self._pending(manifest["version"])
        if not pending:
            return
        records, version, buckets = self._recorded(pending), max(pending), manifest["buckets"]
        rows = sum(n for _, n in manifest["held"].values()) + records.count()
        held = {}
        if buckets and rows <= 4 * buckets * self.bucket_rows:
            touched = self._touched(records, buckets)
            held = {b: entry for b, entry in manifest["held"].items() if b not in touched}
            state = self._stored(manifest, touched)
        else:
            buckets = max(1, math.ceil(rows / self.bucket_rows))
            state = self._stored(manifest)
        merged = self.fold(state, records)
        folder = paths.version_path(self._state, version)
        (merged.withColumn(BUCKET, self._bucket(buckets)).hint("rebalance", BUCKET)
         .write.mode("overwrite").partitionBy(BUCKET).parquet(folder))
        # Directory names and file footers tell the counts.
        counts = self.spark.read.parquet(folder).groupBy(BUCKET).count().collect() if rows else []
        held.update({r[BUCKET]: (version, r["count"]) for r in counts})
        paths.write_whole(self.spark, f"{self._manifests}/v{version:08d}.json", json.dumps({
            "version": version, "buckets": buckets, "schema": merged.schema.jsonValue(), "held": held}))

    def state(self) -> DataFrame | None:
        """All rows, with the pending batches folded in; None before the first batch."""
        manifest = self.manifest()
        pending = self._pending(manifest["version"])
        if not pending:
            return self._stored(manifest)
        records = self._recorded(pending)
        touched = self._touched(records, manifest["buckets"]) if manifest["buckets"] else set()
        state = self.fold(self._stored(manifest, touched), records)
        untouched = manifest["held"].keys() - touched
        return state.unionByName(self._stored(manifest, untouched)) if untouched else state

    def clean_up(self) -> None:
        """Remove what the newest manifest does not name; call it when no reader uses older ones."""
        manifest = self.manifest()
        if manifest["version"] is None:
            return
        used = {(v, b) for b, (v, _) in manifest["held"].items()}
        for version in paths.versions(self.spark, self._state):
            folder = paths.version_path(self._state, version)
            if version > manifest["version"]:
                continue
            names = [n for n in paths.children(self.spark, folder) if n.startswith(f"{BUCKET}=")]
            kept = [n for n in names if (version, int(n.split("=")[1])) in used]
            for name in set(names) - set(kept) if kept else ():
                paths.delete(self.spark, f"{folder}/{name}")
            if not kept:
                paths.delete(self.spark, folder)
        for name in paths.children(self.spark, self._manifests):
            match = _MANIFEST.match(name)
            if match and int(match.group(1)) < manifest["version"]:
                paths.delete(self.spark, f"{self._manifests}/{name}")
        paths.drop_versions_before(self.spark, self._changes, manifest["version"] + 1)
