"""A slowly changing dimension kept up to date from a stream of change records.

A batch costs what its own records cost; folds rewrite only the buckets of the keys that changed
(see ``folded``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.operators import changes as ch
from tideline.streaming.folded import BUCKET_ROWS, FoldedTable
from tideline.streaming.writers import FlowProgress


class ChangeTarget(FoldedTable):
    """``feed`` is only asked for its columns, so that a target is readable before its first change.

    ``name`` is that of the dataset in ``progress``, which lists what this object has applied.
    """

    def __init__(self, spark: SparkSession, path: str, spec: ch.ChangeSpec,
                 compact_every: int | None = 20, feed: DataFrame | None = None,
                 bucket_rows: int = BUCKET_ROWS, name: str = ""):
        super().__init__(spark, path, spec.keys, lambda state, new: ch.merge_state(state, new, spec),
                         compact_every, bucket_rows)
        self.spec, self.feed_schema = spec, feed.schema if feed is not None else None
        self.name, self.progress = name, []

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Record one micro-batch; applying the same batch id again changes nothing."""
        count = self.record(batch_id, lambda: ch.reduce_batch(ch.stamp_changes(batch, self.spec), self.spec))
        if count is not None:
            self.progress.append(FlowProgress(self.name, batch_id, count))

    def read(self) -> DataFrame:
        """The visible table: current rows (type 1) or all versions (type 2)."""
        state = self.state()
        if state is None:
            if self.feed_schema is None:
                raise ValueError(f"{self.path}: no change has been applied yet")
            nothing = self.spark.createDataFrame([], self.feed_schema)
            state = ch.merge_state(None, ch.reduce_batch(ch.stamp_changes(nothing, self.spec), self.spec), self.spec)
        return ch.visible(state, self.spec)

    def follow(self, feed: DataFrame, checkpoint: str, trigger: str | None = None):
        """Apply a streaming change feed; returns the query when a trigger interval is given."""
        writer = feed.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        if trigger:
            return writer.trigger(processingTime=trigger).start()
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return None


def apply_changes(spark: SparkSession, target: str, source: DataFrame, checkpoint: str,
                  keys, sequence_by, apply_as_deletes=None, except_column_list=(),
                  stored_as_scd_type: int = 1, track_history_column_list=None,
                  track_history_except_column_list=None, compact_every: int | None = 20,
                  bucket_rows: int = BUCKET_ROWS, name: str = "") -> ChangeTarget:
    """Bring ``target`` up to date with a streaming ``source`` of change records."""
    tracked = track_history_column_list
    if track_history_except_column_list is not None:
        hidden = {*keys, *except_column_list, *track_history_except_column_list}
        tracked = [c for c in source.columns if c not in hidden]
    spec = ch.ChangeSpec(tuple(keys), sequence_by, apply_as_deletes, tuple(except_column_list),
                         stored_as_scd_type, tuple(tracked) if tracked is not None else None)
    result = ChangeTarget(spark, target, spec, compact_every, source, bucket_rows, name)
    result.follow(source, checkpoint)
    return result
