"""Change records to slowly changing dimensions, as pure DataFrame steps.

A change record has key columns, a sequence, a delete flag and a payload. ``stamp_changes`` brings
a feed into this form; ``latest_changes`` keeps the last record per key (type 1) and
``close_versions`` gives every record its validity interval (type 2). Deletes stay in the state
as tombstones, so a late record cannot revive a deleted key; ``visible`` hides them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tideline.operators import ordered
from tideline.session import ensure_checkpoint_dir

SEQUENCE = "__sequence"
DELETED = "__deleted"
TIE = "__tie"
VISIBLE = "__visible"
START, END = "__START_AT", "__END_AT"
_ORDER = (SEQUENCE, DELETED, TIE)


@dataclass(frozen=True)
class ChangeSpec:
    """How a feed is keyed, sequenced and reduced.

    ``track_history`` lists the columns whose change opens a new type 2 version (default: every
    record does); other columns then take the values of the last record inside the version.
    """

    keys: tuple[str, ...]
    sequence_by: str | Column
    apply_as_deletes: str | Column | None = None
    except_columns: tuple[str, ...] = ()
    scd_type: int = 1
    track_history: tuple[str, ...] | None = None
    min_hot_rows: int = ordered.MIN_HOT_ROWS

    def __post_init__(self):
        if self.scd_type not in (1, 2):
            raise ValueError("scd_type is 1 or 2")
        if self.track_history is not None and self.scd_type != 2:
            raise ValueError("track_history needs scd_type 2")


def _column(value: str | Column) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def payload_columns(columns: Sequence[str], spec: ChangeSpec) -> list[str]:
    technical = {SEQUENCE, DELETED, TIE, VISIBLE, START, END}
    return [c for c in columns if c not in technical and c not in spec.except_columns]


def _hashable(df: DataFrame, name: str) -> Column:
    """Maps have no hash; their JSON text has."""
    column = F.col(f"`{name}`")
    return F.to_json(column) if isinstance(df.schema[name].dataType, MapType) else column


def stamp_changes(feed: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Key and payload columns plus sequence, delete flag and tie-breaking hash.

    A record without a sequence or without a key stops the update; drop such records with a
    quality rule first.
    """
    payload = payload_columns(feed.columns, spec)
    deleted = (F.lit(False) if spec.apply_as_deletes is None
               else F.coalesce(_column(spec.apply_as_deletes), F.lit(False)))
    sequence = _column(spec.sequence_by)
    stamped = feed.select(*[F.col(f"`{c}`") for c in payload],
                          sequence.alias(SEQUENCE), deleted.alias(DELETED),
                          F.xxhash64(*[_hashable(feed, c) for c in payload]).alias(TIE))
    def stop(what: str) -> Column:
        return F.raise_error(F.lit(f"change record without a {what} value")).cast("boolean")

    no_key = F.lit(False)
    for key in spec.keys:
        no_key = no_key | F.col(f"`{key}`").isNull()
    return stamped.where(F.when(F.col(SEQUENCE).isNull(), stop("sequence"))
                         .when(no_key, stop("key")).otherwise(F.lit(True)))


def _last_first() -> list[Column]:
    return [F.col(c).desc() for c in _ORDER]


def latest_changes(stamped: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Last record per key. Spark trims each map task to one row per key before the shuffle."""
    window = Window.partitionBy(*spec.keys).orderBy(*_last_first())
    return stamped.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def distinct_changes(stamped: DataFrame, spec: ChangeSpec) -> DataFrame:
    """One record per key and sequence; copies are trimmed before the shuffle as well."""
    window = Window.partitionBy(*spec.keys, SEQUENCE).orderBy(*_last_first())
    return stamped.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def reduce_batch(stamped: DataFrame, spec: ChangeSpec) -> DataFrame:
    return latest_changes(stamped, spec) if spec.scd_type == 1 else distinct_changes(stamped, spec)


def _tracked_state(spec: ChangeSpec) -> Column:
    """What decides whether two neighbouring records belong to one version."""
    tracked = [F.col(f"`{c}`") for c in spec.track_history or ()]
    return F.struct(F.col(DELETED).alias("gone"), F.struct(F.lit(0).alias("_"), *tracked).alias("tracked"))


def _opens(state: Column, before: Column) -> Column:
    """A record opens a version unless the one before it is alive with equal tracked columns."""
    return ~state.getField("gone") & ~(before.isNotNull() & before.eqNullSafe(state))


def _edges(sliced: DataFrame, keys: list[str], spec: ChangeSpec) -> DataFrame:
    """Per slice of a hot key: first sequence of the next slice, last state of the previous one,
    and whether the first record of the next slice starts or ends a version."""
    winner_at_start = F.struct(F.col(SEQUENCE), ~F.col(DELETED), F.bitwise_not(TIE))
    ends = (sliced.where(F.col(ordered.SLICE) > 0).withColumn("__state", _tracked_state(spec))
            .groupBy(*keys, ordered.SLICE)
            .agg(F.min(SEQUENCE).alias("__first"),
                 F.min_by("__state", winner_at_start).alias("__first_state"),
                 F.max_by("__state", F.struct(*_ORDER)).alias("__last_state")))
    along = Window.partitionBy(*keys).orderBy(ordered.SLICE)
    ends = ends.withColumn("__edge_before", F.lag("__last_state").over(along))
    first = F.col("__first_state")
    ends = ends.withColumn("__breaks", _opens(first, F.col("__edge_before")) | first.getField("gone"))
    return ends.select(*keys, ordered.SLICE, "__edge_before",
                       F.lead("__first").over(along).alias("__edge_end"),
                       F.lead("__breaks").over(along).alias("__edge_breaks"))


def close_versions(records: DataFrame, spec: ChangeSpec,
                   population: DataFrame | None = None) -> DataFrame:
    """All records with ``__START_AT``, ``__END_AT`` and whether they form a visible version.

    Records may repeat a (key, sequence); the last by delete flag and hash wins. All windows
    share one partitioning and order, so the records are shuffled and sorted once. Hot keys are
    looked for in ``population`` (see ``slice_hot_keys``).
    """
    keys = list(spec.keys)
    sliced, hot = ordered.slice_hot_keys(records, keys, F.col(SEQUENCE), spec.min_hot_rows, population)
    window = Window.partitionBy(*keys, ordered.SLICE).orderBy(*_ORDER)
    # Equal sequences share a slice, so a copy always sees its successor here.
    df = sliced.withColumn(END, F.lead(SEQUENCE).over(window))
    df = df.where(F.col(END).isNull() | (F.col(END) != F.col(SEQUENCE)))
    edge_columns = ["__edge_before", "__edge_end", "__edge_breaks"]
    if hot:
        ensure_checkpoint_dir(records.sparkSession)
        edges = _edges(sliced, keys, spec).checkpoint()
        df = ordered.join_edges(df, edges, keys, edge_columns)
        df = df.withColumn(END, F.coalesce(END, "__edge_end"))
    if spec.track_history is None:
        df = df.withColumn(START, F.col(SEQUENCE)).withColumn(VISIBLE, ~F.col(DELETED))
        return df.drop(*edge_columns, ordered.SLICE)

    df = df.withColumn("__state", _tracked_state(spec))
    df = df.withColumn("__before", F.lag("__state").over(window))
    if hot:
        df = df.withColumn("__before", F.coalesce("__before", "__edge_before"))
    df = df.withColumn("__opens", _opens(F.col("__state"), F.col("__before")))
    next_breaks = F.lead(F.col("__opens") | F.col(DELETED)).over(window)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened_at = F.when(F.col("__opens"), F.col(SEQUENCE))
    start = F.max(opened_at).over(so_far)
    if hot:
        earlier = (Window.partitionBy(*keys).orderBy(ordered.SLICE)
                   .rowsBetween(Window.unboundedPreceding, -1))
        opened = (df.where(F.col(ordered.SLICE) > 0).groupBy(*keys, ordered.SLICE)
                  .agg(F.max(opened_at).alias("__opened"))
                  .select(*keys, ordered.SLICE, F.max("__opened").over(earlier).alias("__carry")))
        df = df.withColumn("__in_slice", start).withColumn("__next_breaks", next_breaks)
        df = ordered.join_edges(df, opened, keys, ["__carry"])
        df = df.withColumn(START, F.coalesce("__in_slice", "__carry"))
        last = F.coalesce("__next_breaks", "__edge_breaks", F.lit(True))
    else:
        df = df.withColumn(START, start).withColumn("__next_breaks", next_breaks)
        last = F.coalesce("__next_breaks", F.lit(True))
    df = df.withColumn(VISIBLE, ~F.col(DELETED) & last)
    return df.drop(*edge_columns, "__state", "__before", "__opens", "__in_slice", "__next_breaks",
                   "__carry", ordered.SLICE)


def merge_state(state: DataFrame | None, changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """State after ``changes`` (already reduced records) are folded into ``state``.

    Only the keys that changed are recomputed; the rows of all other keys pass through without
    a window. With few changes Spark broadcasts their keys and the state is not shuffled at all;
    with many, adaptive execution splits a hot key on the state side of the join.
    """
    if state is None:
        return latest_changes(changes, spec) if spec.scd_type == 1 else close_versions(changes, spec)
    touched = changes.select(*spec.keys).distinct()
    untouched = state.join(touched, list(spec.keys), "left_anti")
    history = state.join(touched, list(spec.keys), "left_semi").select(*changes.columns)
    affected = history.unionByName(changes)
    if spec.scd_type == 1:
        return untouched.unionByName(latest_changes(affected, spec))
    # Hot keys show in the stored rows themselves, without the join above.
    stored = [df.select(*spec.keys, SEQUENCE) for df in (state, changes)]
    reopened = close_versions(affected, spec, population=stored[0].unionByName(stored[1]))
    return untouched.unionByName(reopened)


def visible(state: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The table users see: payload, plus the interval for type 2."""
    payload = payload_columns(state.columns, spec)
    if spec.scd_type == 1:
        return state.where(~F.col(DELETED)).select(*payload)
    return state.where(VISIBLE).select(*payload, START, END)
