"""Line deduplication with a suffix array over sequences of line ids.

A text is its lines. A line that repeats a line of an earlier document, or an earlier one of the same
document, is deleted if it lies in a run of lines that stands there too and has ``min_words`` words or more. Documents are in
order of their id, then of a hash of their text.

1. Lines get a 128-bit id. Lines whose id occurs once end all runs, so only the others (with how many repeated lines follow,
   ``left``) form the sequences that are sorted. Each repeated id gets a number.
2. Suffixes are sorted by the numbers of their first ``FIRST`` lines. Then prefix doubling: a suffix's rank is the number of suffixes
   that are smaller by the lines seen so far. A round pairs it with the rank of the suffix that many lines on in its document
   and sorts the pairs. Counts along the sorted slices give the next rank. Suffixes that became unique or ended keep theirs and
   leave the rounds; only places with enough lines before them are looked up.
3. Neighbours in the suffix array that differ in their first ``FIRST`` lines were compared when these were sorted. For the others,
   the ranks of all rounds tell how many lines they share: the longest round in which they were equal first, then the same
   question that many lines on, a join per step, and at last the first ``FIRST`` lines there.
4. One pass over the suffix array in each direction follows the intervals of common prefixes: for every length that still reaches
   the present suffix, the earliest document place among the suffixes passed. The longest run that stands at an
   earlier place than the suffix's own is a repeated run. The intervals open at a slice's end, at most as many as the longest run
   has lines, are handed on to the next slice.
5. Runs are gathered by document, which reads its words and loses the lines.

No step holds all copies of a line or of a run: frequent ids are counted before they are shuffled, sorts cut through them, and joins on them are
split by adaptive execution, as both sides are stored tables. Each step's table is written to the shared folder.

Null texts stay null. Rows equal in id and text are one document: they all keep or lose the same lines. Null ids come first. A text that loses
all lines becomes empty. All columns and rows are kept; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import free, release, stored, table

MIN_WORDS = 50
# Lines by which suffixes are sorted at first; the rounds go on from there.
FIRST = 16
# A document is known by its id and its text's hash; a place by its line as well.
DOC = ["doc", "copy"]
PLACE = [*DOC, "line"]


def _first(column: str) -> Column:
    return F.col(column).asc_nulls_first()


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Batches with rows, and whether each is its partition's last."""
    held = None
    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield held, False
            held = batch
    if held is not None:
        yield held, True


def _edges(place: int, rows: int, last: bool) -> pa.Array:
    """Marks a slice's first and last row in a batch that starts at ``place``."""
    marks = np.zeros(rows, bool)
    marks[0] = place == 0
    marks[-1] |= last
    return pa.array(marks)


def _sorted(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows sorted by ``keys`` over all partitions; ``slice`` is the partition."""
    order = [_first(k) for k in keys]
    return df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("slice", F.spark_partition_id())


def _keys(rank: np.ndarray, rest: pa.Array) -> np.ndarray:
    """Rank and what follows it, a number or a list of ``FIRST`` numbers, as a row of numbers."""
    values = rest.flatten() if pa.types.is_list(rest.type) else rest
    return np.column_stack([rank, values.to_numpy(zero_copy_only=False).reshape(len(rank), -1)])


def _ranked(df: DataFrame, rest: str, label: str) -> DataFrame:
    """Refine ``rank`` by ``rest``: add to it how many rows of equal rank have a smaller ``rest``.

    Adds ``twin``, whether another row is equal in both, and ``head``, in how many leading numbers of ``rest`` these rows equal
    the ones before. A task knows this within its slice; the slices' first and last rows tell what goes on across.
    """
    spark = df.sparkSession
    ordered = _sorted(df, ["rank", rest, *PLACE])
    at_rank, at_rest = ordered.columns.index("rank"), ordered.columns.index(rest)
    added = ["place", "group", "same", "head", "twin", "edge"]
    schema = T.StructType([*ordered.schema.fields, *[T.StructField(n, T.LongType()) for n in added[:4]],
                           *[T.StructField(n, T.BooleanType()) for n in added[4:]]])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        place, before, ahead = 0, None, None
        group, same, head = 0, 0, 0
        for batch, last in _batches(batches):
            # A row is given out with the next batch, when it is known whether its twin follows.
            if ahead is not None:
                batch = pa.concat_batches([ahead, batch])
            rows = batch.num_rows
            keys = _keys(batch.column(at_rank).to_numpy(), batch.column(at_rest))
            equal = np.ones((rows, keys.shape[1]), bool)
            equal[1:] = keys[1:] == keys[:-1]
            # The first row counts as a part of the slice before, until that is known.
            if before is not None:
                equal[0] = keys[0] == before
            shared = np.logical_and.accumulate(equal, axis=1).sum(axis=1)
            new = shared < keys.shape[1]
            places = np.arange(place, place + rows)
            groups = np.maximum.accumulate(np.where(shared == 0, places, group))
            sames = np.maximum.accumulate(np.where(new, places, same))
            starts = np.maximum.accumulate(np.where(new, np.arange(rows), -1))
            heads = np.where(starts < 0, head, shared[starts] - 1)
            twin = np.zeros(rows, bool)
            twin[:-1] = ~new[1:]
            twin |= ~new & (places > 0)
            out = rows if last else rows - 1
            if out:
                columns = [*batch.columns, *[pa.array(x, pa.int64()) for x in (places, groups, sames, heads)], pa.array(twin),
                           _edges(place, rows, last)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added]).slice(0, out)
                before, place = keys[out - 1], place + out
                group, same, head = groups[out - 1], sames[out - 1], heads[out - 1]
            ahead = batch.slice(out)

    found = stored(ordered.mapInArrow(marked, schema), label)
    # Two rows per slice at most.
    ends = found.where("edge").select("slice", "place", "group", "same", "head", "rank", F.col(rest).alias("rest")).collect()
    slices, offset, last = [], 0, None
    for n, first, end in _by_slice(ends):
        keys = _listed(first)
        shared = 0
        if last is not None:
            while shared < len(keys) and keys[shared] == last["keys"][shared]:
                shared += 1
        goes_on = shared == len(keys)
        if goes_on:
            slices[-1][-1] = True
        same, head = (last["same"], last["head"]) if goes_on else (offset, shared - 1)
        group = last["group"] if shared else offset
        slices.append([n, offset, group, same, max(head, 0), goes_on, end.same, False])
        last = {"keys": _listed(end), "same": offset + end.same if end.same else same,
                "head": end.head if end.same else head, "group": offset + end.group if end.group else group}
        offset += end.place + 1
    known = spark.createDataFrame([tuple(x) for x in slices], "slice int, __offset long, __group long, __same long, __head long, "
                                                              "__from boolean, __end long, __to boolean")
    first = F.col("same") == 0
    start = F.when(first, F.col("__same")).otherwise(F.col("__offset") + F.col("same"))
    group = F.when(F.col("group") == 0, F.col("__group")).otherwise(F.col("__offset") + F.col("group"))
    twin = F.col("twin") | (first & F.col("__from")) | ((F.col("same") == F.col("__end")) & F.col("__to"))
    return (found.join(F.broadcast(known), "slice")
            .select(*df.columns, (F.col("rank") + start - group).alias("__rank"), twin.alias("twin"),
                    F.when(first, F.col("__head")).otherwise(F.col("head")).cast("int").alias("head"))
            .withColumn("rank", F.col("__rank")).drop("__rank"))


def _by_slice(ends: list[Row]) -> list[tuple[int, Row, Row]]:
    """Each slice's number, first and last row, in order."""
    rows = sorted(ends, key=lambda r: (r.slice, r.place))
    found = [(n, list(group)) for n, group in groupby(rows, key=lambda r: r.slice)]
    return [(n, group[0], group[-1]) for n, group in found]


def _listed(row: Row) -> list[int]:
    return [row["rank"], *(row["rest"] if isinstance(row["rest"], list) else [row["rest"]])]


def repeated_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Places of all lines that occur more than once, with ``left``, ``at`` and ``key``.

    ``left`` counts the lines from the place to the end of its run of repeated lines, ``at`` those before it. ``key`` has the
    numbers of the first ``FIRST`` lines from there on, with -1 after the run's end.
    """
    texts = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("copy"), F.col(text_col).alias("content"))
    lines = texts.select(*DOC, F.posexplode(F.split("content", "\n", -1)).alias("line", "content"))
    # A second hash over the line and its length makes an id of 128 bits.
    lines = stored(lines.select(*PLACE, F.xxhash64("content").alias("a"),
                                F.xxhash64(F.lit(7), F.length("content"), "content").alias("b")), "lines")
    # Any numbers do, as lines need no order of their own.
    again = stored(lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select("a", "b", F.monotonically_increasing_id().alias("number")), "repeated")
    found = (lines.join(again, ["a", "b"]).select(*PLACE, "number").repartition(*[F.col(c) for c in DOC])
             .dropDuplicates(PLACE))
    # A document's lines, at most one row of the input.
    inside = Window.partitionBy(*DOC).orderBy("line")
    run = Window.partitionBy(*DOC, "run")
    along = run.orderBy("line")
    key = F.array("number", *[F.lead("number", n, -1).over(along) for n in range(1, FIRST)])
    return stored(found.withColumn("run", F.col("line") - F.row_number().over(inside))
                  .select(*PLACE, (F.max("line").over(run) - F.col("line") + 1).cast("int").alias("left"),
                          (F.col("line") - F.min("line").over(run)).cast("int").alias("at"), key.alias("key")), "places")


def _same_place(left: DataFrame, right: DataFrame, line: Column, how: str) -> DataFrame:
    """Join on document and line, where ids may be null; ``right`` has its columns named with a leading r_."""
    return left.join(right, F.col("doc").eqNullSafe(F.col("r_doc")) & (F.col("copy") == F.col("r_copy"))
                     & (line == F.col("r_line")), how).drop("r_doc", "r_copy", "r_line")


def _renamed(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"r_{c}") for c in PLACE], *[F.col(c).alias(n) for c, n in columns.items()])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part.select(*out.columns))
    return out


def suffix_ranks(lines: DataFrame) -> DataFrame:
    """Every place with ``left``, ``at``, ``head``, its ``rank`` in the suffix array, and ``ranks``, one for each round in which
    it had a twin. ``head`` counts the lines shared with the suffixes before that differ in the first ``FIRST``.
    """
    columns = [*PLACE, "left", "at", "head", "rank", "ranks"]
    ranked = stored(_ranked(lines.withColumn("rank", F.lit(0).cast("long")), "key", "keys")
                    .withColumn("ranks", F.when(F.col("twin"), F.array("rank")).otherwise(F.array().cast("array<bigint>")))
                    .select(*columns, (F.col("twin") & (F.col("left") >= FIRST)).alias("open")), f"ranks-{FIRST}")
    done, step = [], FIRST
    while True:
        done.append(ranked.where("NOT open").drop("open"))
        active = ranked.where("open").drop("open")
        if active.isEmpty():
            return _union(done)
        # Only places that have so many lines before them are looked up.
        known = active.withColumn("open", F.lit(True)).unionByName(
            _union([part.where(F.col("at") >= step).withColumn("ranks", F.lit(None).cast("array<bigint>")) for part in done])
            .withColumn("open", F.lit(False)))
        # A document's lines are looked up among themselves, at most one row of the input. Only suffixes that go on have a
        # rank further down; the others are over, and smaller.
        further = F.max("rank").over(Window.partitionBy(*DOC).orderBy("line").rangeBetween(step, step))
        ahead = known.withColumn("next", F.when(F.col("left") > step, further).otherwise(F.lit(-1))).where("open").drop("open")
        ahead = stored(ahead.withColumnRenamed("head", "kept"), f"pairs-{step}")
        step *= 2
        ranked = _ranked(ahead, "next", f"names-{step}").drop("head", "next").withColumnRenamed("kept", "head")
        ranked = stored(ranked.withColumn("ranks", F.when(F.col("twin"), F.concat("ranks", F.array("rank")))
                                          .otherwise(F.col("ranks")))
                        .select(*columns, (F.col("twin") & (F.col("left") >= step)).alias("open")), f"ranks-{step}")


def _shared(ranks: str, other: str) -> Column:
    """Lines that two suffixes share for sure: the longest round in which their ranks were equal; 0 for none."""
    equal = F.size(F.filter(F.zip_with(ranks, other, lambda x, y: x == y), lambda x: x))
    return F.when(equal > 0, F.lit(FIRST) * F.pow(F.lit(2), equal - 1)).otherwise(0).cast("int")


def _neighbours(suffixes: DataFrame) -> DataFrame:
    """The suffix array, sliced, with each place's ``prior`` columns; null for the first."""
    held = [*PLACE, "left", "rank", "ranks"]
    ordered = _sorted(suffixes, ["rank", *PLACE])
    fields = {f.name: f.dataType for f in ordered.schema.fields}
    schema = T.StructType([*ordered.schema.fields, *[T.StructField(f"p_{n}", fields[n]) for n in held],
                           T.StructField("place", T.LongType()), T.StructField("edge", T.BooleanType())])
    at = [ordered.columns.index(n) for n in held]

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        place, before = 0, None
        for batch, last in _batches(batches):
            rows = batch.num_rows
            own = [batch.column(i) for i in at]
            before = before or [pa.nulls(1, c.type) for c in own]
            prior = [pa.concat_arrays([b, c.slice(0, rows - 1)]) for b, c in zip(before, own)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *prior, pa.array(np.arange(place, place + rows)),
                                              _edges(place, rows, last)], names=schema.names)
            before, place = [c.slice(rows - 1) for c in own], place + rows

    array = stored(ordered.mapInArrow(paired, schema), "suffix-array")
    # Two rows per slice at most; the last one of a slice comes before the first one of the next.
    ends = array.where("edge").select("slice", "place", *held).collect()
    slices = _by_slice(ends)
    rows = [(n, *[end[c] for c in held]) for (_, _, end), (n, _, _) in zip(slices, slices[1:])]
    edges = array.sparkSession.createDataFrame(
        rows, T.StructType([T.StructField("slice", T.IntegerType()), *[T.StructField(f"e_{n}", fields[n]) for n in held]]))
    prior = [F.when(F.col("place") == 0, F.col(f"e_{n}")).otherwise(F.col(f"p_{n}")).alias(f"p_{n}") for n in held]
    return array.join(F.broadcast(edges), "slice", "left").select(*ordered.columns, "place", *prior)


def common_prefixes(suffixes: DataFrame, lines: DataFrame) -> DataFrame:
    """The suffix array: sliced places with ``before``, the lines shared with the suffix before."""
    most = F.least("left", "p_left")
    shared = _shared("ranks", "p_ranks")
    # Suffixes that differ in their first lines were compared when these were sorted.
    before = (F.when(F.col("p_rank").isNull(), 0).when(F.col("rank") == F.col("p_rank"), most)
              .when(shared == 0, F.col("head")).otherwise(F.least(most, shared)))
    open_ = F.col("p_rank").isNotNull() & (F.col("rank") != F.col("p_rank")) & (shared > 0)
    pairs = stored(_neighbours(suffixes).withColumn("before", before.cast("int"))
                   .withColumn("most", F.coalesce(most, F.lit(0))).withColumn("open", open_ & (F.col("before") < F.col("most")))
                   .select(*PLACE, "left", "slice", "place", "before", "most", "open", *[f"p_{c}" for c in PLACE]), "prefixes-0")
    done, pending, step = [pairs.where("NOT open")], pairs.where("open"), 0
    # What is asked for has as many lines before it.
    ranks = stored(suffixes.where(F.col("at") >= FIRST).select(*PLACE, "rank", "ranks"), "ranks-asked")
    keys = lines.where(F.col("at") >= FIRST)

    def both(df: DataFrame, known: DataFrame, *names: str) -> DataFrame:
        """Add the known columns x_ and y_ of the places so many lines on."""
        ours = _same_place(df, _renamed(known, **{n: f"x_{n}" for n in names}), F.col("line") + F.col("before"), "inner")
        return (ours.join(_renamed(known, **{n: f"y_{n}" for n in names}),
                          F.col("p_doc").eqNullSafe(F.col("r_doc")) & (F.col("p_copy") == F.col("r_copy"))
                          & (F.col("p_line") + F.col("before") == F.col("r_line"))).drop("r_doc", "r_copy", "r_line"))

    short = []
    while not pending.isEmpty():
        step += 1
        more = F.when(F.col("x_rank") == F.col("y_rank"), F.col("most") - F.col("before")).otherwise(_shared("x_ranks", "y_ranks"))
        further = stored(both(pending, ranks, "rank", "ranks").withColumn("more", more.cast("int"))
                         .withColumn("before", F.least("most", F.col("before") + F.col("more")))
                         .select(*pairs.columns, "more"), f"prefixes-{step}")
        done.append(further.where("before >= most").drop("more"))
        short.append(further.where("more = 0 AND before < most").drop("more"))
        pending = further.where("more > 0 AND before < most").drop("more")
    if short:
        differ = F.array_position(F.zip_with("x_key", "y_key", lambda x, y: x != y), True)
        done.append(both(_union(short), keys, "key").withColumn("before", F.least(
            "most", (F.col("before") + F.when(differ > 0, differ - 1).otherwise(FIRST)).cast("int"))))
    return stored(_union([part.select(*PLACE, "left", "slice", "place", "before") for part in done]), "prefixes")


def _order(doc: object, copy: int, line: int) -> tuple:
    return (doc is not None, doc if doc is not None else 0, copy, line)


def _reach(reach: list[list], shared: int) -> None:
    """Shorten what reached the suffix before to the lines shared with the next one."""
    least = None
    while reach and reach[-1][0] >= shared:
        least = reach.pop()[1]
    if shared and least is not None:
        reach.append([shared, least])


def _add(reach: list[list], length: int, place: tuple) -> None:
    """Add a place that reaches ``length`` lines, as far as any.

    Lengths and places both rise along ``reach``: a shorter run is listed only if it stands earlier.
    """
    while reach and reach[-1][1] >= place:
        reach.pop()
    if not reach or reach[-1][0] < length:
        reach.append([length, place])


def _longest(reach: list[list], own: tuple) -> int:
    """The longest length at which a suffix of an earlier place reaches this one."""
    for length, place in reversed(reach):
        if place < own:
            return length
    return 0


def _walk(rows: Iterator[tuple], reach: list[list]) -> Iterator[tuple[tuple, int]]:
    """For (place, left, shared with the one before) in order: each place and its longest earlier run."""
    for place, left, shared in rows:
        _reach(reach, shared)
        yield place, _longest(reach, place)
        _add(reach, left, place)


def repeated_runs(array: DataFrame) -> DataFrame:
    """Places (doc, copy, line) with ``run``, the lines from there on that stand at an earlier place."""
    spark = array.sparkSession
    doc_type = array.schema["doc"].dataType.simpleString()
    # What is shared with the suffix after, for the way back.
    follows = F.lead("before").over(Window.partitionBy("slice").orderBy("place"))
    firsts = array.groupBy("slice").agg(F.min_by("before", "place").alias("first"), F.min("before").alias("least"))
    edges = stored(firsts.withColumn("after", F.lead("first").over(Window.orderBy("slice"))), "slices")
    both = stored(array.withColumn("follows", follows).join(edges.select("slice", "after"), "slice")
                  .withColumn("after", F.coalesce("follows", "after", F.lit(0)).cast("int"))
                  .select(*PLACE, "left", "slice", "place", "before", "after"), "intervals")
    found = []
    for shared, direction in (("before", 1), ("after", -1)):
        ordered = both.select(*PLACE, "left", "slice", shared, (F.col("place") * direction).alias("place"))
        found.append(_one_way(spark, ordered, shared, direction, doc_type))
    return found[0].unionByName(found[1])


def _one_way(spark: SparkSession, array: DataFrame, shared: str, direction: int, doc_type: str) -> DataFrame:
    sorted_ = array.repartition(F.col("slice")).sortWithinPartitions("slice", "place")
    columns = ["slice", *PLACE, "left", shared]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for n, doc, copy, line, left, lines in zip(*(c.to_pylist() for c in batch.columns)):
                yield n, (_order(doc, copy, line), left, lines)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each slice, what reaches its end, and the fewest lines shared on the way through it."""
        def made(n: int, least: int, reach: list[list]) -> pa.RecordBatch:
            kind = pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int32()), pa.array([least], pa.int32()),
                 pa.array([[r[0] for r in reach]], pa.list_(pa.int32())),
                 pa.array([[r[1][1] if r[1][0] else None for r in reach]], pa.list_(batch_type[0])),
                 pa.array([[r[1][2] for r in reach]], kind), pa.array([[r[1][3] for r in reach]], kind)],
                names=["slice", "least", "lengths", "docs", "copies", "lines"])

        batch_type, now, least, reach = [None], None, 0, []
        for batch in batches:
            batch_type[0] = batch.column(1).type
            for n, row in rows_of([batch]):
                if n != now:
                    if now is not None:
                        yield made(now, least, reach)
                    now, least, reach = n, row[2], []
                least = min(least, row[2])
                for _ in _walk([row], reach):
                    pass
        if now is not None:
            yield made(now, least, reach)

    schema = f"slice int, least int, lengths array<int>, docs array<{doc_type}>, copies array<long>, lines array<long>"
    # One row per slice, each no longer than the longest run; most are a few numbers.
    summaries = sorted(sorted_.select(*columns).mapInArrow(ends, schema).collect(), key=lambda r: direction * r.slice)
    carried, reach = {}, []
    for r in summaries:
        carried[r.slice] = [list(x) for x in reach]
        _reach(reach, r.least)
        for length, doc, copy, line in zip(r.lengths, r.docs, r.copies, r.lines):
            _add(reach, length, _order(doc, copy, line))
    opened = spark.sparkContext.broadcast(carried)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        now, reach = None, []
        for batch in batches:
            keep, lengths = [], []
            for i, (n, row) in enumerate(rows_of([batch])):
                if n != now:
                    now, reach = n, [list(x) for x in opened.value[n]]
                for _, length in _walk([row], reach):
                    if length:
                        keep.append(i)
                        lengths.append(length)
            taken = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(taken) for i in (1, 2, 3)),
                                              pa.array(lengths, pa.int32())], names=[*PLACE, "run"])

    return sorted_.select(*columns).mapInArrow(runs, f"doc {doc_type}, copy long, line int, run int")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS) -> DataFrame:
    """The same rows and columns, without the lines of later copies of repeated runs."""
    places = repeated_lines(docs, id_col, text_col)
    array = common_prefixes(suffix_ranks(places), places)
    # At most one item per line of the document.
    runs = (repeated_runs(array).groupBy(*DOC).agg(F.collect_list(F.struct("line", "run")).alias("__runs"))
            .select(F.col("doc").alias("__doc"), F.col("copy").alias("__copy"), "__runs"))
    own, doc, copy, found_runs = (free(n, docs.columns) for n in ("__hash", "__doc", "__copy", "__runs"))
    runs = runs.select(F.col("__doc").alias(doc), F.col("__copy").alias(copy), F.col("__runs").alias(found_runs))
    joined = (docs.withColumn(own, F.xxhash64(text_col))
              .join(runs, F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(own) == F.col(copy)), "left")
              .select(*docs.columns, found_runs))
    place = docs.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            out = []
            for value, found in zip(batch.column(place), batch.column(batch.num_columns - 1)):
                text = value.as_py()
                out.append(text if text is None or not found.is_valid else without(text, found.as_py(), min_words))
            columns = list(batch.columns[:-1])
            columns[place] = pa.array(out, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return joined.mapInArrow(cut, docs.schema)


def without(text: str, runs: list[dict], min_words: int) -> str:
    """The text without the lines of those runs that have enough words."""
    lines = text.split("\n")
    total = [0]
    for line in lines:
        total.append(total[-1] + len(line.split()))
    gone = bytearray(len(lines))
    for r in runs:
        start, end = r["line"], r["line"] + r["run"]
        if total[end] - total[start] >= min_words:
            gone[start:end] = b"\1" * (end - start)
    return "\n".join(line for line, out in zip(lines, gone) if not out) if any(gone) else text


def op9_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without later copies of repeated line runs."""
    return deduplicate(table(spark, folder, "documents"))
