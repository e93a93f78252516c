"""Chat formatting by perspective rotation, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant and all others as
named users. The result has one row per conversation, speaker and message: the message's place ``seq``, its
``rendered`` text, where that text lies in the speaker's whole dialogue (``start``, ``end``, in characters), and the
part of it to learn from (``mask_start``, ``mask_end``; null where the speaker is silent). A dialogue is its rows'
``rendered`` in order of ``seq``; it is never gathered into one row, so a conversation may be of any length.

Order and offsets come from two levels: one range sort deals all messages by conversation, turn, role and text into partitions,
cutting through long conversations; numbers and lengths run up inside each partition, and one row per
conversation and partition adds what came before. The sorted messages are written once, so that both levels see the same cuts.

Messages of a system role are rendered as such for every speaker, and system is no participant. Null roles are
users without a name and no participants; null texts are empty; null turns come last; messages with a null conversation
form one conversation. Equal messages keep their number. Markers inside texts are broken up by a space.
A conversation without participants has no rows, as has an empty table. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.common import stored, table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"


def _running(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of the same keys, by ``slice`` and ``place``."""
    inside = Window.partitionBy(*keys, "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per key and partition.
    sums = df.groupBy(*keys, "slice").agg(F.sum(value).alias("__sum"))
    before = sums.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("slice").alias("__slice"),
                         F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"))
    same = F.col("slice") == F.col("__slice")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return (df.join(before, same)
            .withColumn(name, F.col("__before") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .select(*df.columns, name))


def rotate(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", system: str = SYSTEM) -> DataFrame:
    """Rows (conv_id, speaker, seq, turn, role, name, rendered, start, end, mask_start, mask_end)."""
    chosen = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                             F.col(role_col).cast("string").alias("author"),
                             F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = [F.col("conv_id").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("author").asc_nulls_last(),
             F.col("text").asc()]
    # A last, even spread key cuts through equal messages, however many there are.
    spread = F.monotonically_increasing_id().alias("__row")
    dealt = (chosen.withColumn("__row", spread).repartitionByRange(*order, F.col("__row").asc())
             .sortWithinPartitions(*order, F.col("__row").asc())
             .select("conv_id", "turn", "author", "text", F.spark_partition_id().alias("slice"),
                     F.monotonically_increasing_id().alias("place")))
    held = stored(dealt, "chat")
    numbered = _running(held, ["conv_id"], F.lit(1).cast("long"), "seq")
    speakers = (held.where(F.col("author").isNotNull() & (F.col("author") != system))
                .select(F.col("conv_id").alias("__conv"), F.col("author").alias("speaker")).distinct())
    each = numbered.join(speakers, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
    own = F.coalesce(F.col("author") == F.col("speaker"), F.lit(False))
    role = (F.when(own, "assistant").when(F.col("author") == system, "system").otherwise("user"))
    name = F.when((role == "user"), F.col("author"))
    head = F.concat(F.lit(OPEN), F.col("role"), F.coalesce(F.concat(F.lit(" name="), F.col("name")), F.lit("")),
                    F.lit("\n"))
    body = F.replace(F.col("text"), F.lit("<|"), F.lit("< |"))
    each = (each.withColumn("role", role).withColumn("name", name)
            .select("conv_id", "speaker", "seq", "turn", "role", "name", "slice", "place", "author",
                    F.length(head).alias("head"), F.concat(head, body, F.lit(CLOSE)).alias("rendered")))
    placed = _running(each, ["conv_id", "speaker"], F.length("rendered").cast("long"), "start")
    end = F.col("start") + F.length("rendered")
    learned = F.col("role") == "assistant"
    return placed.select("conv_id", "speaker", "seq", "turn", "role", "name", "rendered", "start", end.alias("end"),
                         F.when(learned, F.col("start") + F.col("head")).alias("mask_start"),
                         F.when(learned, end).alias("mask_end"))


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations from the perspective of each participant."""
    return rotate(table(spark, folder, "conversations"))


ORACLE_SQL = """
WITH m AS (
    SELECT conv_id, turn, role AS author, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id
                              ORDER BY turn NULLS LAST, role NULLS LAST, coalesce(text, '')) - 1 AS seq
    FROM conversations),
s AS (SELECT DISTINCT conv_id, author AS speaker FROM m WHERE author <> 'system'),
e AS (
    SELECT m.*, s.speaker,
           CASE WHEN author = speaker THEN 'assistant' WHEN author = 'system' THEN 'system' ELSE 'user' END AS role
    FROM m JOIN s ON m.conv_id IS NOT DISTINCT FROM s.conv_id),
r AS (
    SELECT *, CASE WHEN role = 'user' THEN author END AS name,
           '<|im_start|>' || role || CASE WHEN role = 'user' AND author IS NOT NULL THEN ' name=' || author ELSE '' END
           || chr(10) AS head
    FROM e),
p AS (SELECT *, head || replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS rendered FROM r),
o AS (
    SELECT *, CAST(coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id, speaker ORDER BY seq
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM p)
SELECT conv_id, speaker, seq, turn, role, name, rendered, start, start + length(rendered) AS "end",
       CASE WHEN role = 'assistant' THEN start + length(head) END AS mask_start,
       CASE WHEN role = 'assistant' THEN start + length(rendered) END AS mask_end
FROM o
"""
