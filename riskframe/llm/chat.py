"""Chat formatting by perspective rotation. Built-in functions only.

For every participant of a conversation the dialogue is rendered with that speaker as the
assistant, all others as named users, and the spans of text that a model learns from: the
participant's own turns with their end mark. Turns of ``system`` roles are system messages in
every perspective and have no perspective of their own.

A dialogue is ordered by turn, then role, then text, and rendered in chunks of ``chunk_turns``
turns, one row per (conversation, perspective, chunk): a conversation of any length is spread
over rows, and no group holds more than a chunk. Positions come from a range partitioning of
all turns and counts per (conversation, partition), not from a window over the conversation.

Null texts are empty turns. A null role speaks as ``unknown`` and has no perspective. Null
turns come first. Rows with a null conv_id form one conversation. Repeated rows are repeated
turns. Control marks inside a text are broken up by a zero-width space. Conversations
without a participant, and empty tables, give no row. Extra columns are ignored.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.shared import need, written

START, END = "<|im_start|>", "<|im_end|>"  # fixed values: marks of the ChatML format
ZERO_WIDTH = "​"


def ranked_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, role, text and ``place``, the position in the conversation from 0."""
    need(conversations, "conv_id", "turn", "role", "text")
    turns = conversations.select("conv_id", "turn", "role", "text").withColumn("_any", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "text", "_any"]
    numbered = turns.repartitionByRange(*order).sortWithinPartitions(*order[:-1]).withColumn("_id", F.monotonically_increasing_id())
    numbered = written(numbered.select("conv_id", "role", "text", "_id"), "turns")
    part = F.shiftright("_id", 33)
    runs = numbered.groupBy("conv_id", part.alias("_part")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("conv_id").alias("_conv"), "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    both = numbered.join(runs, F.col("conv_id").eqNullSafe(F.col("_conv")) & (part == F.col("_part")))
    return both.select("conv_id", "role", "text", (F.col("_before") + F.col("_id") - F.col("_first")).alias("place"))


def _safe(text: Column) -> Column:
    for mark in (START, END):
        text = F.replace(text, F.lit(mark), F.lit(mark[:2] + ZERO_WIDTH + mark[2:]))
    return text


def rotate(conversations: DataFrame, chunk_turns: int = 64, system: Sequence[str] = ("system",)) -> DataFrame:
    """One row per (conv_id, perspective, chunk): text, spans (array of start, end in
    characters of text, end excluded), n_turns."""
    role = F.coalesce("role", F.lit("unknown"))
    # turns are rendered once as a user's or system message; the assistant's differ by label
    turns = ranked_turns(conversations).select(
        "conv_id", F.floor(F.col("place") / chunk_turns).alias("chunk"),
        F.struct("place", "role", _safe(F.coalesce("text", F.lit(""))).alias("text"),
                 F.when(role.isin(*system), role).otherwise(F.concat(F.lit("user name="), _safe(role))).alias("label")).alias("turn"))
    chunks = turns.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    speakers = conversations.where(F.col("role").isNotNull() & ~F.col("role").isin(*system)).select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("perspective")).distinct()
    both = chunks.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")

    own = lambda t: t["role"].eqNullSafe(F.col("perspective"))
    head = lambda t: F.concat(F.lit(START), F.when(own(t), "assistant").otherwise(t["label"]), F.lit("\n"))
    parts = F.transform("turns", lambda t: F.struct(
        own(t).alias("own"), head(t).alias("head"), F.concat(t["text"], F.lit(END)).alias("body")))
    both = both.withColumn("parts", parts)
    size = F.transform("parts", lambda p: F.length(p["head"]) + F.length(p["body"]) + 1)
    both = both.withColumn("sizes", size)
    start = lambda i: F.aggregate(F.slice("sizes", F.lit(1), i), F.lit(0), lambda a, x: a + x)
    spans = F.transform("parts", lambda p, i: F.when(p["own"], F.struct(
        (start(i) + F.length(p["head"])).alias("start"), (start(i) + F.length(p["head"]) + F.length(p["body"])).alias("end"))))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")
    return both.select("conv_id", "perspective", "chunk", text.alias("text"),
                       F.filter(spans, lambda s: s.isNotNull()).alias("spans"), F.size("turns").alias("n_turns"))


# DuckDB SQL of the query, on conversations whose marks need no breaking up
ORACLE = r"""
WITH r AS (SELECT conv_id, role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place
           FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role <> 'system'),
p AS (SELECT r.conv_id, s.perspective, place // 64 AS chunk, place, coalesce(r.role = s.perspective, false) AS own,
             '<|im_start|>' || CASE WHEN r.role = s.perspective THEN 'assistant' WHEN r.role = 'system' THEN 'system'
                                    ELSE 'user name=' || coalesce(r.role, 'unknown') END || chr(10) AS head,
             r.text || '<|im_end|>' AS body
      FROM r JOIN s ON r.conv_id IS NOT DISTINCT FROM s.conv_id),
q AS (SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, chunk ORDER BY place
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM p)
SELECT conv_id, perspective, chunk, string_agg(head || body || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg((before + length(head))::VARCHAR || '-' || (before + length(head) + length(body))::VARCHAR, ',' ORDER BY place)
                FILTER (WHERE own), '') AS spans,
       count(*)::INTEGER AS n_turns
FROM q GROUP BY conv_id, perspective, chunk
"""
