"""Repeated lines, judged by overlapping windows of three lines. Built-in functions only.

Windows are three consecutive lines of a text that have a word (lines without one take no
part and stay). A window's key is 128 bits of its lines. Of all places where a window occurs
the first (smallest doc_id, then position) stays; the lines covered by every later place are
removed, places that overlap being merged.

One pass over the texts writes the windows (a few numbers per line) to the shared folder.
Keys are counted with a map-side combine, and places are joined to the first place of their
key: one row on that side, so a window that a third of the documents share is split by
adaptive execution. Texts are shuffled once, to meet their removed positions.

Null texts stay null, texts with under three such lines are unchanged. Rows that share a
doc_id are told apart by their text; fully equal rows are one document, changed alike.
Extra columns pass through, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.shared import need, text_key, written

BLANK = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _has_word(line: Column) -> Column:
    return F.length(F.trim(line, F.lit(BLANK))) > 0


def _worded(lines: Column) -> Column:
    """Indexes of the lines that have a word."""
    numbered = F.transform(lines, lambda x, i: F.when(_has_word(x), i))
    return F.filter(numbered, lambda i: i.isNotNull())


def windows(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, text_key, at (index among the lines with a word), a, b (key) of every window."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"),
                       F.filter(_lines(F.col("text")), _has_word).alias("lines"))
    rows = rows.select("doc_id", "text_key", F.transform("lines", lambda x: F.xxhash64(F.lit(11), x)).alias("ha"),
                       F.transform("lines", lambda x: F.xxhash64(F.lit(13), x)).alias("hb")).where(F.size("ha") >= size)
    keys = F.transform(F.sequence(F.lit(0), F.size("ha") - size), lambda i: F.struct(
        i.alias("at"), F.xxhash64(F.slice("ha", i + 1, size)).alias("a"), F.xxhash64(F.slice("hb", i + 1, size)).alias("b")))
    return rows.select("doc_id", "text_key", F.explode(keys).alias("w")).select("doc_id", "text_key", "w.at", "w.a", "w.b")


def removed_lines(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, text_key, gone: indexes (among the lines with a word) covered by later places."""
    w = written(windows(docs, size), "line-windows")
    place = F.struct("doc_id", "text_key", "at")
    first = w.groupBy("a", "b").agg(F.count(F.lit(1)).alias("held"), F.min(place).alias("first")).where("held > 1")
    # written: a join of two plain tables is one that adaptive execution can split at a hot key
    first = written(first.drop("held"), "first-places")
    later = w.join(first, ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    covered = F.sequence(F.col("at"), F.col("at") + size - 1)
    return later.groupBy("doc_id", "text_key").agg(F.array_distinct(F.flatten(F.collect_list(covered))).alias("gone"))


def count_names(docs: DataFrame) -> tuple[str, str]:
    """Names of the columns that ``dedup_lines`` adds: ``_n_lines`` and ``_n_removed``, with more
    underscores before them where ``docs`` has such a column."""
    names = []
    for name in ("_n_lines", "_n_removed"):
        while name.lower() in (c.lower() for c in docs.columns):
            name = "_" + name
        names.append(name)
    return names[0], names[1]


def dedup_lines(docs: DataFrame, size: int = 3) -> DataFrame:
    """``docs`` with the later places' lines taken out of text, and two columns added, ``_n_lines``
    and ``_n_removed`` (``count_names``)."""
    need(docs, "doc_id", "text")
    # helpers are named so that no column of the documents is taken for them
    gone = removed_lines(docs, size).withColumnsRenamed({"doc_id": "\x01id", "text_key": "\x01key", "gone": "\x01gone"})
    cond = F.col("doc_id").cast("long").eqNullSafe(F.col("\x01id")) & (text_key(F.col("text")) == F.col("\x01key"))
    both = docs.join(gone.hint("shuffle_hash"), cond, "left").withColumn("\x01lines", _lines(F.col("text")))
    # indexes among the lines with a word are turned into line indexes
    worded = _worded(F.col("\x01lines"))
    out = F.transform("\x01gone", lambda i: F.get(F.col("\x01worded"), i))
    kept = F.array_except(F.sequence(F.lit(0), F.size("\x01lines") - 1), F.col("\x01out"))
    text = F.array_join(F.transform("\x01kept", lambda i: F.get(F.col("\x01lines"), i)), "\n")
    touched = F.col("\x01gone").isNotNull()
    names = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    both = both.withColumn("\x01worded", F.when(touched, worded)).withColumn("\x01out", F.when(touched, out))
    both = both.withColumn("\x01kept", F.when(touched, kept))
    n_lines, n_removed = count_names(docs)
    return both.select(
        *names, F.when(touched, text).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size("\x01lines"), F.lit(0)).cast("long").alias(n_lines),
        F.when(touched, F.size("\x01gone")).otherwise(0).cast("long").alias(n_removed))


# DuckDB SQL with the same result. Two aggregates over a list keep it on whole tables.
ORACLE = r"""
WITH l AS (
  SELECT doc_id, text, coalesce(len(string_split(text, chr(10))), 0) AS n_lines,
         unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents),
worded AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM l WHERE regexp_matches(line, '[^ \t\n\x0b\x0c\r]')),
w AS (
  SELECT doc_id, k, line AS l1, lead(line, 1) OVER d AS l2, lead(line, 2) OVER d AS l3
  FROM worded WINDOW d AS (PARTITION BY doc_id ORDER BY k)),
later AS (
  SELECT doc_id, k FROM (
    SELECT doc_id, k, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, k) AS r FROM w WHERE l3 IS NOT NULL)
  WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, k + j AS k FROM later, (VALUES (0), (1), (2)) t(j)),
gone_i AS (SELECT worded.doc_id, worded.i FROM gone JOIN worded USING (doc_id, k)),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text
  FROM l LEFT JOIN gone_i g ON l.doc_id = g.doc_id AND l.i = g.i WHERE g.i IS NULL GROUP BY l.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone_i GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n.n, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM documents d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
