"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``.

1. quality_rules: documents that the base rules or the outlier estimate reject go.
2. line_dedup: later places of repeated three-line windows are cut out of the texts; n_chars
   follows the new text. A document that loses its last word so is a repeat, and goes.
3. near_dedup: of each group of near copies the document with the smallest doc_id stays.
4. decontamination: documents with a benchmark passage go.
5. packing: what is left becomes sequences of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.decontamination import drop_contaminated
from riskframe.llm.line_dedup import BLANK, count_names, dedup_lines
from riskframe.llm.near_dup import drop_near_duplicates
from riskframe.llm.packing import pack
from riskframe.llm.quality_rules import filter_documents
from riskframe.llm.queries import table, word_tokenizer
from riskframe.llm.shared import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out, removed = dedup_lines(docs), F.col(count_names(docs)[1]) > 0
    emptied = removed & (F.length(F.trim("text", F.lit(BLANK))) == 0)
    out = out.where(~emptied).withColumn(
        "n_chars", F.when(removed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, word_tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The outlier estimate is iterative and the ids come from a tokenizer: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
