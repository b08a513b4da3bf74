"""Registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_random_indexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.classifier import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.quality_rules import quality_rules

    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "distance2")


@query
def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.near_dup import near_duplicates

    # here every copy of a repeated row is kept with its id; a null id is that of a null component
    return near_duplicates(table(spark, sf_dir, "documents")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@query
def op5_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.substring_dedup import substring_dedup

    out = substring_dedup(table(spark, sf_dir, "documents"), digest=True)
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op2_configuration_lp(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), word_tokenizer())


@query
def op3_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.line_dedup import count_names, dedup_lines

    docs = table(spark, sf_dir, "documents")
    n_lines, n_removed = count_names(docs)
    out = dedup_lines(docs)
    return out.select("doc_id", F.col(n_lines).alias("n_lines"), F.col(n_removed).alias("n_removed"), "text")


@query
def op9_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.warc import read_index, write_archive
    from riskframe.session import scratch_path

    path = scratch_path(spark, "llm-archive")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_index(spark, path)


@query
def op6_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.decontamination import hits

    found = hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", F.col("m").alias("n_words"), "similarity")


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


@query
def op7_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.chat import rotate

    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return rotate(table(spark, sf_dir, "conversations")).withColumn("spans", spans)


@query
def op11_chebyshev(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_pointer_jumping(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.manifest import document_manifest

    return document_manifest(table(spark, sf_dir, "documents"))


@query
def op13_universe_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskframe.llm.set_join import similar_sets

    return similar_sets(table(spark, sf_dir, "documents"))


def _oracles() -> None:
    from riskframe.llm import chat, line_dedup, manifest, warc

    ORACLES["op3_line_windows"] = line_dedup.ORACLE
    ORACLES["op7_perspectives"] = chat.ORACLE
    ORACLES["op9_archive"] = warc.ORACLE
    ORACLES["op12_pointer_jumping"] = manifest.oracle()


_oracles()
