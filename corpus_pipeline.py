"""From raw documents to packed training sequences, in stages that each write a table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import decontamination, line_dedup, packing, quality, queries, similarity
from claimlake.llm.common import DOCUMENT_COLUMNS, shared_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Packing needs a tokenizer, which SQL has not.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, with the text that is left of them."""
    judged = quality.judged(docs, carry=("lang", "source"))
    return judged.where("kept").select(
        "doc_id", F.col("clean_text").alias("text"), "lang", "source", F.char_length("clean_text").cast("bigint").alias("n_chars")
    )


def site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the boilerplate lines of its source; copies are for the next stage to find."""
    cleaned = line_dedup.without_boilerplate(docs, line_dedup.LineDedupParams(copies_once=True), carry=("lang",))
    return cleaned.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*DOCUMENT_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose word shingles link it."""
    return similarity.one_per_class(docs).select(*DOCUMENT_COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item."""
    carried = tuple(c for c in DOCUMENT_COLUMNS if c != "doc_id")
    judged = decontamination.judged(docs, table(spark, sf_dir, "benchmark"), carry=carried)
    return judged.where("NOT contaminated").select(*DOCUMENT_COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence."""
    # workers that ran the stages before hold memory, so less is remembered than in a run alone
    return packing.pack(docs, queries.packing_params(cached_bytes=80 << 20))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", site_lines),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminated),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is kept in the shared folder."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
