"""The corpus pipeline: quality classifier, SimHash near-dedup, benchmark
decontamination, secret scan, byte-level BPE. Each stage reads, as Parquet, what
its predecessor kept; all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import bpe, decontam, quality, secrets, simhash
from quayside.llm.common import Scratch, table
from quayside.llm.queries import rank_file


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose passages, weighed by the trained attention, score under 0.5 go.

    The model is fitted on ``documents`` itself, as in the query, so that what it
    learns doesn't depend on what this stage is given."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_first(docs)


def decontam_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_found(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are cut out of the texts; all documents stay."""
    return secrets.redact(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: number of tokens and digests of its ids and of the
    bytes they decode to."""
    return bpe.digests(bpe.encode(docs, rank_file())).withColumnRenamed("id", "doc_id")


STAGES = [("quality classifier", quality_stage), ("SimHash near-dedup", simhash_stage),
          ("benchmark decontamination", decontam_stage), ("secret scans", secrets_stage),
          ("byte-level BPE", bpe_stage)]

#: The trained classifier and the tokenizer can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.keep(docs, f"stage{k}")
    return docs
