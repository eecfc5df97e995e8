"""The registered queries of this package: thin callers of the operators that
derive the digest columns, and the DuckDB statement of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    bpe, decontam, hardneg, hnsw, langid, quality, quoting, runs, secrets, sharding, simhash, tokencount, urlfilter,
)
from quayside.llm.common import doc_bucket, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def rank_file(name: str = "byte_bpe_multi_50k.tiktoken") -> bytes:
    """The content of a public tokenizer's rank file, read where the driver runs."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@register("op1_quotation_linking", quoting.ORACLE)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations don't quote: they are first turned, in Spark, into messages that do."""
    found = quoting.link(quoting.quoting_messages(table(spark, sf_dir, "conversations")))
    return found.withColumnRenamed("conv", "conv_id")


@register("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), rank_file())).withColumnRenamed("id", "doc_id")


@register("op3_language_viterbi")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select(F.col("id").alias("doc_id"), (doc_bucket(F.col("id"), 5) == 0).alias("held_out"),
                        F.col("lang").alias("lang_pred"), "score", F.size("spans").alias("n_spans"))


@register("op4_simhash_pivots")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_print(F.col("fp")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


@register("op5_benchmark_decontamination", decontam.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_shingles", "n_found", "containment")


@register("op9_quality_mil")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scores(docs, model).select(
        F.col("id").alias("doc_id"), (doc_bucket(F.col("id"), 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@register("op10_secret_scan", secrets.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        F.col("id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.as_text(F.col("spans"), secrets.BASE), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"))


@register("op6_embedding_hnsw", hnsw.ORACLE)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnsRenamed(
        {"id": "vec_id", "component": "component_id"})


@register("op7_url_vocabulary", urlfilter.ORACLE)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@register("op8_hash_tree_sharding", sharding.ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), 24).withColumnRenamed("id", "doc_id")


@register("op11_hard_negatives", hardneg.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anchors are the ids divisible by 100; ids divisible by 7 get the next label first."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hardneg.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)
    return found.withColumnsRenamed({"anchor": "anchor_id", "positive": "positive_id", "negative": "negative_id"})


def with_repeats(docs: DataFrame) -> DataFrame:
    """The table of op12: a tenth of the documents, by their ids, go round and round from some word on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    rows = docs.select("doc_id", "text", g.alias("g"), F.when(
        h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"))
    rows = rows.withColumn("n", F.nullif(F.size("words"), F.lit(0))).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    turns = F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int"))
    whole = F.slice(F.flatten(F.concat(F.array(F.slice("words", F.lit(1), F.col("a"))), turns)), F.lit(1), F.col("n"))
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


@register("op12_word_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(with_repeats(table(spark, sf_dir, "documents")))
    return runs.digests(found).withColumnRenamed("id", "doc_id")


@register("op13_token_counts")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokencount.count_tokens(table(spark, sf_dir, "documents"), rank_file("byte_bpe_50k.json"))
    return found.withColumnRenamed("id", "doc_id")
