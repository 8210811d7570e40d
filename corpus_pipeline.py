"""The training-data pipeline: documents through five operators, each stage stored before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.llm import bpe, jaccard, mixing, pii, quality
from orrery.llm.queries import tokenizer_file
from orrery.llm.tables import table
from orrery.session import materialize

QUALITY_AT_LEAST = 0.3
SHARD_WORDS = 2_000_000
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Rows and bytes handed to Python at once: long texts fill buffers on both sides of every task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; empty and null texts have the model's prior score."""
    small_batches(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    scored = quality.quality_scores(docs, model, keep=tuple(docs.columns), score="_score")
    return scored.where(F.col("_score") >= QUALITY_AT_LEAST).select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group connected by five-word Jaccard similarity of 0.8 or more.

    Documents without words are in no group and stay, and so do rows with a null id. Rows of one id with different texts
    are different documents, the smaller hash of the text first; of rows with the same id and text one stays, the first
    by its other columns.
    """
    small_batches(spark)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        groups = materialize(jaccard.jaccard_groups(docs, width=5, percent=80), "pipeline-groups")
        return docs.join(groups.where("component_id <> doc_id").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    paired = docs.withColumn("_pair", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    groups = materialize(jaccard.jaccard_groups(paired, width=5, percent=80, key="_pair"), "pipeline-groups")
    named = groups.where("_pair is not null").join(paired.select("_pair", "doc_id").distinct(), "_pair")
    leaders = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "_pair")).alias("lead")).select("lead._pair")
    first = Window.partitionBy("_pair").orderBy(*(c for c in docs.columns if c not in ("doc_id", "text")))
    kept = paired.join(leaders, "_pair", "left_semi").withColumn("_place", F.row_number().over(first)).where("_place = 1")
    return kept.select(*docs.columns).unionAll(docs.where("doc_id is null"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pii.mask_pii(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture, a row for each time it takes a document, in shards and in order within them."""
    sized = mixing.sizes_of(docs)  # the only pass over the texts beside the result's
    words = sized.agg(F.sum("size").alias("n")).first()["n"] or 0
    mixed = mixing.mixture(docs, shards=max(16, words // SHARD_WORDS), sized=sized)
    return mixed.repartition("shard").sortWithinPartitions("shard", "shard_order").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe.bpe_encode(docs, tokenizer_file("word_bpe_49k.json"), keep_pieces=False)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_distinct),
    ("personal_data", mask_personal),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: No stage but the last's digest could be put in SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
