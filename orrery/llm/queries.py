"""The registered queries of the operators, thin over their general interfaces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, divergence, fertility, jaccard, language, mixing, neighbours, pii, quality, substrings, toxicity, urls
from .oracles import ORACLES  # noqa: F401
from .tables import fold, table

#: The host and path rules of the URL query.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def tokenizer_file(name: str) -> str:
    """The public vocabulary files come with an installed package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, fold("doc_id", 3) != 1)
    return language.identify(docs, model).withColumn("held_out", fold("doc_id", 3) == 1)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_encode(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), digest=True)


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"), digest=True)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    scored = quality.quality_scores(docs, model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = mixing.sizes_of(docs)
    taken = F.col("size") * F.size("copies")
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.transform("copies", lambda c: c["shard"]).alias("shards"))


def op7_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.fertility_rules(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.train(docs))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    scored = toxicity.toxicity_scores(docs, model)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard": op1_jaccard,
    "op2_language_id": op2_language_id,
    "op3_bpe": op3_bpe,
    "op4_substrings": op4_substrings,
    "op5_quality": op5_quality,
    "op6_mixing": op6_mixing,
    "op7_fertility": op7_fertility,
    "op8_pii": op8_pii,
    "op9_urls": op9_urls,
    "op10_neighbours": op10_neighbours,
    "op11_centroids": op11_centroids,
    "op12_toxicity": op12_toxicity,
    "op13_divergence": op13_divergence,
}
