"""One query for each corpus operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lorekit.llm import bpe, graph, hilbert, licences, lines, minhash, mixing, oracle, png, rans, toxicity
from lorekit.llm.common import settle


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_edit_join_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(documents(spark, sf_dir))


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.hilbert_shards(documents(spark, sf_dir), shards=40)


def op3_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), words=4)


def op4_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, table = rans.write(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end=2)
    return rans.read(files, table)


def op5_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op8_png_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return png.describe(settle(png.to_media(documents(spark, sf_dir)), "media"))


def op9_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return graph.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir)).drop("places")


QUERIES = {f.__name__: f for f in (op1_edit_join_lines, op2_hilbert_shards, op3_circulant_minhash, op4_rans_tokens, op5_forced_boundary_bpe, op6_source_mixing, op7_toxicity, op8_png_media, op9_pruned_graph, op10_licence_scan)}
ORACLE_SQL: dict[str, str] = oracle.SQL
