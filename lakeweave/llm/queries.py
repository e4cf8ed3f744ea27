"""The training-data operators as queries over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from lakeweave.llm import ann, embed, langid, licenses, lines, mix, packing, recompress, simhash, tokens, trie, urls, whiten

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# (host, path, verdict)
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, removed lines and digest of the kept text of every document."""
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("kept_md5"))


@query
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embed.embedding_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th vector."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mixture takes of every document, summed over its pieces."""
    documents, mixed = mix.mix_sources(table(spark, sf_dir, "documents"))
    taken = mixed.groupBy("uid").agg(F.sum("length").alias("taken"))
    return documents.join(taken, "uid", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


@query
def op6_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a packed sequence."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, removed words and digest of the kept words of every document."""
    return recompress.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs)
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    docs = table(spark, sf_dir, "documents")
    manifest = tokens.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokens.read_token_files(manifest, docs.schema["doc_id"].dataType.simpleString()).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    return licenses.license_labels(licenses.scan_licenses(table(spark, sf_dir, "documents")))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 16 leading components, whitened."""
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
