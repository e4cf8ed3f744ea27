"""From raw documents to packed training sequences, as stages over the documents table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeweave.llm import langid, lines, mix, packing, resemblance
from lakeweave.llm.common import made_tables, release
from lakeweave.session import work_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: those rejected by distance and those without a letter go."""
    return langid.predict(docs, langid.train(docs)).where("accepted").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later copies of repeated line runs."""
    return lines.dedup_lines(docs).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the one with the smallest id. Five-word shingles, similarity 0.8 or more."""
    return resemblance.one_per_component(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes, once for every time it takes them."""
    return mix.mixed_documents(docs)


def mixture_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a packed sequence."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, with_ids=True)


_tables: list[str] = []  # intermediate tables of the stage that ran last


def _in_turn(stage, first: bool = False):
    """The stage, which first removes the intermediate tables of the stage before it: what that one kept is written by now."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not first:
            release(spark, _tables)
        before = set(made_tables())
        out = stage(spark, docs, sf_dir)
        _tables[:] = [t for t in made_tables() if t not in before]
        return out

    return run


STAGES = [
    ("language_id", _in_turn(language_id, first=True)),
    ("line_dedup", _in_turn(line_dedup)),
    ("simhash_dedup", _in_turn(simhash_dedup)),
    ("source_mix", _in_turn(source_mix)),
    ("mixture_packing", _in_turn(mixture_packing)),
]

# Fingerprints, clustered centroids and token ids are beyond SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each but the last is written to the shared folder as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
