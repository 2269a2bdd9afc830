"""A corpus pipeline of five stages: quality, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on everything that the stage before it kept. All but the last return the
columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import lines, mixing, packing, quality, simhash
from tideline.llm.common import delete_folder, ensure_checkpoint_dir, table
from tideline.llm.queries import tokenizer_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated three-line windows; n_chars follows. A document that loses all its lines goes."""
    found = lines.dedup_lines(docs).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    old, new = F.col("doc").getField("n_chars"), F.length("text").cast("bigint")
    values = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, new).otherwise(old)}
    return found.select(*[values.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.take_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and where they stand."""
    return packing.pack(packing.pieces(docs, tokenizer_path()))


STAGES = [
    ("quality", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The classifier and SimHash are not SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. Between stages the rows are a Parquet table in the shared folder; one that has been read by
    the stage after it is removed, so only the last one stays, which the result reads."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}-{name}")
        docs = spark.read.parquet(f"{folder}/{n}-{name}")
        if n:
            delete_folder(spark, f"{folder}/{n - 1}-{STAGES[n - 1][0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
