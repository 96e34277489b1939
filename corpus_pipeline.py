"""From raw documents to packed training sequences, in five stages.

Each stage gets the documents that its predecessor kept and returns documents
with the same columns; the last returns the places of their pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import decontam, lines, minhash, packing, quality
from wattloom.llm.common import materialize, scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are neither of low quality nor toxic."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of three lines, or of 50 words, go; so do documents that have lost all they had."""
    cut = lines.drop_repeated_lines(docs, words=50)
    emptied = (F.col(cut.columns[-1]) > 0) & (F.trim("text") == "")
    return cut.where(~emptied).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest id of each group of near copies (five words, similarity 0.8); each row by its own text."""
    return minhash.drop_near_duplicates(docs, shingle=5, percent=80)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages to speak of."""
    return decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    pieces = packing.token_pieces(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)
    return packing.best_fit(pieces, capacity=1024)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("near-duplicate removal", one_of_each_group),
    ("benchmark decontamination", uncontaminated),
    ("best-fit packing", packed),
]

#: A trained classifier and a tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What the other stages leave in the shared folder goes when each has been written."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"), lasting=True)
    return STAGES[-1][1](spark, docs, sf_dir)
