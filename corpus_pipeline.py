"""From raw documents to token files: five stages, each one an operator.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept.  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import decontaminate, mixing, quality, simhash, token_store
from strataflow.llm.common import id_fold, table
from strataflow.llm.queries import tokenizer_file
from strataflow.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), id_fold(F.col("doc_id"), 5) != 0)
    return quality.keep_good(docs, model)


def near_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked at 3 or fewer differing bits."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.drop_hit(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents in the order of the curriculum."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document in the token files."""
    return token_store.write_and_read(docs, tokenizer_file())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_duplicates", near_distinct),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("tokens", tokens),
]

#: A learnt classifier is no SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


REGISTRY = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
