"""The operators over the given tables, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import (
    ann,
    collocations,
    decontaminate,
    host_paths,
    lexical_search,
    mixing,
    ppm,
    quality,
    secret_spans,
    simhash,
    suffix_dedup,
    token_store,
    tool_calls,
)
from strataflow.llm.sql import ORACLE  # noqa: F401
from strataflow.llm.common import id_fold, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document, learnt from four folds of five."""
    docs, fold = table(spark, sf_dir, "documents"), id_fold(F.col("doc_id"), 5)
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold != 0)
    folded = docs.withColumn("held_out", F.coalesce(fold == 0, F.lit(False)))
    return quality.score(folded, model, ["doc_id", "held_out"])


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of each document, learnt from nine folds of ten."""
    return ppm.score(table(spark, sf_dir, "documents"), id_fold(F.col("doc_id"), 10) == 0)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    return simhash.group(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op4_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return host_paths.extract(table(spark, sf_dir, "pages"))


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message in its place, as canonical JSON."""
    return tool_calls.format_messages(table(spark, sf_dir, "conversations"))


def tokenizer_file() -> str:
    """The file the token queries use; operators take its path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's ids, read back from the files."""
    return token_store.write_and_read(table(spark, sf_dir, "documents"), tokenizer_file())


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in each document."""
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from each document, and when."""
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken",
        F.try_element_at("positions", F.lit(1)).alias("first_position"),
        F.try_element_at("positions", F.lit(2)).alias("second_position"),
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in each document."""
    docs = table(spark, sf_dir, "documents")
    found = secret_spans.find(docs, secret_spans.train(docs))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "n_markov",
        F.sha2(F.concat_ws(",", "base_spans"), 256).alias("base_sha256"),
        F.concat_ws(",", "spans").alias("spans"),
    )


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of each benchmark item."""
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 most surprising phrases of each language."""
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the byte strings that started earlier."""
    done = suffix_dedup.remove(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


REGISTRY = {
    "op1_quality": op1_quality,
    "op7_decontamination": op7_decontamination,
    "op8_nearest": op8_nearest,
    "op10_secrets": op10_secrets,
    "op2_ppm": op2_ppm,
    "op3_simhash": op3_simhash,
    "op4_host_paths": op4_host_paths,
    "op5_tool_calls": op5_tool_calls,
    "op6_token_store": op6_token_store,
    "op9_mixing": op9_mixing,
    "op11_lexical": op11_lexical,
    "op12_collocations": op12_collocations,
    "op13_suffixes": op13_suffixes,
}
