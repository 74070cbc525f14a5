"""A corpus from raw documents to token ids: five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowgrid.llm import bpe, decontaminate, line_dedup, ngram_join, quality
from sparrowgrid.llm.queries import bpe_path
from sparrowgrid.llm.shared import discard, free, ready, through_parquet


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines are taken out; a document that loses lines and has nothing but blanks left goes."""
    ready(spark)
    # Names of its own, so that no column of the input is taken for one of them.
    added = tuple(free(docs.columns, c) for c in ("_lines", "_removed", "_left"))
    removed = F.col(added[1])
    out = line_dedup.dedup(docs, added=added).filter((removed == 0) | F.col("text").rlike(r"(?U)\S"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(removed > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the smallest doc_id."""
    ready(spark)
    return ngram_join.one_of_each(docs)


def unleaked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and whether decoding gives the text again."""
    out = bpe.encode(docs, bpe_path(), keep=["doc_id", "lang", "source", "text"], decoded="decoded")
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", distinct_lines),
    ("n-gram Jaccard join", distinct_documents),
    ("benchmark decontamination", unleaked_documents),
    ("BPE encoding", token_ids),
]

#: The classifier, edit similarity, spaced seeds and BPE are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (_, stage) in enumerate(STAGES):
        docs = through_parquet(stage(spark, docs, sf_dir), f"stage{k}", written)
    # Only the last stage's table is read from here on.
    discard(spark, written[:-1])
    return docs
