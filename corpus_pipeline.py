"""From raw documents to the token ids of a training mixture, in five stages.

Every stage works on all that the one before it kept. Each is written as Parquet and read
again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayside.llm import decontaminate, jaccard_join, mixing, quality, subwords, token_files
from wayside.llm.queries import reach, table
from wayside.session import materialize, scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    reach(spark)
    return quality.keep_good(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    reach(spark)
    return jaccard_join.drop_near_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    reach(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped and repeated until their sources have the target weights."""
    reach(spark)
    return mixing.mix_sources(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All texts are written as token ids; the index is read back from the files."""
    reach(spark)
    path = scratch_path(spark, "token-ids")
    token_files.write_tokens(docs, path, subwords.default_path())
    return token_files.read_index(spark, path)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_output),
]

#: The classifier and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
