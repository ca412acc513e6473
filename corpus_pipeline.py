"""A training corpus from raw documents: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, ngramjoin, quality, scratch, tokenfiles
from tidemark.llm.queries import vocabulary
from tidemark.session import prepare, scratch_dir


_left: list[scratch.Scratch] = []


def stage(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage starts when the one before is written, so it first drops the tables which that one was read from."""
    @wraps(operator)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            earlier = _left.pop()
            if earlier.spark is spark:  # a session that has ended has no files to drop
                earlier.drop(*earlier.paths)
        with scratch.recorded(spark) as left:
            out = operator(spark, docs, sf_dir)
        _left.append(left)
        return out

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.quality(docs, vocabulary("piece_bpe_32k.model"))
    return judged.filter("kept").select(*docs.columns)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group linked by a Jaccard of 0.8 of their 5-word shingles."""
    return ngramjoin.one_per_component(docs, n=5, percent=80)


@stage
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy that the mix of sources takes, in shuffled shards."""
    return mixing.shuffled(mixing.mixed(docs)).select(*docs.columns)


@stage
def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what they hold of each document."""
    files = tokenfiles.write_tokens(docs, vocabulary("word_bpe_49k.json"))
    return tokenfiles.read_documents(files).withColumnRenamed("id", "doc_id")


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontaminated), ("mixing sources to target weights", mixed),
          ("token-ID / binary output", token_files)]

#: The network of stages holds a seeded draw and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, run_stage in STAGES[:-1]:
        path = scratch_dir(spark, "stage")
        run_stage(spark, df, sf_dir).write.parquet(path)
        df = spark.read.parquet(path)
    return STAGES[-1][1](spark, df, sf_dir)
