"""Corpus pipeline over ``documents``: quality rules, SimHash near-dedup, benchmark decontamination, mixing,
sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of ``documents``. ``run`` writes each stage's rows as Parquet in the shared
folder and reads them again for the next, so a lost executor costs at most one stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowruns.llm.common import staged, table
from flowruns.llm.decontaminate import drop_contaminated
from flowruns.llm.mixing import mixed
from flowruns.llm.quality_rules import keep_good
from flowruns.llm.sharding import ring_shards
from flowruns.llm.simhash import drop_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the divergence rules keep."""
    return keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: shingles of 4 words, at most 4 differing bits."""
    return drop_near_copies(docs, shingle=4, budget=4)


def benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a copy of an item of ``benchmark``."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: rows as often as they are taken."""
    return mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return ring_shards(docs)


STAGES = [("quality rules", quality), ("SimHash near-dedup", near_copies), ("benchmark decontamination", benchmark_copies),
          ("mixing to target weights", mixture), ("sharding", shards)]

#: SimHash groups, alignment and the ring walk are not SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
