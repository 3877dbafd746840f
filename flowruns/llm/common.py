"""Helpers shared by the operators: words, staged tables, row keys, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowruns.session import ensure_checkpoint_dir

#: White space and words of every operator here: ASCII blanks separate, everything else is a word.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, so a lost
    executor costs only the tasks that read it, and gives later joins true sizes."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: str = "text"):
    """Hash that tells texts of one doc_id apart (null is a value of its own)."""
    return F.xxhash64(F.col(text), F.col(text).isNull())


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the least node reachable.

    Alternating large-star and small-star steps: each is a grouped minimum (partially
    aggregated before its shuffle) and a join on the node. The minima are written out before their
    join: beside an aggregate of the same stage, adaptive execution could not split the
    links of a hot hub. Each round is written to the shared folder. No links or
    components reach the driver, only a row count and a checksum per round.
    """
    e = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = staged(edges.where("u <> v").select(*e).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = now.union(now.select("v", "u"))
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "large")
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        now = staged(small.where("u <> v").select(*e).distinct(), "edges")
        mark = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select("v", "v").distinct())
