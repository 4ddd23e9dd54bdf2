"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.session import new_scratch_dir

MAX_ROUNDS = 60


def connected(links: DataFrame) -> DataFrame:
    """Each node of ``links`` (columns a, b) with ``root``, the smallest node it reaches.

    Every round hangs the neighbours of a node below its smallest neighbour, first
    the larger ones (large star), then the smaller ones (small star). The rounds
    grow with the logarithm of a component's diameter; each writes its links to
    the shared folder, and a digest of them tells when nothing changes. Loops,
    repeated links and links in both directions are fine; a null end is no link.
    """
    spark = links.sparkSession
    folder = new_scratch_dir(spark, "components")
    edges = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    for turn in range(MAX_ROUNDS):
        path = f"{folder}/{turn}"
        edges.write.parquet(path)
        edges = spark.read.parquet(path)
        digest = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if digest == before:
            break
        before = digest
        edges = _small_star(_large_star(edges))
    else:
        raise RuntimeError(f"links still change after {MAX_ROUNDS} rounds")
    below = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return below.union(below.select(F.col("root").alias("node"), "root").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).union(moved).distinct()
