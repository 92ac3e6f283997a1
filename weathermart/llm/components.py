"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weathermart.sources.paths import materialize

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node go to the smallest node around it."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.join(least, "a")
        .where((F.col("b") > F.col("a")) & (F.col("b") != F.col("m")))
        .select(F.col("m").alias("a"), "b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").where(F.col("a") != F.col("m"))
    return (
        moved.select(F.col("m").alias("a"), F.col("a").alias("b"))
        .unionAll(least.select(F.col("m").alias("a"), "b"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of all nodes in ``edges`` (a, b), a < b.

    Every round is written to shared storage, so neither lineage nor lost executors
    matter. Minima are taken inside tasks first and joined back, so a node with very
    many neighbours is no group in one task. Rounds grow with the logarithm of the
    longest path.
    """
    now = materialize(edges.select("a", "b").distinct(), "edges")
    print_ = F.bit_xor(F.xxhash64("a", "b"))
    seen = None
    for _ in range(MAX_ROUNDS):
        now = materialize(_small_star(_large_star(now)), "edges")
        here = tuple(now.agg(F.count("*"), print_).first())
        if here == seen:
            return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(
                now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
            )
        seen = here
    raise RuntimeError("components did not settle")
