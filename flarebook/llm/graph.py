"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flarebook.llm.tables import scratch


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` of every node of undirected ``a``, ``b``; the root is the smallest node.

    Each round hangs a node's larger neighbours on its smallest one, then its
    smaller ones, until nothing changes; that takes about the logarithm of the
    longest path. Rounds are written to the shared folder, so a lost executor
    costs no more than the round. Minima are combined before they are shuffled
    and only then joined, so a node with very many neighbours is no hot spot.
    """
    spark = edges.sparkSession

    def stored(frame: DataFrame) -> tuple[DataFrame, tuple]:
        folder = scratch(spark, "stars")
        frame.write.parquet(folder)
        back = spark.read.schema(frame.schema).parquet(folder)
        return back, tuple(back.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    stars = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    stars, print_before = stored(stars)
    while True:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a")
        hung = small.select("a", F.col("least").alias("b")).union(
            small.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        )
        stars, print_after = stored(hung.distinct())
        if print_after == print_before:
            break
        print_before = print_after
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
