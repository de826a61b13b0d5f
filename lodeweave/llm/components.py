"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeweave.llm.common import written


def _large(e: DataFrame) -> DataFrame:
    """Each neighbour larger than u goes to the smallest of u and its neighbours."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()


def _small(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of these."""
    least = e.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("m"))
    to = e.select(F.col("b").alias("n"), F.col("a").alias("x")).join(least, "n").select("m", "x").where("m < x").unionByName(least.select("m", F.col("n").alias("x")))
    return to.select(F.col("m").alias("a"), F.col("x").alias("b")).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(id, comp) for each node of the pairs (a, b): comp is the smallest id that it is connected with.

    Pairs with a null end or of a node with itself add nothing. The steps stop once every node hangs on
    its component's smallest one, after about log2 of the longest path; each writes its edges to the shared folder.
    """
    e = pairs.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    while True:
        e = written(_small(_large(e)), "edges")
        many = e.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
        if many and e.select(F.col("a").alias("x")).distinct().join(e.select(F.col("b").alias("x")), "x", "left_semi").isEmpty():
            break
    return e.select(F.col("b").alias("id"), F.col("a").alias("comp")).unionByName(e.select("a").distinct().select(F.col("a").alias("id"), F.col("a").alias("comp")))
