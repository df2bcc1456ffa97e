"""Connected components by alternating large and small stars; no group is ever gathered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).select(F.col("u").alias("of"), "m")
    return both.filter("v > u").join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), "m")
    tied = edges.join(least, F.col("u") == F.col("of")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionAll(least.select(F.col("of").alias("u"), F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (columns ``a`` and ``b``) that is not the smallest of its component.

    Rounds end when the edges no longer change; their number grows with the logarithm of the links. Links of a node
    to itself, repeated links and nulls add nothing; no links give no rows.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "edges")
    before = _state(edges)
    while before[0]:
        edges = stored(_small(_large(edges).distinct()).filter("u <> v").distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
