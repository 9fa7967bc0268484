"""Connected components of links, as Spark joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); root is the least node of its component.

    Alternates two steps until nothing changes: every node hands its least neighbour to
    its larger neighbours, then to its smaller ones. A node's neighbours are never
    gathered in one place (a grouped minimum and an equi-join), and a component of any
    shape needs a number of rounds that is logarithmic in its size.
    """
    edges = written(links.where(F.col("a") != F.col("b"))
                    .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = written(large.join(least, "u")
                        .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                  F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                        .select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct(), "edges")
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
