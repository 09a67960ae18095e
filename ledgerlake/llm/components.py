"""Connected components of links, by alternating stars over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored


def _mark(edges: DataFrame):
    """Tells one set of links from another."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _lowest(toward: DataFrame) -> DataFrame:
    """Per node ``a`` its lowest neighbour, stored: joins with it can be split by key."""
    return stored(
        toward.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")), "links-lowest"
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every linked node but the component's lowest, its name.

    ``links`` has columns a and b. A large star hangs a node's higher neighbours on its
    lowest one, a small star its lower neighbours; the two alternate until nothing
    changes, a number of rounds that grows with the logarithm of the longest chain. A
    round joins and aggregates; no component ever meets in one task.
    """
    edges = stored(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = _mark(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_lowest(both), F.col("a") == F.col("node")).where("b > a")
        large = stored(
            large.select(F.col("b").alias("a"), F.least("low", "a").alias("b")).distinct(),
            "links-large",
        )
        small = large.join(_lowest(large), F.col("a") == F.col("node"))
        small = small.select(
            F.explode(
                F.array(
                    F.struct(F.col("a"), F.col("low").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
                )
            ).alias("e")
        )
        edges = stored(small.select("e.a", "e.b").where("a <> b").distinct(), "links-small")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
