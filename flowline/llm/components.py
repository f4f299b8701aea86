"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowline.operators.keys import distinct_apart, group_apart
from flowline.session import cut_lineage


def _downward(a: Column, b: Column) -> tuple[Column, Column]:
    """The pair with its larger end first."""
    return F.greatest(a, b).alias("u"), F.least(a, b).alias("v")


def _state(links: DataFrame) -> tuple[int, int]:
    """Number and order-free digest of the links: equal for equal sets of them."""
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1] or 0


def connected_components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the pairs; root is the smallest node of its component.

    Alternates two steps until nothing changes: each node hands its larger
    neighbours to the smallest one it sees, then its smaller ones. Both keep the
    components, and they end in stars around the smallest nodes after a number
    of rounds that grows with the logarithm of a component's size. A round is a
    minimum per node, combined before the shuffle, and a join that adaptive
    execution can split at a hot node; each round's links are written to the
    shared folder. Pairs of a node with itself count for nothing; pairs with a
    null are left out.
    """
    known = pairs.filter(F.col(a) != F.col(b))
    links = known.select(*_downward(F.col(a).cast("bigint"), F.col(b).cast("bigint")))
    links = cut_lineage(distinct_apart(links, "u", "v"), "links")
    state = _state(links)
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = group_apart(both, ["u"], F.min("v").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u"))
        large = distinct_apart(large.select(F.col("v").alias("u"), F.least("u", "m").alias("v")), "u", "v")
        large = cut_lineage(large, "links")
        least = group_apart(large, ["u"], F.min("v").alias("m"))
        small = large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v")))
        links = cut_lineage(distinct_apart(small, "u", "v"), "links")
        new = _state(links)
        if new == state:
            break
        state = new
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
