"""Connected components of a large graph, by alternating stars.

Each round hangs every node on the smallest node it can see, first from the side of its
larger neighbours, then from that of its smaller ones. Rounds grow with the logarithm of the
longest chain. No neighbour list is ever gathered: a round is two minimum aggregates and two joins
whose one side has a row for each node, so a node with very many neighbours is split by
adaptive execution. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmart.session import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)`` that is not the smallest of its component.

    The root is the smallest node of the component. Nulls and loops are no edges; repeated edges
    and either direction count once; without edges the result is empty.
    """
    pairs = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "components",
    )
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        pairs = materialise(small, "components")
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
