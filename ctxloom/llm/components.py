"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxloom.llm.common import stored


def _stars(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link each node's neighbours to the smallest node among them and itself.

    ``larger_only`` links the larger neighbours (the edges come in both directions); else all, and the
    edges run from the larger to the smaller end.
    """
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = edges.join(least, "u")
    if larger_only:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    neighbours = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return neighbours.unionByName(least.filter("u <> m").select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node that it can reach.

    Alternating large and small stars: every round at least halves the longest paths to a root, and a
    round only aggregates and joins, with a partial minimum before each shuffle. Each round's edges are
    written to the shared folder. Self-links and repeated links are allowed; null ends are ignored; no
    edges give no rows.
    """
    links = edges.filter("a is not null and b is not null and a <> b")
    links = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = stored(links, "links")
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, larger_only=True).filter("u <> v").distinct()
        small = stored(_stars(large, larger_only=False).distinct(), "links")
        # A star forest that the round leaves as it is: as many edges, none of them new.
        changed = small.exceptAll(links).limit(1).count() or links.exceptAll(small).limit(1).count()
        links = small
        if not changed:
            break
    else:
        raise RuntimeError(f"no end after {max_rounds} rounds")
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
