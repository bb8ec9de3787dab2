"""Connected components of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import Stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``: root is the smallest node reachable."""
    return _labels(stars(links, a, b).rows)


def _labels(edges: DataFrame) -> DataFrame:
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))


class Growing:
    """Components of links that come in parts: each part is added to the stars of those before it."""

    def __init__(self):
        self.held: Stored | None = None
        self.labels: DataFrame | None = None

    def add(self, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
        before = self.held
        own = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
        self.held = stars(own if before is None else own.union(before.rows), "u", "v")
        if before is not None:
            before.drop()
        self.labels = _labels(self.held.rows)
        return self.labels


def stars(links: DataFrame, a: str = "a", b: str = "b") -> Stored:
    """(u, v) for every node u of ``links`` but the roots: v is the smallest node reachable.

    Union-find over tables: each round hangs every node's larger neighbours on its smallest
    neighbour, then the remaining ones on theirs (alternating large and small stars), so that
    components flatten in about log of their size rounds. A round is written to the shared folder,
    which keeps lineage short, and the one before it is dropped. No component is gathered in one place; a star's centre is found with
    partial minima. Nodes must not be null; no links give no rows.
    """
    # The same edges after a round as before it: nothing can change any more.
    watch = {"n": F.count(F.lit(1)), "sum": F.coalesce(F.sum(F.hash("u", "v").cast("long")), F.lit(0))}
    first = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    table = Stored(first, "links", **watch)
    while True:
        edges = table.rows
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = Stored(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "stars", **watch)
        table.drop()
        if after.seen == table.seen:
            return after
        table = after
