"""Connected components of a link table by alternating stars."""

from pyspark.sql import DataFrame, functions as F

from .tasks import staged


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """`node, root` for every node with a link to another one; `root` is the smallest node reachable.

    Each round hangs every node on the smallest it knows, first over larger neighbours, then over
    smaller ones, until nothing changes; the number of rounds grows with the logarithm of the longest
    path. Minima are taken map-side and looked up by a join of two written tables, so a node with very
    many links is no special case. The driver sees a count and a checksum per round.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = staged(links.filter(F.col(a) != F.col(b)).select(u, v).distinct(), "links")
    seen = None
    while (now := _fingerprint(edges)) != seen:
        seen = now
        edges = staged(_star(edges, larger=True), "links")
        edges = staged(_star(edges, larger=False), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal sets of links: their number, and a sum of their hashes that cannot overflow."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    if larger:
        both = edges.select(F.col("u").alias("n"), F.col("v").alias("o")).unionByName(
            edges.select(F.col("v").alias("n"), F.col("u").alias("o"))
        )
        lowest = both.groupBy("n").agg(F.least(F.min("o"), F.first("n")).alias("m"))
        moved = both.filter("o > n").join(lowest, "n").select(F.col("o").alias("u"), F.col("m").alias("v"))
        return moved.filter("u <> v").distinct()
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    hung = lowest.select("u", F.col("m").alias("v"))
    return moved.filter("u <> v").unionByName(hung).distinct()
