"""Connected components of a link table, with every step a join or an aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, release

#: Rows of a written table for each of its files.
ROWS_PER_FILE = 500_000


def files_for(rows: int) -> int:
    return 1 + rows // ROWS_PER_FILE


def components(links: DataFrame, files: int | None = None, most_rounds: int = 60) -> DataFrame:
    """(id, component) for every id of the links (a, b); component is the smallest id of its component.

    Each round hangs the larger neighbours of a node, and the node, on its smallest neighbour (large star), and
    then its smaller neighbours likewise (small star); the links become stars around the smallest ids in a few
    rounds, and never more in number. A node's neighbours are never gathered: the smallest comes from a
    partial aggregation and is joined back, so a node with very many links is split like any other row.
    The number of files follows the number of links, which only falls; ``files``: where it is known beforehand.
    """
    edges = materialize(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links", files)
    files = files or files_for(edges.count())
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        nxt = materialize(small.unionByName(low2.select("u", F.col("m").alias("v"))).where("u <> v")
                          .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links", files)
        release(edges)
        # stars: no node is at once a centre and hung on another, and none hangs twice
        inner = nxt.select("u").join(nxt.select(F.col("v").alias("u")), "u", "left_semi").limit(1)
        twice = nxt.groupBy("u").count().where("count > 1").select("u").limit(1)
        edges = nxt
        if inner.unionByName(twice).isEmpty():
            break
    else:
        raise RuntimeError("the components did not settle")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
