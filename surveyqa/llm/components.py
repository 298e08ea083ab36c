"""Connected components by contraction: no link or label ever reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyqa.llm.storage import staged


def components(links: DataFrame, folder: str, name: str = "cc") -> DataFrame:
    """Columns ``node`` and ``root`` for every node of ``links`` (columns ``a``, ``b``).

    Each round every node moves to the neighbour (or itself) that comes first in a pseudo-random
    order of that round, and the links are contracted. The expected number of nodes shrinks by a
    constant factor a round, whatever the shape, so the rounds grow with the logarithm of the
    largest component. Hot nodes are pre-aggregated before the shuffle; their joins can be split.
    """
    both = links.select("a", "b").filter("a <> b")
    edges = staged(both.union(both.select("b", "a")).distinct(), folder, f"{name}-links-0")
    labels, step = edges.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")), 0
    while not edges.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(step)).alias("o"), F.col(c).alias("n"))  # noqa: B023, E731
        moves = edges.groupBy("a").agg(F.min(order("b")).alias("m")).select(
            F.col("a").alias("old"), F.least("m", order("a")).getField("n").alias("new")
        )
        moves = staged(moves, folder, f"{name}-moves-{step}")
        labels = staged(
            labels.join(moves, labels["root"] == moves["old"], "left")
            .select("node", F.coalesce("new", "root").alias("root")),
            folder, f"{name}-labels-{step}",
        )
        left = edges.join(moves, edges["a"] == moves["old"]).select(F.col("new").alias("a"), "b")
        right = moves.select(F.col("old").alias("old_b"), F.col("new").alias("new_b"))
        step += 1
        edges = staged(
            left.join(right, F.col("b") == F.col("old_b")).select("a", F.col("new_b").alias("b"))
            .filter("a <> b").distinct(),
            folder, f"{name}-links-{step}",
        )
    return labels
