"""Connected components of a table of links, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.common import saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for every node with a link; the component is its least node.

    Each round takes the least label among a node and its neighbours, then the label of
    that label, so the distance covered doubles. A hub's links combine before the shuffle.
    Rounds end when no label changes. Null ends are ignored.
    """
    both = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.explode(F.array(
            F.struct(F.col(a).alias("node"), F.col(b).alias("other")),
            F.struct(F.col(b).alias("node"), F.col(a).alias("other")),
        )).alias("e")
    ).select("e.*").where(F.col("node") != F.col("other"))
    edges = saved(both, "edges")
    labels = saved(
        edges.groupBy("node").agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        near = edges.join(
            labels.select(F.col("node").alias("other"), F.col("component").alias("theirs")), "other"
        ).groupBy("node").agg(F.min("theirs").alias("theirs"))
        lowered = labels.join(near, "node").select(
            "node", "component", F.least("component", "theirs").alias("lower"))
        up = labels.select(F.col("node").alias("lower"), F.col("component").alias("jump"))
        moved = saved(
            lowered.join(up, "lower").select(
                "node", F.least("lower", "jump").alias("component"),
                (F.least("lower", "jump") != F.col("component")).alias("changed")), "labels")
        labels = moved.select("node", "component")
        if moved.where("changed").isEmpty():
            return labels
