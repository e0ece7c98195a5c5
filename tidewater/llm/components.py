"""Connected components of a link table, in Spark joins.

Every node hooks on to its least neighbour, pointers are doubled until they
reach a root, and the links are contracted to links between roots; that
repeats until none is left. A hub (one node linked with very many) costs one
pre-aggregated row per task in the hooking step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that stands in a link to another node;
    the component is its least node. Null ends, loops, repeated and reversed
    links change nothing; no links give an empty table."""
    links = links.select(F.least(a, b).cast("long").alias("a"), F.greatest(a, b).cast("long").alias("b"),
                         F.col(a).isNotNull().alias("x"), F.col(b).isNotNull().alias("y"))
    links = materialize(links.filter("x AND y AND a < b").select("a", "b").distinct(), "links", "parquet")
    label = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("near")))
        up = both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("up"))
        up = materialize(up, "hooked", "parquet")
        while True:
            above = up.select(F.col("node").alias("n2"), F.col("up").alias("up2"))
            jumped = materialize(up.join(above, F.col("up") == F.col("n2")).select(
                "node", F.col("up2").alias("up"), (F.col("up") != F.col("up2")).alias("moved")), "jumped", "parquet")
            up = jumped.select("node", "up")
            if jumped.filter("moved").isEmpty():
                break
        ends = [up.select(F.col("node").alias(f"n{i}"), F.col("up").alias(f"u{i}")) for i in (1, 2)]
        links = materialize(
            links.join(ends[0], F.col("a") == F.col("n1")).join(ends[1], F.col("b") == F.col("n2"))
            .select(F.least("u1", "u2").alias("a"), F.greatest("u1", "u2").alias("b")).filter("a < b").distinct(),
            "links", "parquet")
        if label is None:
            label = up.select("node", F.col("up").alias("component"))
        else:
            label = materialize(
                label.join(up.select(F.col("node").alias("n"), "up"), F.col("component") == F.col("n"), "left")
                .select("node", F.coalesce("up", "component").alias("component")), "labels", "parquet")
    if label is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return label
