"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.store import Workspace


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``(node, root)`` of every node of ``edges(a, b)``: root is its component's least node.

    Each round only aggregates minima (with map-side partials), writes them, and joins them
    back; as both sides of the joins are written tables, small minima are broadcast and
    otherwise adaptive execution splits a node with very many edges. A root is a node of its own
    component, with ``node = root``. Self loops and repeated edges change nothing; no
    edges give no rows. The rounds stop when the edges no longer change, which takes a
    logarithmic number of them.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = work.write(now, f"{name}-0")
    mark, k = _mark(now), 0
    while mark[0]:
        k += 1
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        least = work.write(least, f"{name}-{k}-least")
        large = both.join(least, "x").where("y > x and y <> m").select(F.col("y").alias("u"), F.col("m").alias("v"))
        large = work.write(large, f"{name}-{k}-large")
        low = work.write(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-{k}-low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = work.write(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{k}")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
