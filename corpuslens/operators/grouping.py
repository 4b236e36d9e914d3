"""Threads, reply components and bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.operators.ordering import ranked
from corpuslens.sources.tables import checkpoint_folder


def subject_threads(df: DataFrame, keys: list[str], at: str, days: int) -> DataFrame:
    """Groups of two or more whose whole span is within ``days``; others are dropped whole."""
    span = df.groupBy(*keys).agg(F.count("*").alias("size"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))
    return span.where((F.col("size") >= 2) & (F.col("last_at") - F.col("first_at") <= F.expr(f"interval {days} days")))


def related(df: DataFrame, group: str, key: str, order: str) -> DataFrame:
    """The other members of each row's thread, in thread order.

    The list is the result, so it grows with the thread: use ``positions``, which has a
    thread's order in one row a member, where threads may be very long.
    """
    members = df.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(order, key))).alias("m"))
    ids = F.transform("m", lambda x: x[key])
    return df.join(members.select(group, ids.alias("ids")), group).select(group, key, F.filter("ids", lambda x: x != F.col(key)).alias("related"))


def reply_components(edges: DataFrame, parts: list[str]) -> DataFrame:
    """The least node that reply edges ``(a, b)`` reach, within each partition ``parts``.

    Labels spread to neighbours and then jump to their label's label, so rounds are
    logarithmic in the longest chain; each is written out in the checkpoint folder.
    """
    checkpoint_folder(edges.sparkSession)
    both = edges.select(*parts, "a", "b").unionByName(edges.select(*parts, F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    labels = both.groupBy(*parts, "a").agg(F.least("a", F.min("b")).alias("root"))
    while True:
        near = both.join(labels.select(*parts, F.col("a").alias("b"), F.col("root").alias("r")), [*parts, "b"]).groupBy(*parts, "a").agg(F.min("r").alias("r"))
        low = labels.join(near, [*parts, "a"]).select(*parts, "a", F.least("root", "r").alias("root"))
        jump = low.select(*parts, F.col("a").alias("root"), F.col("root").alias("far"))
        new = low.join(jump, [*parts, "root"], "left").select(*parts, "a", F.coalesce("far", "root").alias("root")).checkpoint()
        changed = new.join(labels.withColumnRenamed("root", "old"), [*parts, "a"]).where("root <> old")
        labels, done = new, changed.isEmpty()
        if done:
            return labels


def positions(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Each row's place in its thread and the thread's size; no task sorts a whole thread."""
    rows = ranked(df, [group], order, "position")
    return rows.withColumn("position", F.col("position").cast("int")).withColumnRenamed("__size", "size")
