"""Row-level helpers shared by the operators that drop documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stay(docs: DataFrame, keepers: DataFrame, on: dict[str, Column]) -> DataFrame:
    """The rows of ``docs`` that ``keepers`` names, one row for each of its rows.

    ``keepers`` has the columns named in ``on`` and ``repeats`` (rows of ``docs`` with
    that key); ``on`` gives each key column's expression over ``docs``. The columns of
    ``docs`` are returned as they are. Only keys that repeat pass a window, whose limit
    of one row is applied before its shuffle too.
    """

    def semi(rows: DataFrame, names: DataFrame) -> DataFrame:
        names = names.select(*[F.col(k).alias(f"__stay_{k}") for k in on])
        match = [c.eqNullSafe(F.col(f"__stay_{k}")) for k, c in on.items()]
        condition = match[0]
        for m in match[1:]:
            condition = condition & m
        return rows.join(names, condition, "left_semi")

    once = semi(docs, keepers.where("repeats = 1"))
    many = keepers.where("repeats > 1")
    if many.isEmpty():
        return once
    own = [docs[c] for c in docs.columns]
    order = Window.partitionBy(*on.values()).orderBy(F.xxhash64(*own))
    again = semi(docs, many).withColumn("__stay_rank", F.row_number().over(order)).where("__stay_rank = 1")
    return once.unionByName(again.drop("__stay_rank"))
