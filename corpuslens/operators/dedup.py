"""Duplicate groups, survivors, leakage and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.operators.ordering import first_by


def survivors(df: DataFrame, digest: str, order: list[Column]) -> DataFrame:
    return first_by(df, [digest], order)


def aligned(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """A one-to-one join that raises an error at a key that is null, repeated or on one side only."""
    side = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    n = side(left, "__l").join(side(right, "__r"), key, "full").select(F.coalesce(key).alias(key), "__l", "__r")
    fault = F.when(F.col(key).isNull(), "null key").when(F.col("__l").isNull() | F.col("__r").isNull(), "key on one side only").when((F.col("__l") > 1) | (F.col("__r") > 1), "repeated key")
    checked = n.where(F.when(fault.isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(fault, F.lit(": "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean"))).select(key)
    return checked.join(left, key).join(right, key)


def duplicate_groups(df: DataFrame, digest: str, key: str, conflicts: list[str]) -> DataFrame:
    """Groups of equal content with how many values each of ``conflicts`` has among them."""
    out = df.groupBy(digest).agg(F.count("*").alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key"), *[F.count_distinct(c).alias(f"{c}_values") for c in conflicts])
    return out.where("n > 1")


def near_groups(df: DataFrame, normal: str, raw: str, split: str) -> DataFrame:
    """Groups equal after normalisation but not before, and whether they cross splits."""
    out = df.groupBy(normal).agg(F.count("*").alias("n"), F.count_distinct(raw).alias("texts"), (F.count_distinct(split) > 1).alias("cross_split"))
    return out.where("texts > 1")


def drift(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Differences of two tables as (key, column, old, new), rows on one side only included."""
    a = old.select(key, F.lit(True).alias("__a"), *[F.col(c).cast("string").alias(f"o_{c}") for c in columns])
    b = new.select(key, F.lit(True).alias("__b"), *[F.col(c).cast("string").alias(f"n_{c}") for c in columns])
    both = a.join(b, key, "full")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"o_{c}").alias("old"), F.col(f"n_{c}").alias("new")) for c in columns])).alias("x")
    found = both.select(key, "__a", "__b", cells)
    return found.where(~F.col("x.old").eqNullSafe(F.col("x.new")) | F.col("__a").isNull() | F.col("__b").isNull()).select(key, "x.column", "x.old", "x.new")
