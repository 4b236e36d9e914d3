"""Composition statistics. Every group is aggregated with map-side partials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def percentiles(df: DataFrame, value: str, by: list[str], levels: dict[str, float]) -> DataFrame:
    """Exact linear percentiles by group, a column for each of ``levels``; nulls are left out.

    Values are counted (with map-side partials) and put in bins by their logarithm, about
    1% wide, which rise with the values. Ranks come from the bins' sums and from windows
    inside a bin, so no task holds a group.
    """
    keys = [*by, "__all"]
    counts = df.where(F.col(value).isNotNull()).withColumn("__all", F.lit(0)).groupBy(*keys, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("c"))
    binned = counts.withColumn("bin", (F.signum("v") * F.floor(64 * F.log2(1 + F.abs("v")))).cast("int"))
    sums = binned.groupBy(*keys, "bin").agg(F.sum("c").alias("b"))
    group = Window.partitionBy(*keys)
    before = sums.select(*keys, "bin", (F.sum("b").over(group.orderBy("bin")) - F.col("b")).alias("before"), F.sum("b").over(group).alias("n"))
    own = F.sum("c").over(Window.partitionBy(*keys, "bin").orderBy("v"))
    ranks = binned.withColumn("upto", own).join(before, [*keys, "bin"]).withColumn("upto", F.col("upto") + F.col("before"))
    at = lambda k: F.max(F.when((F.col("upto") - F.col("c") <= k) & (k < F.col("upto")), F.col("v")))
    place = {name: (F.col("n") - 1) * level for name, level in levels.items()}
    out = ranks.groupBy(*keys).agg(F.max("n").alias("n"), *[at(F.floor(p)).alias(f"{name}__a") for name, p in place.items()], *[at(F.ceil(p)).alias(f"{name}__b") for name, p in place.items()])
    marks = [(F.col(f"{name}__a") + (F.col(f"{name}__b") - F.col(f"{name}__a")) * (p - F.floor(p))).alias(name) for name, p in place.items()]
    return out.select(*by, *marks)


def describe(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Count, mean, deviation and linear percentiles of ``value`` by group."""
    levels = {f"p{round(100 * v)}": v for v in LEVELS}
    out = df.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    return out.join(percentiles(df, value, by, levels), by).select(*by, "n", "mean", "std", "min", *levels, "max")


def strata(df: DataFrame, keys: list[str], test: Column) -> DataFrame:
    """Rows by stratum and split, the stratum's share and its test share, in percent."""
    out = df.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(~test).alias("train"), F.count_if(test).alias("test"))
    every = F.sum("total").over(Window.partitionBy())
    return out.select(*keys, "total", "train", "test", (100 * F.col("total") / every).alias("share_pct"), (100 * F.col("test") / F.col("total")).alias("test_pct"))


def coverage(df: DataFrame, value: str, budgets: list[int], by: list[str]) -> DataFrame:
    """How many values are within each budget: one pass, one row per group and budget."""
    counts = df.groupBy(*by).agg(F.count("*").alias("n"), *[F.count_if(F.col(value) <= b).alias(f"b{b}") for b in budgets])
    pairs = F.explode(F.array(*[F.struct(F.lit(b).alias("budget"), F.col(f"b{b}").alias("within")) for b in budgets])).alias("x")
    return counts.select(*by, "n", pairs).select(*by, F.col("x.budget"), F.col("x.within"), (100 * F.col("x.within") / F.col("n")).alias("pct"), "n")


def fill_rates(df: DataFrame, by: list[str], fields: dict[str, Column]) -> DataFrame:
    """The share of rows with each field, as rows (group, field, n, filled, rate)."""
    sums = df.groupBy(*by).agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"f_{k}") for k, c in fields.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.col(f"f_{k}").alias("filled")) for k in fields])).alias("x")
    return sums.select(*by, "n", pairs).select(*by, F.col("x.field"), "n", F.col("x.filled"), (F.col("x.filled") / F.col("n")).alias("rate"))


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts of pairs and their share of the row, in long form."""
    out = df.groupBy(row, column).agg(F.count("*").alias("n"))
    return out.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(row)))


def ecdf(df: DataFrame, value: str, key: str, by: str) -> DataFrame:
    """Empirical distribution: i/n for the i-th value of a group, ties in order of ``key``.

    Ranks before a value come from the counts of distinct values, and ranks among ties from
    the ties alone, so a group with most rows isn't sorted in one task.
    """
    counts = df.groupBy(by, value).agg(F.count("*").alias("ties"))
    order = Window.partitionBy(by).orderBy(value)
    ranked = counts.select(by, value, (F.sum("ties").over(order) - F.col("ties")).alias("before"), F.sum("ties").over(Window.partitionBy(by)).alias("n"))
    own = F.row_number().over(Window.partitionBy(by, value).orderBy(key))
    return df.withColumn("own", own).join(ranked, [by, value]).select(key, by, value, ((F.col("before") + F.col("own")) / F.col("n")).alias("y"))


def phi(pairs: DataFrame, item: str, key: str, names: list[str]) -> DataFrame:
    """Phi coefficients of the presence of items per key: one pass of conditional sums."""
    has = pairs.groupBy(key).agg(*[F.max((F.col(item) == n).cast("int")).alias(n) for n in names])
    both = [(a, b) for a in names for b in names]
    sums = has.agg(F.count("*").alias("n"), *[F.sum(F.col(a) * F.col(b)).alias(f"{a}|{b}") for a, b in both])
    rows = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("n11"), F.col(f"`{a}|{a}`").alias("n1"), F.col(f"`{b}|{b}`").alias("n2")) for a, b in both])).alias("x")
    out = sums.select("n", rows).select("n", "x.*")
    spread = F.col("n1") * (F.col("n") - F.col("n1")) * F.col("n2") * (F.col("n") - F.col("n2"))
    return out.select("a", "b", F.when(spread == 0, 0.0).otherwise((F.col("n") * F.col("n11") - F.col("n1") * F.col("n2")) / F.sqrt(spread.cast("double"))).alias("phi"))


def entropy_bits(counts: DataFrame, n: str) -> DataFrame:
    total = counts.agg(F.sum(n).alias("total"), F.sum(F.col(n) * F.log2(n)).alias("nlog"), F.max(n).alias("most"), F.min(n).alias("least"), F.count("*").alias("kinds"))
    return total.select((F.log2("total") - F.col("nlog") / F.col("total")).alias("entropy_bits"), (F.col("most") / F.col("least")).alias("imbalance"), "kinds")
