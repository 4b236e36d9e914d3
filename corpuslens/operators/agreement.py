"""Agreement and scoring of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rate(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def prf1(df: DataFrame, by: list[str], gold: Column, pred: Column) -> DataFrame:
    """Confusion counts with precision, recall and F1; a missing prediction counts as none."""
    pred = F.coalesce(pred, F.lit(False))
    counts = df.groupBy(*by).agg(F.count_if(gold & pred).alias("tp"), F.count_if(~gold & pred).alias("fp"), F.count_if(gold & ~pred).alias("fn"), F.count_if(~gold & ~pred).alias("tn"))
    p, r = _rate(F.col("tp"), F.col("tp") + F.col("fp")), _rate(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.select(*by, "tp", "fp", "fn", "tn", p.alias("precision"), r.alias("recall"), _rate(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa of two raters: 0 for no rows, 1 if chance agreement is certain."""
    cells = df.groupBy(a, b).agg(F.count("*").alias("n"))
    left = cells.groupBy(F.col(a).alias("v")).agg(F.sum("n").alias("na"))
    right = cells.groupBy(F.col(b).alias("v")).agg(F.sum("n").alias("nb"))
    chance = left.join(right, "v").agg(F.sum(F.col("na") * F.col("nb")).alias("ab"))
    total = cells.agg(F.sum("n").alias("n"), F.sum(F.when(F.col(a) == F.col(b), F.col("n")).otherwise(0)).alias("same"))
    both = total.join(chance, F.lit(True))
    po, pe = F.col("same") / F.col("n"), F.coalesce(F.col("ab") / (F.col("n") * F.col("n")), F.lit(0.0))
    out = F.when(F.coalesce("n", F.lit(0)) == 0, 0.0).when(pe == 1, 1.0).otherwise((po - pe) / (1 - pe))
    return both.select(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce(po, F.lit(0.0)).alias("accuracy"), out.alias("kappa"))


def decide(first: Column, second: Column) -> Column:
    """The two-rater decision: agreed values are accepted, one-sided ones adjudicated."""
    return F.when(first.isNull() & second.isNull(), "unlabeled").when(first.isNull() | second.isNull(), "adjudicate").when(first != second, "adjudicate").when(first == 0, "absent").otherwise("accept")
