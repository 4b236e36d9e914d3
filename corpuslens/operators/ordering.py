"""Order-dependent operators as windows; every order is total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.sources.tables import checkpoint_folder


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first in ``order`` (the limit applies before the shuffle too)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def fold_journal(df: DataFrame, keys: list[str], accepted: str, count: str, ordinal: str) -> DataFrame:
    """An accepted record sticks and the last one wins; else the largest, the earliest of ties."""
    late = F.when(F.col(accepted), F.col(ordinal))
    return first_by(df, keys, [F.desc(accepted), F.desc_nulls_last(late), F.desc(count), F.asc(ordinal)])


def draw(df: DataFrame, stratum: list[str], key: str, quota: int, seed: str = "") -> DataFrame:
    """The first ``quota`` rows of each stratum by a hash of the key."""
    rank = F.row_number().over(Window.partitionBy(*stratum).orderBy(F.sha2(F.concat(F.lit(seed), F.col(key).cast("string")), 256), key))
    return df.withColumn("draw_rank", rank).where(F.col("draw_rank") <= quota)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with each row's place (from 0) in the global order, without gathering it.

    Rows are sorted by range; the rows before each range are added up from one row a range.
    """
    checkpoint_folder(df.sparkSession)
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("__id", 33).alias("__part")
    sizes = rows.groupBy(part).agg(F.count("*").alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    placed = rows.withColumn("__part", part).join(F.broadcast(before), "__part")  # one row a partition
    return placed.withColumn(name, F.col("__before") + F.col("__id").bitwiseAND((1 << 33) - 1)).drop("__id", "__part", "__before")


def ranked(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Places (from 0) within each group, so that no task sorts a whole group: global places less the group's first."""
    rows = numbered(df, [*by, *order], name)
    first = rows.groupBy(*by).agg(F.min(name).alias("__first"), F.count("*").alias("__size"))
    return rows.join(first, by).withColumn(name, F.col(name) - F.col("__first")).drop("__first")


def chunks(df: DataFrame, by: list[str], key: str, size: int) -> DataFrame:
    """Fixed-size chunks of each group in order of the key."""
    return ranked(df, by, [key], "__at").withColumn("chunk", F.floor(F.col("__at") / size).cast("int")).drop("__at", "__size")


def parts(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` slices of the rows in order of the key, each of the size rounded up."""
    size = -(-df.count() // n)
    return numbered(df, [key], "__at").withColumn("slice", F.floor(F.col("__at") / max(size, 1))).drop("__at")


def interleave(df: DataFrame, group: str, key: str, every: int) -> DataFrame:
    """Groups taken in turn; after each ``every`` positions one is left free for a distractor."""
    turned = ranked(df, [group], [key], "__turn").withColumn("turn", (F.col("__turn") + 1).cast("int")).drop("__turn", "__size")
    at = numbered(turned, ["turn", group], "__at")
    return at.withColumn("position", F.col("__at") + 1 + F.floor(F.col("__at") / every)).drop("__at")


def largest_remainder(df: DataFrame, name: str, weight: str, total: int) -> DataFrame:
    """Seats by largest remainder over one row per stratum, with at least one seat each.

    Strata without weight have none. With fewer seats than strata, the heaviest ones have
    one each. Where the seats that everyone has overshoot the total, they are taken back one
    by one from strata with more than one, the smallest shares first, in as many rounds as
    it takes. Ties go by name. Strata are placed by range, so no task holds them all.
    """
    some = df.where(F.col(weight) > 0).select(name, weight)
    row = some.agg(F.count("*").alias("n"), F.sum(weight).alias("w")).first()
    if not row["n"]:
        return df.select(name, weight, F.lit(0).alias("seats"))
    if total < row["n"]:
        ranked = numbered(some.withColumn("__less", -F.col(weight)), ["__less", name], "__at")
        seats = ranked.select(name, F.when(F.col("__at") < total, 1).otherwise(0).alias("seats"))
    else:
        exact = F.lit(total) * F.col(weight) / F.lit(row["w"])
        parts = some.withColumn("__exact", exact).withColumn("__base", F.greatest(F.lit(1), F.floor("__exact").cast("int")))
        left = total - parts.agg(F.sum("__base")).first()[0]
        if left >= 0:
            ranked = numbered(parts.withColumn("__less", F.round(F.col("__base") - F.col("__exact"), 9)), ["__less", name], "__at")
            seats = ranked.select(name, (F.col("__base") + F.when(F.col("__at") < left, 1).otherwise(0)).alias("seats"))
        else:
            spare = parts.where("__base > 1").withColumn("__round", F.explode(F.expr("sequence(1, __base - 1)")))
            taken = numbered(spare, ["__round", "__exact", name], "__at").where(F.col("__at") < -left).groupBy(name).agg(F.count("*").cast("int").alias("__taken"))
            seats = parts.join(taken, name, "left").select(name, (F.col("__base") - F.coalesce("__taken", F.lit(0))).alias("seats"))
    return df.join(seats, name, "left").select(name, weight, F.coalesce("seats", F.lit(0)).cast("int").alias("seats"))
