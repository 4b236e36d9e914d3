"""References between rows, and evidence of values in texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: longer strings have no evidence span.
MOST_EVIDENCE = 240


def dangling(rows: DataFrame, key: str, references: list[str], removed: DataFrame | None = None) -> DataFrame:
    """``(key, column, reference, reason)`` of each reference of ``rows`` to no row of it.

    ``references`` are columns of one id or of a list of them; repeated and null ones count
    once and not at all. The reason is ``removed`` where ``removed(key)`` has the id, else
    ``missing``. The ids that are there are reduced to one each before the joins, so a row
    that many others refer to is met by an anti join only.
    """

    def told(c: str) -> Column:
        kind = rows.schema[c].dataType
        many = F.coalesce(F.col(c), F.array().cast(kind)) if kind.typeName() == "array" else F.array(c)
        return F.transform(F.array_distinct(F.array_compact(many)), lambda x: F.struct(F.lit(c).alias("column"), x.alias("reference")))

    every = rows.select(key, F.explode(F.concat(*map(told, references))).alias("r")).select(key, "r.column", "r.reference")
    lost = every.join(rows.select(F.col(key).alias("reference")).distinct(), "reference", "left_anti")
    if removed is None:
        return lost.select(key, "column", "reference", F.lit("missing").alias("reason"))
    gone = removed.select(F.col(key).alias("reference")).distinct().withColumn("gone", F.lit(True))
    return lost.join(gone, "reference", "left").select(key, "column", "reference", F.when(F.col("gone"), "removed").otherwise("missing").alias("reason"))


def evidence(text: Column, values: Column, kind: Column) -> Column:
    """The first place of each of ``values`` in ``text`` as (start, end, quote), all or none.

    An empty list if a value is null, blank, longer than ``MOST_EVIDENCE`` or not there, or
    if the kind is money. Ends are exclusive, places count characters from 0.
    """
    fits = lambda v: F.coalesce((F.trim(v) != "") & (F.length(v) <= MOST_EVIDENCE) & F.contains(text, v), F.lit(False))
    whole = F.coalesce((kind != "money") & F.forall(values, fits), F.lit(False))
    spans = F.transform(values, lambda v: F.struct((F.instr(text, v) - 1).alias("start"), (F.instr(text, v) - 1 + F.length(v)).alias("stop"), v.alias("quote")))
    return F.when(whole, spans).otherwise(F.array().cast("array<struct<start:int,stop:int,quote:string>>"))
