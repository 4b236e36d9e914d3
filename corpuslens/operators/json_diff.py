"""Leaves of nested JSON of any depth, and their differences, by built-in expressions.

``leaves`` parses a text to a variant once. Each round opens the containers that are left by
one level and writes them, so a round's plan has one parse at most and the rounds are as many
as the deepest value has levels. ``changes`` takes two texts of one row and compares them
there, without a shuffle; only rows that are too deep for that go through ``leaves``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.sources.tables import written

#: Keys of run times, whose values differ from run to run, and keys whose text is kept as it is.
TIME_ENDS, TIME_NAMES = "_(utc|at|ts)$", ("timestamp",)
DURATION_NAMES = ("duration", "elapsed", "duration_seconds", "elapsed_seconds")
VERBATIM = ("full_document_text", "existing_gt_fields", "quote")
#: Levels that ``changes`` opens within a row.
LEVELS = 6
TEMPORARY = r"(/tmp|/var/folders|/private/var)/[A-Za-z0-9_./+\-]+"


def leaves(df: DataFrame, key: str, text: Column) -> DataFrame:
    """``(key, path, leaf)``: a row for each scalar, empty object or empty list of ``text``, as JSON.

    Paths are like ``a.b[0].c``; a scalar alone has the path ''. A null text has no leaves,
    and neither has one that isn't JSON.
    """
    spark = df.sparkSession
    left = df.select(key, F.lit("").alias("path"), F.try_parse_json(text).alias("v")).where("v is not null")
    done = None
    while True:
        left = written(left.withColumn("leaf", F.to_json("v")).withColumn("open", F.col("leaf").rlike(r"^[{\[].") & ~F.col("leaf").isin("{}", "[]")))
        part = left.where("not open").select(key, "path", "leaf")
        done = part if done is None else done.unionByName(part)
        more = left.where("open").select(F.col(key), F.col("path").alias("above"), "v")
        if more.isEmpty():
            return done
        name = F.when(F.col("key").isNull(), F.concat("above", F.lit("["), F.col("pos").cast("string"), F.lit("]"))).when(F.col("above") == "", F.col("key")).otherwise(F.concat_ws(".", "above", "key"))
        inner = more.withColumnRenamed(key, "__id").lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        left = inner.select(F.col("__id").alias(key), name.alias("path"), F.col("value").alias("v"))


def steady_leaf(path: Column, leaf: Column) -> Column:
    """``leaf`` with what differs from run to run replaced: times, durations, temporary paths."""
    last = F.regexp_extract(path, r"([^.\[\]]*)(\[\d+\])*$", 1)
    kept = F.exists(F.split(path, r"[.\[]"), lambda k: k.isin(*VERBATIM))
    scalar = leaf.rlike(r'^["\-0-9]')
    out = F.when(kept, leaf).when(scalar & last.isin(*DURATION_NAMES), '"<duration>"')
    out = out.when(scalar & (last.rlike(TIME_ENDS) | last.isin(*TIME_NAMES)), '"<timestamp>"')
    return out.when(leaf.startswith('"'), F.regexp_replace(leaf, TEMPORARY, "<tmp>")).otherwise(leaf)


def steady(rows: DataFrame) -> DataFrame:
    """``leaves`` with their ``steady_leaf``."""
    return rows.withColumn("leaf", steady_leaf(F.col("path"), F.col("leaf")))


def differences(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``(key, path, old, new)`` where two tables of leaves differ; a leaf that isn't there is null."""
    a, b = old.withColumnRenamed("leaf", "old"), new.withColumnRenamed("leaf", "new")
    return a.join(b, [key, "path"], "full").where("not (old <=> new)")


def _opened(entries: Column) -> Column:
    """Entries ``(path, v, leaf)`` one level further: containers make way for what they hold, others get their leaf once."""
    entry = lambda path, v, leaf=F.lit(None).cast("string"): F.struct(path.alias("path"), v.alias("v"), leaf.alias("leaf"))
    inner = lambda e, k: F.when(e["path"] == "", k).otherwise(F.concat(e["path"], F.lit("."), k))
    fields = lambda e: F.transform(F.map_entries(F.try_variant_get(e["v"], "$", "map<string,variant>")), lambda x: entry(inner(e, x["key"]), x["value"]))
    items = lambda e: F.transform(F.try_variant_get(e["v"], "$", "array<variant>"), lambda x, i: entry(F.concat(e["path"], F.lit("["), i.cast("string"), F.lit("]")), x))
    some = lambda made, other: F.element_at(F.transform(F.array(made), lambda x: F.when(F.size(x) > 0, x).otherwise(other)), 1)
    return F.flatten(F.transform(entries, lambda e: F.when(e["leaf"].isNotNull(), F.array(e)).otherwise(some(F.coalesce(fields(e), items(e)), F.array(entry(e["path"], e["v"], F.to_json(e["v"])))))))


def changes(df: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """``differences`` of the steady leaves of two texts in one row: ``(key, path, old, new)``.

    A row's leaves are arrays. Those that both sides have are left out by a hash set, the
    others are sorted by path and meet by place, so a row costs n log n of its leaves. Rows
    deeper than ``LEVELS``, or with a path more than once (keys with dots or brackets), take
    ``leaves`` and a join; rows are written in between, so each text is parsed once.
    """
    rows = df.select(F.col(key).alias("__key"), F.col(old).alias("__old"), F.col(new).alias("__new"))
    for name in ("old", "new"):
        text = F.col(f"__{name}")
        found = F.filter(F.array(F.struct(F.lit("").alias("path"), F.try_parse_json(text).alias("v"), F.lit(None).cast("string").alias("leaf"))), lambda e: e["v"].isNotNull())
        for _ in range(LEVELS + 1):
            found = _opened(found)
        rows = rows.withColumn(name, F.transform(found, lambda e: F.struct(e["path"].alias("path"), e["leaf"].alias("leaf"))))
    # a path with its length before it, then the leaf: one text for both, which array_except hashes
    one = lambda c: F.transform(c, lambda e: F.concat(F.length(e["path"]).cast("string"), F.lit(":"), e["path"], F.coalesce(e["leaf"], F.lit(""))))
    rows = rows.withColumn("a", one(F.col("old"))).withColumn("b", one(F.col("new")))
    size = lambda s: F.substring_index(s, ":", 1)
    path = lambda s: F.substr(s, F.length(size(s)) + 2, size(s).cast("int"))
    leaf = lambda s: F.substr(s, F.length(size(s)) + 2 + size(s).cast("int"))
    split = lambda c: F.transform(c, lambda s: F.struct(path(s).alias("path"), leaf(s).alias("leaf")))
    twice = lambda name: F.size(F.array_distinct(F.col(f"{name}.path"))) < F.size(name)
    deep = lambda name: F.exists(name, lambda e: e["leaf"].isNull())
    odd = twice("old") | twice("new") | deep("old") | deep("new")
    rows = rows.select("__key", "__old", "__new", odd.alias("odd"), split(F.array_except("a", "b")).alias("a"), split(F.array_except("b", "a")).alias("b"))
    full = lambda own, other: F.sort_array(F.concat(own, F.transform(F.array_except(other["path"], own["path"]), lambda p: F.struct(p.alias("path"), F.lit(None).cast("string").alias("leaf")))))
    pairs = F.zip_with(full(F.col("a"), F.col("b")), full(F.col("b"), F.col("a")), lambda x, y: F.struct(x["path"].alias("path"), steady_leaf(x["path"], x["leaf"]).alias("old"), steady_leaf(y["path"], y["leaf"]).alias("new")))
    pairs = F.filter(pairs, lambda x: ~x["old"].eqNullSafe(x["new"]))
    side = lambda c: F.when(F.col("odd"), F.col(c)).alias(c)
    rows = rows.select("__key", side("__old"), side("__new"), "odd", F.when(~F.col("odd"), pairs).alias("pairs"))
    made = written(rows)  # without a filter, which would be pushed down with all that it is made of
    out = made.where("not odd").select("__key", F.explode("pairs").alias("x")).select(F.col("__key").alias(key), "x.*")
    rest = made.where("odd")
    if rest.isEmpty():
        return out
    rest = written(rest.select("__key", "__old", "__new").withColumn("__row", F.monotonically_increasing_id()))
    both = differences(*[steady(leaves(rest, "__row", F.col(c))) for c in ("__old", "__new")], "__row")
    return out.unionByName(both.join(rest.select("__row", F.col("__key").alias(key)), "__row").select(key, "path", "old", "new"))
