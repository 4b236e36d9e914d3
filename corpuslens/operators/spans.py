"""Labelled spans held against their texts, by category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.operators.relabel import compact


def _blank(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def span_verdicts(spans: DataFrame, docs: DataFrame, categories: DataFrame, most: int) -> DataFrame:
    """``(doc_id, name, start, text, copies, verdict)``, one row for each distinct span.

    ``spans`` has doc_id, name, start (characters from 0), text; ``docs`` doc_id, text;
    ``categories`` name, probe (a pattern that the span has to meet, or null) and latest (the
    last start that is allowed, or null). The verdict is the first of these that holds:
    ``unknown_category``, ``malformed`` (null, or under two characters), ``no_document``,
    ``outside``, ``not_verbatim``, ``too_long`` (over ``most``), ``heading_only`` (the category's
    own name), ``failed_probe``, ``too_late``; else ``ok``. A null text of a document counts as empty.

    Repeated spans are counted in the tasks before any shuffle, so a span of very many copies
    is one row; texts meet the distinct spans once, and hot documents are split by the planner.
    """
    one = spans.groupBy("doc_id", "name", "start", "text").agg(F.count("*").alias("copies"))
    rules = categories.select(F.col("name").alias("own"), "probe", "latest")
    bodies = docs.select(F.col("doc_id").alias("of"), F.coalesce("text", F.lit("")).alias("body"))
    joined = one.join(rules, F.col("name") == F.col("own"), "left").join(bodies, F.col("doc_id") == F.col("of"), "left")
    size, start = F.length("text"), F.col("start")
    verdict = (
        F.when(F.col("own").isNull(), "unknown_category")
        .when(F.col("text").isNull() | start.isNull() | (F.length(_blank(F.col("text"))) < 2), "malformed")
        .when(F.col("of").isNull(), "no_document")
        .when((start < 0) | (start + size > F.length("body")), "outside")
        .when(F.substring("body", (start + 1).cast("int"), size) != F.col("text"), "not_verbatim")
        .when(size > most, "too_long")
        .when(compact(F.col("text")) == compact(F.col("name")), "heading_only")
        .when(F.col("probe").isNotNull() & ~F.regexp_like("text", F.concat(F.lit("(?is)"), "probe")), "failed_probe")
        .when(F.col("latest").isNotNull() & (start > F.col("latest")), "too_late")
        .otherwise("ok")
    )
    return joined.select("doc_id", "name", "start", "text", "copies", verdict.alias("verdict"))


def span_problems(verdicts: DataFrame, docs: DataFrame, floor: int, one_of: list[str]) -> DataFrame:
    """``(doc_id, present, problem)`` of documents whose spans don't suffice; ``docs`` has doc_id.

    ``unknown_categories`` if a span has one, ``few_categories`` if fewer than ``floor`` have
    a span that is ok, ``none_of_required`` if none of ``one_of`` has. A document without
    spans has none present. Spans are first reduced to one row a document and category.
    """
    good = F.col("verdict") == "ok"
    each = verdicts.groupBy("doc_id", "name").agg(F.bool_or(good).alias("ok"), F.bool_or(F.col("verdict") == "unknown_category").alias("odd"))
    sums = each.groupBy("doc_id").agg(F.count_if("ok").alias("n"), F.bool_or("odd").alias("odd"), F.bool_or(F.col("ok") & F.coalesce(F.col("name").isin(one_of), F.lit(False))).alias("core"))
    every = docs.select("doc_id").distinct().join(sums, "doc_id", "left")
    present, no = F.coalesce("n", F.lit(0)), F.lit(False)
    found = F.array_compact(F.array(F.when(F.coalesce("odd", no), "unknown_categories"), F.when(present < floor, "few_categories"), F.when(~F.coalesce("core", no), "none_of_required")))
    return every.select("doc_id", present.cast("long").alias("present"), F.explode(found).alias("problem"))
