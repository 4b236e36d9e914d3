"""Audit of how filters interact: what each removes in every order, and its fair share.

Every row fails a subset of the filters, its mask. Rows are counted by part and mask; from
then on only these counts matter. A part's removal polynomial has one variable a filter,
the probability with which that filter is on:

    f(x) = sum over masks m of count(m) * (1 - product over i in m of (1 - x_i))

It is multilinear. Its coefficient at a set T of filters is the count of rows that fail all
of T, with alternating sign. At the corner where the filters of S are on, f is the number of
rows that they remove, so survivors of any prefix of any order are read off the corners. A
filter's Shapley value is the integral of its partial derivative along the diagonal, where
x_i = t for all i: a sum of coefficients over set sizes. These rationals have the common
denominator lcm(1..n), so they are added as integers and the value times n! is exact.

Only built-in expressions are used. The text is read once; rows then carry a mask and a
digest. Counting by part and mask has map-side partials, so a part with a third of all rows
isn't gathered anywhere; each part is one row of at most 2^n counts afterwards. Both sides
of each join are written tables, so adaptive execution can split a hot digest or doc_id.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial, lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.store import Workspace

#: Names of the query's filters, in the order of the mask's bits.
NAMES = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
#: A mask has a bit a filter; the orders of more filters than this are too many to list.
MOST_FILTERS = 6


def text_filters(text: Column) -> dict[str, Column]:
    """The filters on a text alone, as conditions of failure: few words, few distinct words, capitals, symbols."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < LEAST_WORDS,
        "B": 100 * distinct < LEAST_DISTINCT * n,
        "C": 100 * capitals > MOST_CAPITALS * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def mask_counts(rows: DataFrame, marks: list[str]) -> DataFrame:
    """``(part, mask, rows, *marks)`` of ``rows(part, mask, *marks)``: how many rows, and how many with each mark."""
    return rows.groupBy("part", "mask").agg(F.count("*").alias("rows"), *[F.count_if(F.col(m)).alias(m) for m in marks])


def interactions(counts: DataFrame, names: str, marks: list[str]) -> DataFrame:
    """One row for each part, order of the filters and step, from ``mask_counts``.

    Columns: part, filter_order, step (from 1), kept, removed, redundant, unique_fails,
    shapley, and for each mark how many of the removed rows have it. Filters are letters of
    ``names``, bit k of a mask is ``names[k]``. shapley is the filter's removed rows summed
    over all orders. A part without failures has zeros; no counts give no rows.
    """
    n = len(names)
    if not 0 < n <= MOST_FILTERS or len(set(names)) < n:
        raise ValueError(f"1 to {MOST_FILTERS} filters of different names are asked for")
    every, whole, below = (1 << n) - 1, factorial(n), lcm(*range(1, n + 1))
    measures = ["rows", *marks]
    # coefficients: a mask adds its count to each of its nonempty subsets, with alternating sign
    subset = F.explode(F.expr(f"filter(sequence(1, {every}), t -> (t & mask) = t)"))
    signed = counts.where("mask > 0").withColumn("t", subset).withColumn("sign", F.when(F.bit_count("t") % 2 == 1, 1).otherwise(-1))
    terms = signed.groupBy("part", "t").agg(*[F.sum(F.col(m) * F.col("sign")).alias(m) for m in measures])
    terms = terms.groupBy("part").agg(F.collect_list(F.struct("t", *measures)).alias("terms"))
    alone = [F.coalesce(F.sum(F.when(F.col("mask") == 1 << k, F.col("rows"))), F.lit(0)).alias(f"alone{k}") for k in range(n)]
    parts = counts.groupBy("part").agg(F.sum("rows").alias("total"), *alone).join(terms, "part", "left")

    def corner(measure: str) -> Column:
        """What each set of filters removes: the polynomial at all its corners."""
        return F.expr(f"transform(sequence(0, {every}), s -> aggregate(coalesce(terms, array()), 0L, (acc, x) -> acc + if((x.t & ~s) = 0, x.{measure}, 0L)))")

    def integral(k: int) -> Column:
        """n! times the integral of the partial derivative by filter ``k`` along the diagonal."""
        over = f"aggregate(coalesce(terms, array()), 0L, (acc, x) -> acc + if((x.t & {1 << k}) > 0, x.rows * ({below} div bit_count(x.t)), 0L))"
        return F.expr(f"{over} * {whole // below}L")

    parts = parts.select(
        "part",
        "total",
        F.array(*[F.col(f"alone{k}") for k in range(n)]).alias("alone"),
        F.array(*[integral(k) for k in range(n)]).alias("shares"),
        *[corner(m).alias(f"at_{m}") for m in measures],
    )
    # all orders and steps: filter, and the sets that are on before and after it
    orders = ["".join(names[k] for k in p) for p in permutations(range(n))]
    bits = [k for p in permutations(range(n)) for k in p]
    befores = [sum(1 << k for k in p[:s]) for p in permutations(range(n)) for s in range(n)]
    at = F.col("at")
    steps = parts.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(whole * n - 1))))
    steps = steps.withColumn("k", F.get(F.lit(bits), at)).withColumn("before", F.get(F.lit(befores), at))
    steps = steps.withColumn("own", F.expr("shiftleft(1, k)")).withColumn("after", F.expr("before | own"))
    gone = lambda m: F.get(f"at_{m}", F.col("after")) - F.get(f"at_{m}", F.col("before"))
    return steps.select(
        "part",
        F.get(F.lit(orders), F.floor(at / n).cast("int")).alias("filter_order"),
        (at % n + 1).cast("int").alias("step"),
        (F.col("total") - F.get("at_rows", F.col("after"))).alias("kept"),
        gone("rows").alias("removed"),
        (F.get("at_rows", F.col("own")) - gone("rows")).alias("redundant"),
        F.get("alone", F.col("k")).alias("unique_fails"),
        *[gone(m).alias(m) for m in marks],
        F.get("shares", F.col("k")).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters on ``docs(doc_id, text, source)`` by source, with ``labels(doc_id, quality, toxic)``.

    A null text is empty; a null source is the part ''. E: the text is that of a row with a
    smaller doc_id; a null doc_id is larger than any other, and rows that share a doc_id
    are no copies by that. A doc_id with several labels is good (or toxic) if one of them
    says so; a null label says nothing, and a null doc_id has no label. Empty texts fail A.
    Texts may be of any length. An empty table gives no rows; other columns are not read.
    """
    work = Workspace(docs.sparkSession, "filter-audit")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = text_filters(F.col("text"))
    mask = sum((F.when(c, 1 << NAMES.index(name)).otherwise(0) for name, c in own.items()), F.lit(0))
    rows = work.write(rows.select("doc_id", "part", mask.alias("own"), F.unhex(F.sha2("text", 256)).alias("digest")), "rows")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    firsts = work.write(firsts, "firsts")
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marked = work.write(marked.where("doc_id is not null"), "labels")
    copy = F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first")))
    judged = rows.join(firsts, "digest", "left").join(marked, "doc_id", "left")
    judged = judged.select("part", (F.col("own") + F.when(copy, 1 << NAMES.index("E")).otherwise(0)).alias("mask"), F.coalesce("good", F.lit(False)).alias("good_lost"), F.coalesce("toxic", F.lit(False)).alias("toxic_lost"))
    counts = work.write(mask_counts(judged, ["good_lost", "toxic_lost"]), "counts")
    return interactions(counts, NAMES, ["good_lost", "toxic_lost"])


#: ``audit_filters`` for DuckDB: every order by its own definition, without polynomials.
ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), first AS (
  SELECT t, min(doc_id) AS first_id FROM w GROUP BY t
), f AS (
  SELECT w.doc_id, part, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * length(regexp_replace(w.t, '[^A-Z]+', '', 'g')) > 2 * length(w.t))::INT
    + 8 * regexp_matches(w.t, '[#$%&*|]')::INT + 16 * (w.doc_id > first_id)::INT AS m
  FROM w JOIN first USING (t)
), c AS (
  SELECT part, m, count(*) AS n, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) AS good,
    count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS toxic FROM f GROUP BY ALL
), l(c, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)), o AS (
  SELECT a.c || b.c || d.c || e.c || g.c AS filter_order, [a.b, b.b, d.b, e.b, g.b] AS bits
  FROM l a, l b, l d, l e, l g WHERE a.b + b.b + d.b + e.b + g.b = 31 AND len(list_distinct([a.b, b.b, d.b, e.b, g.b])) = 5
), s AS (
  SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, (SELECT unnest(range(1, 6))::INT AS step)
), r AS (
  SELECT part, filter_order, step, own,
    sum(n) FILTER (WHERE m & (own | before) = 0) AS kept, sum(n) FILTER (WHERE m & own > 0 AND m & before = 0) AS removed,
    sum(n) FILTER (WHERE m & own > 0 AND m & before > 0) AS redundant, sum(n) FILTER (WHERE m = own) AS unique_fails,
    sum(good) FILTER (WHERE m & own > 0 AND m & before = 0) AS good_lost, sum(toxic) FILTER (WHERE m & own > 0 AND m & before = 0) AS toxic_lost
  FROM c, s GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM r
"""
