"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is the target's share of the total over what the source has.
Each document is replicated a Poisson number of times with that mean: the distribution is
inverted at a number in [0, 1) hashed from the seed and the doc_id, so the same document
gets the same count in every run, wherever it is computed. The copies are then put in a
global random order by a hash of the seed, the doc_id and the copy's number.

Only built-in expressions are used. Rates are one row a source, written as a table, so the
planner knows its size when it picks the join; a source with a third of all rows is
aggregated map-side, and the join and the shuffle by hash don't gather it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.store import Workspace

SEED = "mix-1"
#: A rate above this is drawn as a sum of Poisson numbers, so that exp(-rate) stays exact.
PART_RATE = 16.0
#: Copies of a row that one step writes out.
CHUNK = 1024


def rates(docs: DataFrame, work: Workspace, weights: dict[str, float] | None = None, epochs: float = 1.0) -> DataFrame:
    """``(source, rate)``: ``epochs`` times all characters, dealt by weight, over what there is.

    Without ``weights`` every source has the same one, and a null source is a source. With
    them, a source that they don't name has none. A source without characters has rate 0.
    """
    size = F.coalesce(F.length(F.col("text")), F.lit(0)).cast("long")
    own = docs.groupBy("source").agg(F.sum(size).alias("chars"))
    if weights is None:
        own = own.withColumn("weight", F.lit(1.0))
    else:
        named = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "source string, weight double")
        own = own.join(named, "source", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    own = own.withColumn("weight", F.when(F.col("chars") > 0, F.col("weight")).otherwise(0.0))
    own = work.write(own, "sources")
    total = own.agg(F.sum("chars").cast("double").alias("chars"), F.sum("weight").alias("weight")).first()
    share = F.lit(float(epochs)) * F.lit(total["chars"] or 0.0) * F.col("weight") / F.lit(total["weight"] or 1.0) / F.col("chars")
    return own.select("source", F.when(F.col("weight") > 0, share).otherwise(0.0).alias("rate"))


def _copies(seed: str, own: str) -> str:
    """Poisson numbers of mean ``{own}rate`` as SQL, ``own`` being the prefix of helper columns; the probabilities are summed until they pass u."""
    unit = f"cast(conv(substr(md5(concat('{seed}:count:', {own}key, ':', j)), 1, 13), 16, 10) as bigint) / 4503599627370496D"
    drawn = (
        "aggregate(sequence(1, cast(ceil(lam + 12 * sqrt(lam)) as int) + 24), "
        "named_struct('p', exp(-lam), 'c', exp(-lam), 'n', 0), "
        "(s, k) -> named_struct('p', s.p * lam / k, 'c', s.c + s.p * lam / k, 'n', s.n + if(s.c <= u, 1, 0)), s -> cast(s.n as bigint))"
    )
    one = f"transform(array({unit}), u -> {drawn})[0]"
    parts = f"greatest(1L, cast(ceil({own}rate / {PART_RATE}D) as bigint))"
    return f"if({own}rate <= 0, 0L, aggregate(sequence(1L, {parts}), 0L, (acc, j) -> acc + transform(array({own}rate / {parts}), lam -> {one})[0]))"


def _prefix(columns: list[str]) -> str:
    """A prefix that no column has, for helper columns."""
    out = "__mix_"
    while any(c.lower().startswith(out) for c in columns):
        out += "_"
    return out


def replicated(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, seed: str = SEED) -> tuple[DataFrame, str]:
    """``docs`` with each row as often as it is drawn, in no order, and the prefix of three columns more.

    These are ``copy``, from 1 on, ``key``, the doc_id as text, and ``place``, where the copy
    goes. The prefix is one that no column of ``docs`` has. Where a rate is high (a source with little
    text and a large weight), rows drawn more than ``CHUNK`` times are first made into
    chunks of so many copies, which are spread over all tasks before they are written out
    one by one.
    """
    work, p = Workspace(docs.sparkSession, "mixing"), _prefix(docs.columns)
    rate = work.write(rates(docs, work, weights, epochs), "rates").select(F.col("source").alias(f"{p}source"), F.col("rate").alias(f"{p}rate"))
    key = F.coalesce(docs["doc_id"].cast("string"), F.lit("null"))
    drawn = docs.join(rate, docs["source"].eqNullSafe(F.col(f"{p}source"))).withColumn(f"{p}key", key).withColumn(f"{p}count", F.expr(_copies(seed, p)))
    copies = lambda rows, first: rows.withColumn(f"{p}copy", F.explode(F.expr(f"sequence({first} + 1, least({p}count, {first} + {CHUNK}))")))
    highest = rate.agg(F.max(f"{p}rate")).first()[0] or 0.0
    if highest < CHUNK / 4:  # then no more than CHUNK copies but for a chance below 1e-300
        out = drawn.where(f"{p}count > 0").withColumn(f"{p}copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{p}count"))))
    else:
        some = copies(drawn.where(f"{p}count between 1 and {CHUNK}"), "0L")
        chunks = drawn.where(f"{p}count > {CHUNK}").withColumn(f"{p}first", F.explode(F.expr(f"sequence(0L, {p}count - 1, {CHUNK}L)")))
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        many = copies(chunks.repartition(parts, f"{p}key", f"{p}first"), f"{p}first").drop(f"{p}first")
        out = some.unionByName(many)
    place = F.expr(f"cast(conv(substr(md5(concat('{seed}:place:', {p}key, ':', {p}copy)), 1, 15), 16, 10) as bigint)")
    return out.drop(f"{p}source", f"{p}rate", f"{p}count").withColumn(f"{p}place", place), p


def mix(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, seed: str = SEED) -> DataFrame:
    """The mixture of ``docs(doc_id, text, source, ...)`` as a globally shuffled table.

    The columns are doc_id, source, copy (from 1 on), shuffle_key (rows are in its order)
    and text. A null source is a source of its own; a null doc_id is drawn like a doc_id
    ``null``, and rows that share a doc_id are drawn alike. Texts without characters weigh
    nothing but are drawn at their source's rate. A source with little text is repeated
    until it has its share: one document of one letter beside 6 MB of another source is
    drawn some three million times, each copy a row. An empty table gives no rows; columns of
    other names are dropped, whatever they are.
    """
    own = docs.select("doc_id", "text", F.col("source").cast("string").alias("source"))
    out, p = replicated(own, weights, epochs, seed)
    return out.select("doc_id", "source", F.col(f"{p}copy").alias("copy"), F.col(f"{p}place").alias("shuffle_key"), "text").orderBy("shuffle_key", "doc_id", "copy")


def mix_documents(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, seed: str = SEED) -> DataFrame:
    """The mixture with the columns of ``docs``, whatever their names: what a training job reads in file order."""
    out, p = replicated(docs, weights, epochs, seed)
    return out.orderBy(f"{p}place", f"{p}key", f"{p}copy").select(*docs.columns)


#: ``mix`` with its defaults, for DuckDB.
ORACLE = f"""
WITH RECURSIVE own AS (
  SELECT source, sum(coalesce(length(text), 0))::BIGINT AS chars FROM documents GROUP BY source
), rate AS (
  SELECT source, CASE WHEN chars > 0 THEN 1.0::DOUBLE * (SELECT sum(chars) FROM own)::DOUBLE * 1.0
    / (SELECT count(*) FROM own WHERE chars > 0)::DOUBLE / chars ELSE 0 END AS rate FROM own
), part AS (
  SELECT source, rate, greatest(1, ceil(rate / {PART_RATE}::DOUBLE)::INT) AS parts FROM rate
), dist AS (
  SELECT source, parts, rate / parts AS lam, 0 AS k, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS c FROM part WHERE rate > 0
  UNION ALL
  SELECT source, parts, lam, k + 1, p * lam / (k + 1), c + p * lam / (k + 1) FROM dist
  WHERE k + 1 < ceil(lam + 12 * sqrt(lam))::INT + 24
), cdf AS (
  SELECT source, any_value(parts) AS parts, list(c ORDER BY k) AS cs FROM dist GROUP BY source
), drawn AS (
  SELECT d.doc_id, d.source, d.text, coalesce(d.doc_id::VARCHAR, 'null') AS key,
    list_sum(list_transform(range(1, c.parts + 1), lambda j: len(list_filter(c.cs, lambda x:
      x <= ('0x' || substr(md5('{SEED}:count:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || j::VARCHAR), 1, 13))::BIGINT / 4503599627370496::DOUBLE)))) AS n
  FROM documents d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source
), copies AS (
  SELECT *, unnest(range(1, n::BIGINT + 1))::BIGINT AS copy FROM drawn
)
SELECT doc_id, source, copy,
  ('0x' || substr(md5('{SEED}:place:' || key || ':' || copy::VARCHAR), 1, 15))::BIGINT AS shuffle_key, text
FROM copies
"""
