"""Quality rules: base counts, then robust multivariate outliers by language and source.

All counts are made inside each row by built-in expressions over the whole text. The
method turns them into five statistics and, for each language and source, estimates their
centre and scatter by the minimum covariance determinant: from each of three robust starts,
concentration steps keep the three quarters of rows that are nearest and estimate again
from these, until the determinant falls no further; the start that ends with the least
determinant is taken. Rows are rejected by their Mahalanobis distance.

The starts are deterministic: the medians with the quartile ranges alone, and with the
correlations of the statistics' hyperbolic tangents or of their spatial signs.

A step is one aggregation over a narrow table: rows are put in bins by the logarithm of
their distance (``BINS_A_LOG`` for a factor of e), each bin's counts, sums and cross
products are added up (with map-side partials), and the bins are summed from the nearest
on, the last one with the weight that makes exactly three quarters of the rows. So no task
gathers a group, a group with a third of all rows included; what is joined back is one row
a group and start, by broadcast up to a counted size and by group and salt beyond it.
Groups of fewer than ``LEAST_ROWS`` rows use the estimates of all rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.store import Workspace

STATS = ("s0", "s1", "s2", "s3", "s4")
#: Standard deviations are not taken to be less than these, in the units of the statistics.
FLOORS = (0.10, 0.04, 0.30, 0.25, 0.03)
KEPT_SHARE, LEAST_ROWS = 0.75, 60
#: Steps end when the logarithm of the determinant falls by less than this, which ten or so do.
LEAST_FALL, MOST_STEPS = 1e-3, 100
#: The chance that a row of a normal distribution is rejected.
TAIL = 1e-3
BINS_A_LOG = 64
#: A table of one row a group is broadcast up to so many rows; beyond, rows meet it by group and salt.
BROADCAST_ROWS, SALTS = 50_000, 64
#: The number of the group of all rows, which small groups are judged by.
POOLED = -1


def chi2_quantile(p: float, d: int = len(STATS)) -> float:
    """The quantile of chi-square with ``d`` (odd) degrees of freedom, by bisection."""

    def upper(x: float) -> float:
        total, term = math.erfc(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
        for k in range(1, d, 2):
            total += term
            term *= x / (k + 2)
        return total

    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if upper(mid) > 1 - p else (low, mid)
    return low


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is then computed once a row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words and the base counts of ``docs``, one row per row."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    split = own.select(
        "doc_id",
        "lang",
        "source",
        F.expr(r"filter(split(t, '[\\x20\\x09-\\x0D]+'), w -> w <> '')").alias("words"),
        F.expr(r"cast(length(regexp_replace(t, '[^#*$%&|<>]+', '')) as bigint)").alias("n_symbols"),
        F.expr(r"filter(split(t, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("lines"),
    )
    windows = "if(size(h) < 5, cast(array() as array<bigint>), transform(sequence(0, size(h) - 5), i -> xxhash64(h[i], h[i + 1], h[i + 2], h[i + 3], h[i + 4])))"
    found = split.select(
        "doc_id",
        "lang",
        "source",
        "n_symbols",
        F.expr("cast(size(words) as bigint)").alias("n_words"),
        F.expr("cast(length(array_join(words, '')) as bigint)").alias("word_chars"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as bigint)").alias("n_dup_lines"),
        F.expr(_let("transform(words, w -> xxhash64(w))", "h", windows)).alias("windows"),
    )
    # of the sorted windows, those equal to a neighbour; then the words that they cover, once each
    places = "array_sort(filter(transform(s, (e, k) -> if(e.h <=> get(s, k - 1).h or e.h <=> get(s, k + 1).h, e.i, null)), i -> i is not null))"
    cover = "aggregate(transform(p, (x, k) -> least(5, coalesce(get(p, k + 1), x + 5) - x)), 0, (a, x) -> a + x)"
    detail = _let("array_sort(transform(windows, (h, i) -> named_struct('h', h, 'i', i)))", "s", _let(places, "p", cover))
    repeats = f"if(size(array_distinct(windows)) = size(windows), 0L, cast({detail} as bigint))"
    return found.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.expr(repeats).alias("n_repeat_words"))


def statistics() -> list[Column]:
    """Five transformed statistics: length, word length, symbols, line and window repeats."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p(F.col("n_words")),
        F.log1p(F.col("word_chars") / words),
        F.log1p(100 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.log1p(F.col("n_dup_lines")),
        F.col("n_repeat_words") / words,
    ]


_PAIRS = [(i, j) for i in range(len(STATS)) for j in range(i + 1)]
_MEANS, _ROOT = [f"m{i}" for i in range(len(STATS))], [f"l{i}_{j}" for i, j in _PAIRS]


def _with_root(moments: DataFrame, keep: list[str]) -> DataFrame:
    """Means ``m*`` and the Cholesky root ``l*`` of the covariance, from sums over ``n`` rows.

    A squared floor is added to each variance, so the root exists for constant statistics.
    """
    out = moments
    for i, s in enumerate(STATS):
        out = out.withColumn(f"m{i}", F.col(f"sum_{s}") / F.col("n"))
    out = out.select("*", *[(F.col(f"sum_{STATS[i]}{STATS[j]}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}") + (FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}_{j}") for i, j in _PAIRS])
    for i, j in _PAIRS:
        rest = F.col(f"c{i}_{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
        out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 / 4))) if i == j else rest / F.col(f"l{j}_{j}"))
    return out.select(*keep, *_MEANS, *_ROOT)


def _with_distance(rows: DataFrame) -> DataFrame:
    """``d2``: the squared Mahalanobis distance, by forward substitution."""
    for i, s in enumerate(STATS):
        rest = F.col(s) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}_{k}") * F.col(f"z{k}")
        rows = rows.withColumn(f"z{i}", rest / F.col(f"l{i}_{i}"))
    total = F.lit(0.0)
    for i in range(len(STATS)):
        total = total + F.col(f"z{i}") * F.col(f"z{i}")
    return rows.withColumn("d2", total / F.col("scale"))


def _meet(rows: DataFrame, groups: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``groups``, a written table of one row a ``key``.

    No task gets all rows of a key: a counted, small table is broadcast, and a larger one
    is repeated for each salt that the rows are dealt over.
    """
    if groups.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(groups), key, how)
    salted = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("__salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    return dealt.join(salted, [key, "__salt"], how).drop("__salt")


_SUMS = [f"sum_{s}" for s in STATS] + [f"sum_{STATS[i]}{STATS[j]}" for i, j in _PAIRS]


def _estimated(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Means, root of the scatter and ``logdet`` by ``keys``, from sums over ``n`` rows."""
    out = _with_root(moments, keys).withColumn("scale", F.lit(1.0))
    return out.withColumn("logdet", 2 * sum((F.log(f"l{i}_{i}") for i in range(len(STATS))), F.lit(0.0)))


def _starts(rows: DataFrame, work: Workspace) -> DataFrame:
    """Three estimates of each ``grp``, numbered by ``start``."""
    quarters = rows.groupBy("grp").agg(*[F.percentile_approx(s, [0.25, 0.5, 0.75], 10_000).alias(f"q_{s}") for s in STATS])
    spread = [F.sqrt(F.pow((F.col(f"q_{s}")[2] - F.col(f"q_{s}")[0]) / 1.349, 2) + FLOORS[i] ** 2) for i, s in enumerate(STATS)]
    quarters = work.write(quarters.select("grp", *[F.col(f"q_{s}")[1].alias(f"med{i}") for i, s in enumerate(STATS)], *[c.alias(f"sd{i}") for i, c in enumerate(spread)]), "quarters")
    z = [(F.col(s) - F.col(f"med{i}")) / F.col(f"sd{i}") for i, s in enumerate(STATS)]
    scored = _meet(rows, quarters, "grp").select("grp", *[c.alias(f"z{i}") for i, c in enumerate(z)])
    norm = F.sqrt(F.greatest(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(STATS))), F.lit(0.0)), F.lit(1e-18)))
    bent = scored.select("grp", *[F.tanh(f"z{i}").alias(f"t{i}") for i in range(len(STATS))], *[(F.col(f"z{i}") / norm).alias(f"u{i}") for i in range(len(STATS))])
    cross = bent.groupBy("grp").agg(*[F.sum(F.col(f"{k}{i}") * F.col(f"{k}{j}")).alias(f"{k}{i}_{j}") for k in "tu" for i, j in _PAIRS])

    def start(number: int, kind: str | None) -> Column:
        cells = []
        for i, j in _PAIRS:
            if i == j:
                r = F.lit(1.0)
            else:
                r = F.lit(0.0) if kind is None else F.col(f"{kind}{i}_{j}") / F.sqrt(F.greatest(F.col(f"{kind}{i}_{i}") * F.col(f"{kind}{j}_{j}"), F.lit(1e-18)))
            cells.append((r * F.col(f"sd{i}") * F.col(f"sd{j}") + F.col(f"med{i}") * F.col(f"med{j}")).alias(f"sum_{STATS[i]}{STATS[j]}"))
        return F.struct(F.lit(number).alias("start"), F.lit(1).alias("n"), *[F.col(f"med{i}").alias(f"sum_{s}") for i, s in enumerate(STATS)], *cells)

    every = cross.join(quarters, "grp").select("grp", F.explode(F.array(start(0, None), start(1, "t"), start(2, "u"))).alias("x"))
    return _estimated(every.select("grp", "x.*"), ["grp", "start"])


def _concentrated(rows: DataFrame, now: DataFrame) -> DataFrame:
    """The estimates from the three quarters of rows that are nearest under ``now``."""
    sums = [F.sum(s).alias(f"sum_{s}") for s in STATS] + [F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"sum_{STATS[i]}{STATS[j]}") for i, j in _PAIRS]
    measured = _with_distance(_meet(rows, now, "grp")).withColumn("bin", F.floor(F.log(F.col("d2") + 1e-9) * BINS_A_LOG))
    weighed = _weighed(measured.groupBy("grp", "start", "bin").agg(F.count("*").alias("n"), *sums), ["grp", "start"], KEPT_SHARE)
    near = weighed.where("weight > 0").groupBy("grp", "start").agg(*[F.sum(F.col(c) * F.col("weight")).alias(c) for c in ["n", *_SUMS]])
    return _estimated(near, ["grp", "start"])


def _weighed(binned: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Bins with the ``weight`` of each, so that the nearest ``share`` of the rows is taken."""
    order = Window.partitionBy(*keys).orderBy("bin")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = F.sum("n").over(Window.partitionBy(*keys))
    room = F.ceil(every * share) - before
    return binned.withColumn("weight", F.greatest(F.lit(0.0), F.least(F.lit(1.0), room / F.col("n"))))


def estimates(rows: DataFrame, work: Workspace) -> DataFrame:
    """One row per ``grp``: means, root of the scatter, and ``scale``, from ``grp`` and statistics.

    ``scale`` makes the median squared distance that of the chi-square distribution.
    """
    now = work.write(_starts(rows, work), "estimates-0")
    done, left, k = None, 1, 0
    while left:
        k += 1
        was = now.select("grp", "start", F.col("logdet").alias("was"))
        # the first steps leave the starts' own determinants behind, which are of all rows
        fell = (F.col("logdet") < F.col("was") - LEAST_FALL) | F.lit(k <= 2)
        new = work.write(_concentrated(rows, now).join(was, ["grp", "start"]).withColumn("fell", fell), f"estimates-{k}")
        left = new.where("fell").count()
        if k == MOST_STEPS and left:
            raise RuntimeError("the determinants did not settle")
        ended = new.where("not fell").drop("was", "fell")
        done = ended if done is None else done.unionByName(ended)
        now = new.where("fell").drop("was", "fell")
    best = done.groupBy("grp").agg(F.min_by(F.struct(*_MEANS, *_ROOT, "scale"), F.struct("logdet", "start")).alias("x"))
    now = work.write(best.select("grp", "x.*"), "best")
    middle = chi2_quantile(0.5)
    measured = _with_distance(_meet(rows, now, "grp")).withColumn("bin", F.floor(F.log(F.col("d2") + 1e-9) * BINS_A_LOG))
    halves = _weighed(measured.groupBy("grp", "bin").agg(F.count("*").alias("n"), F.max("d2").alias("d2")), ["grp"], 0.5)
    scale = halves.where("weight > 0").groupBy("grp").agg(F.greatest(F.lit(1.0), F.max("d2") / middle).alias("scale"))
    return work.write(now.drop("scale").join(scale, "grp"), "estimates")


def judge(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """Base counts and the verdict of every row of ``docs(doc_id, text, lang, source)``.

    base_failed is n_words < 10 or 100 * n_repeat_words > 20 * n_words; kept is false if it
    is, and otherwise whether the row is within the distance that a share ``tail`` of a
    normal distribution would pass. Rows that fail the base don't enter the estimates.
    Null lang and source are values of their own; a null text has no words and fails. A
    table in which all rows fail has no estimates and keeps none. Repeated rows are judged
    alike. An empty table gives no rows; other columns are not read.
    """
    work = Workspace(docs.sparkSession, "quality-mcd")
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    group = F.concat_ws("\u0001", F.coalesce("lang", F.lit("\u0002")), F.coalesce("source", F.lit("\u0002")))
    rows = base_counts(docs).withColumn("base_failed", failed).withColumn("own", group)
    rows = work.write(rows.select("*", *[c.alias(s) for c, s in zip(statistics(), STATS, strict=True)]), "counts")
    good = rows.where("not base_failed")
    sizes = good.groupBy("own").agg((F.count("*") >= LEAST_ROWS).alias("large"))
    sizes = work.write(sizes.withColumn("grp", F.when(F.col("large"), F.monotonically_increasing_id()).otherwise(POOLED)), "sizes")
    grouped = _meet(good, sizes, "own")
    found = estimates(work.write(grouped.select("grp", *STATS).unionByName(_pooled(good, sizes)), "grouped"), work)
    place = _meet(rows, sizes, "own", "left").withColumn("grp", F.coalesce("grp", F.lit(POOLED)))
    verdict = _with_distance(_meet(place, found, "grp", "left"))
    kept = ~F.col("base_failed") & (F.col("d2") <= chi2_quantile(1 - tail))
    return verdict.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.coalesce(kept, F.lit(False)).alias("kept"), F.col("d2").alias("distance2"))


def _pooled(good: DataFrame, sizes: DataFrame) -> DataFrame:
    """All rows once more as the group that small groups are judged by; none if all are large."""
    if sizes.where("not large").isEmpty():
        return good.limit(0).select(F.lit(POOLED).cast("long").alias("grp"), *STATS)
    return good.join(sizes.where("large"), "own", "left_semi").select(F.lit(POOLED).cast("long").alias("grp"), *STATS)
