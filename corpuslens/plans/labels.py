"""Queries of label agreement, scoring, decisions and costs.

``labels.quality`` and ``labels.toxic`` are the two raters; events are the journal of calls.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from corpuslens.functions import exprs as X
from corpuslens.operators import agreement, bootstrap, ordering
from corpuslens.plans.base import query


@query("""SELECT item_id, len(list_intersect(a, b)) / len(list_distinct(a || b))::DOUBLE AS jaccard, len(list_intersect(a, b)) / len(list_distinct(a || b))::DOUBLE >= 0.6 AS agree FROM
(SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS a, list_distinct(regexp_extract_all(lower(substr(text, 1, 120)), '[a-z0-9]+')) AS b FROM benchmark)""")
def jaccard_agreement(t):
    j = X.jaccard(X.word_set(F.col("text")), X.word_set(F.substring("text", 1, 120)))
    return t.benchmark.select("item_id", j.alias("jaccard")).withColumn("agree", F.col("jaccard") >= 0.6)


_RATED = "(SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


def _rated(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")


_DECISION = f"SELECT doc_id, lang, CASE WHEN quality IS NULL AND toxic IS NULL THEN 'unlabeled' WHEN quality IS NULL OR toxic IS NULL THEN 'adjudicate' WHEN quality <> toxic THEN 'adjudicate' WHEN quality = 0 THEN 'absent' ELSE 'accept' END AS decision FROM {_RATED}"


def _decided(t):
    return _rated(t).select("doc_id", "lang", agreement.decide(F.col("quality"), F.col("toxic")).alias("decision"))


@query(_DECISION)
def label_decision(t):
    return _decided(t)


@query(f"SELECT *, n / sum(n) OVER (PARTITION BY lang)::DOUBLE AS share FROM (SELECT lang, decision, count(*) AS n FROM ({_DECISION}) GROUP BY ALL)")
def decision_mix(t):
    counts = _decided(t).groupBy("lang", "decision").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("lang")))


@query(f"SELECT doc_id, CASE WHEN quality IS NULL THEN 'ask_again' WHEN quality = 1 AND toxic = 0 THEN 'keep' WHEN quality = toxic THEN 'flag' ELSE 'drop' END AS verdict FROM {_RATED}")
def two_pass_decision(t):
    q, x = F.col("quality"), F.col("toxic")
    return _rated(t).select("doc_id", F.when(q.isNull(), "ask_again").when((q == 1) & (x == 0), "keep").when(q == x, "flag").otherwise("drop").alias("verdict"))


_GOLD = "SELECT d.lang, l.quality = 1 AS gold, length(d.text) > 1000 AS pred FROM labels l JOIN documents d USING (doc_id)"


def _gold(t):
    rows = t.labels.join(t.documents.select("doc_id", "lang", F.length("text").alias("n")), "doc_id")
    return rows.select("doc_id", "lang", (F.col("quality") == 1).alias("gold"), (F.col("n") > 1000).alias("pred"))


_PRF = "count(*) FILTER (WHERE gold AND pred) AS tp, count(*) FILTER (WHERE NOT gold AND pred) AS fp, count(*) FILTER (WHERE gold AND NOT pred) AS fn, count(*) FILTER (WHERE NOT gold AND NOT pred) AS tn"


@query(f"SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::DOUBLE END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn)::DOUBLE END AS recall, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn)::DOUBLE END AS f1 FROM (SELECT lang, {_PRF} FROM ({_GOLD}) GROUP BY lang)")
def prf1(t):
    return agreement.prf1(_gold(t), ["lang"], F.col("gold"), F.col("pred"))


_KAPPA = "WITH c AS (SELECT quality AS a, toxic AS b, count(*) AS n FROM labels GROUP BY ALL), s AS (SELECT sum(n) AS n, sum(n) FILTER (WHERE a = b) AS same FROM c), e AS (SELECT sum(x.na * y.nb) AS ab FROM (SELECT a, sum(n) AS na FROM c GROUP BY a) x JOIN (SELECT b, sum(n) AS nb FROM c GROUP BY b) y ON x.a = y.b)"


@query(f"{_KAPPA} SELECT n::BIGINT AS n, round(same / n::DOUBLE, 9) AS accuracy, round((same / n::DOUBLE - ab / (n * n)::DOUBLE) / (1 - ab / (n * n)::DOUBLE), 9) AS kappa FROM s, e")
def cohen_kappa(t):
    return agreement.kappa(t.labels, "quality", "toxic").select("n", F.round("accuracy", 9).alias("accuracy"), F.round("kappa", 9).alias("kappa"))


@query(f"SELECT CASE WHEN tp + fn = 0 THEN 'not_run' WHEN n < 10 THEN 'incomplete' WHEN 2 * tp / (2 * tp + fp + fn)::DOUBLE >= 0.75 THEN 'pass' ELSE 'fail' END AS status, n FROM (SELECT {_PRF}, count(*) AS n FROM ({_GOLD}))")
def calibration_gate(t):
    scored = agreement.prf1(_gold(t), [], F.col("gold"), F.col("pred"))
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    status = F.when(F.col("tp") + F.col("fn") == 0, "not_run").when(n < 10, "incomplete").when(F.col("f1") >= 0.75, "pass").otherwise("fail")
    return scored.select(status.alias("status"), n.alias("n"))


@query(f"SELECT lang, count(*) AS n, count(*) FILTER (WHERE gold = pred) / count(*)::DOUBLE AS accuracy, count(*) >= 5 AS enough FROM ({_GOLD}) GROUP BY lang")
def field_accuracy(t):
    same = F.count_if(F.col("gold") == F.col("pred"))
    return _gold(t).groupBy("lang").agg(F.count("*").alias("n"), (same / F.count("*")).alias("accuracy"), (F.count("*") >= 5).alias("enough"))


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL")
def confusion_matrix(t):
    return t.labels.groupBy("quality", "toxic").agg(F.count("*").alias("n"))


@query("SELECT event_id, value FROM events WHERE value < CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 1 ELSE 0.5 END ORDER BY value, event_id")
def low_conf_flags(t):
    bars = F.create_map(F.lit("click"), F.lit(2.0), F.lit("view"), F.lit(1.0))
    bar = F.coalesce(F.try_element_at(bars, F.col("event_type")), F.lit(0.5))
    return t.events.where(F.col("value") < bar).select("event_id", "value").orderBy("value", "event_id")


@query("""WITH l AS (SELECT doc_id, lower(trim(unnest(string_split(text, chr(10))), ' ')) AS line FROM documents), c AS (SELECT line, count(DISTINCT doc_id) AS docs FROM l WHERE length(line) > 20 GROUP BY line)
SELECT doc_id, count(*) AS matched FROM (SELECT DISTINCT doc_id, line FROM l) JOIN c USING (line) WHERE docs > 1 GROUP BY doc_id""")
def line_match_score(t):
    """How many of a document's lines, folded, another document has too."""
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("l")).select("doc_id", F.lower(F.trim("l")).alias("line")).where("length(line) > 20")
    own = lines.distinct()
    shared = own.groupBy("line").agg(F.count("*").alias("docs")).where("docs > 1")
    return own.join(shared, "line").groupBy("doc_id").agg(F.count("*").alias("matched"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def todo_antijoin(t):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left_anti")


@query("SELECT event_type, count(*) AS calls, sum(length(props))::BIGINT AS tokens, round(sum(length(props)) * CASE event_type WHEN 'click' THEN 0.5 WHEN 'view' THEN 0.25 ELSE 1 END / 1000.0, 6)::DOUBLE AS cost FROM events GROUP BY event_type")
def cost_projection(t):
    sums = t.events.groupBy("event_type").agg(F.count("*").alias("calls"), F.sum(F.length("props")).alias("tokens"))
    prices = t.rows([("click", 0.5), ("view", 0.25)], "event_type string, price double")
    return sums.join(F.broadcast(prices), "event_type", "left").select("event_type", "calls", "tokens", F.round(F.col("tokens") * F.coalesce("price", F.lit(1.0)) / 1000, 6).alias("cost"))


_SEATS = """SELECT total, stratum, weight, CASE WHEN total < n THEN (row_number() OVER (PARTITION BY total ORDER BY weight DESC, stratum) <= total)::INTEGER
  WHEN assigned <= total THEN base + (row_number() OVER (PARTITION BY total ORDER BY round(base - exact, 9), stratum) <= total - assigned)::INTEGER
  ELSE base - coalesce(taken, 0) END AS seats FROM p LEFT JOIN g USING (total, stratum)"""


@query(f"""WITH w AS (SELECT n_chars // 1500 AS stratum, count(*) AS weight FROM documents GROUP BY 1), t AS (SELECT unnest([5, 40, 400])::INTEGER AS total),
p AS (SELECT total, stratum, weight, total * weight / sum(weight) OVER q::DOUBLE AS exact, greatest(1, floor(total * weight / sum(weight) OVER q::DOUBLE))::INTEGER AS base, count(*) OVER q AS n, sum(greatest(1, floor(total * weight / s.every::DOUBLE))) OVER q AS assigned
  FROM t, w, (SELECT sum(weight) AS every FROM w) s WINDOW q AS (PARTITION BY total)),
g AS (SELECT total, stratum, count(*) AS taken FROM (SELECT total, stratum, assigned, row_number() OVER (PARTITION BY total ORDER BY round, exact, stratum) AS place FROM (SELECT *, unnest(range(1, base)) AS round FROM p)) WHERE place <= assigned - total GROUP BY ALL)
{_SEATS}""")
def largest_remainder(t):
    """Draws of three sizes over strata of length: fewer seats than strata, floors that overshoot, and enough."""
    strata = t.documents.groupBy(F.floor(F.col("n_chars") / 1500).alias("stratum")).agg(F.count("*").alias("weight"))
    out = None
    for total in (5, 40, 400):
        part = ordering.largest_remainder(strata, "stratum", "weight", total).select(F.lit(total).alias("total"), "stratum", "weight", "seats")
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT user_id, list({'f': event_type, 'v': value} ORDER BY event_type) AS fields FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1) WHERE event_type <> 'error' GROUP BY user_id")
def latest_decision_nested(t):
    last = ordering.first_by(t.events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).where("event_type <> 'error'")
    return last.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct(F.col("event_type").alias("f"), F.col("value").alias("v")))).alias("fields"))


@query("SELECT e.user_id, e.event_id, CASE WHEN sha256(e.event_type) = sha256('click') THEN 'reviewed' ELSE 'awaiting review' END AS state, c.c_custkey IS NOT NULL AS backed_up FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) e LEFT JOIN customer c ON c.c_custkey = e.user_id")
def review_state(t):
    last = ordering.first_by(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    state = F.when(F.sha2("event_type", 256) == F.sha2(F.lit("click"), 256), "reviewed").otherwise("awaiting review")
    both = last.join(t.customer.select(F.col("c_custkey").alias("k")), F.col("user_id") == F.col("k"), "left")
    return both.select("user_id", "event_id", state.alias("state"), F.col("k").isNotNull().alias("backed_up"))


@query("SELECT l_partkey AS k, max(l_orderkey * 10 + l_linenumber) AS selected, (count(*) - 1)::BIGINT AS superseded FROM lineitem GROUP BY 1")
def last_source_wins(t):
    place = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return t.lineitem.groupBy(F.col("l_partkey").alias("k")).agg(F.max(place).alias("selected"), (F.count("*") - 1).alias("superseded"))


@query("SELECT user_id, count(*) AS calls, sum(coalesce(length(props), 0))::BIGINT AS tokens FROM events GROUP BY user_id")
def usage_by_document(t):
    return t.events.groupBy("user_id").agg(F.count("*").alias("calls"), F.sum(F.coalesce(F.length("props"), F.lit(0))).alias("tokens"))


@query("SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS zeros, count(*) AS n FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE event_type = 'view') >= 3 AND count(*) FILTER (WHERE event_type = 'view') > 0.2 * count(*)")
def conditional_share_having(t):
    sums = t.events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "view").alias("zeros"), F.count("*").alias("n"))
    return sums.where((F.col("zeros") >= 3) & (F.col("zeros") > 0.2 * F.col("n")))


@query("SELECT user_id, event_id FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) WHERE event_type = 'error'")
def latest_attempt_failures(t):
    last = ordering.first_by(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return last.where("event_type = 'error'").select("user_id", "event_id")


@query(f"SELECT lang, count(*) AS open FROM ({_DECISION}) x WHERE decision = 'adjudicate' AND doc_id % 3 <> 0 GROUP BY lang")
def open_items(t):
    verdicts = t.documents.where("doc_id % 3 = 0").select("doc_id", F.lit("done").alias("verdict"))
    rows = _decided(t).where("decision = 'adjudicate'").join(verdicts, "doc_id", "left").where("verdict is null")
    return rows.groupBy("lang").agg(F.count("*").alias("open"))


@query(f"SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN 'corrected' WHEN quality IS NOT NULL THEN 'label:' || quality ELSE 'pending' END AS cell, CASE WHEN doc_id % 50 = 0 THEN 'gold' WHEN quality IS NOT NULL THEN 'labels' ELSE 'none' END AS provenance FROM {_RATED}")
def label_overlay(t):
    """Corrections come before labels, and labels before nothing: priority by row_number."""
    fixes = t.documents.where("doc_id % 50 = 0").select("doc_id", F.lit("corrected").alias("cell"), F.lit("gold").alias("provenance"), F.lit(0).alias("rank"))
    given = t.labels.select("doc_id", F.concat(F.lit("label:"), F.col("quality").cast("string")).alias("cell"), F.lit("labels").alias("provenance"), F.lit(1).alias("rank"))
    none = t.documents.select("doc_id", F.lit("pending").alias("cell"), F.lit("none").alias("provenance"), F.lit(2).alias("rank"))
    every = fixes.unionByName(given).unionByName(none)
    best = every.groupBy("doc_id").agg(F.min_by(F.struct("cell", "provenance"), "rank").alias("x"))
    return best.join(t.documents.select("doc_id"), "doc_id", "left_semi").select("doc_id", "x.cell", "x.provenance")


def poisson_weight(u: Column) -> Column:
    """The Poisson variable of mean 1 at ``u`` in [0, 1), for all values that a double tells from 1."""
    out, k, chance, total = None, 0, math.exp(-1), 0.0
    while total + chance > total:
        total += chance
        out = (F.when if out is None else out.when)(u < total, k)
        k, chance = k + 1, chance / (k + 1)
    return out.otherwise(k)


@query()
def paired_bootstrap(t):
    """The 95% interval of a difference of accuracies over 2000 hash-weighted replicates."""
    rows = _gold(t)
    counts = {"n": F.lit(1), "a": F.col("gold") == F.col("pred"), "b": F.col("gold")}
    sums = bootstrap.replicate_sums(rows, "doc_id", {k: c.cast("int") for k, c in counts.items()})
    return sums.select(((F.col("a") - F.col("b")) / F.col("n")).alias("diff")).agg(F.percentile("diff", 0.025).alias("low"), F.percentile("diff", 0.975).alias("high"))


@query()
def bootstrap_metrics(t):
    """Accuracy, micro-F1 and kappa of two raters against a third, as paired differences with intervals."""
    rows = _gold(t).join(t.labels.select("doc_id", (F.col("toxic") == 0).alias("other")), "doc_id")
    gold, sides = F.col("gold"), {"a": F.col("pred"), "b": F.col("other")}
    counts = {}
    for s, c in sides.items():
        counts |= {f"{s}_tp": gold & c, f"{s}_fp": ~gold & c, f"{s}_fn": gold & ~c, f"{s}_tn": ~gold & ~c}
    at = lambda s, k: F.col(f"{s}_{k}")
    cells = lambda s: {("y", "y"): at(s, "tp"), ("n", "y"): at(s, "fp"), ("y", "n"): at(s, "fn"), ("n", "n"): at(s, "tn")}
    every = lambda s: at(s, "tp") + at(s, "fp") + at(s, "fn") + at(s, "tn")
    metrics = {
        "accuracy": tuple(F.when(every(s) > 0, (at(s, "tp") + at(s, "tn")) / every(s)).otherwise(0.0) for s in sides),
        "micro_f1": tuple(bootstrap.micro_f1(at(s, "tp"), at(s, "fp"), at(s, "fn")) for s in sides),
        "cohen_kappa": tuple(bootstrap.kappa(cells(s)) for s in sides),
    }
    return bootstrap.paired_intervals(rows, "doc_id", {k: c.cast("int") for k, c in counts.items()}, metrics)


@query("SELECT quality, toxic, round(count(*) * 100.0 / sum(count(*)) OVER (), 6)::DOUBLE AS pct FROM labels GROUP BY ALL")
def rater_share(t):
    n = t.labels.groupBy("quality", "toxic").agg(F.count("*").alias("n"))
    return n.select("quality", "toxic", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("pct"))
