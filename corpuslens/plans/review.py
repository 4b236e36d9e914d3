"""Queries of label review. Cases that the tables lack are made from ids, the same in both forms."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from corpuslens.functions import exprs as X
from corpuslens.operators import json_diff, references, review
from corpuslens.plans.base import query

_SPACE = r"'[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'"


def _squeezed(c: str) -> str:
    return f"trim(regexp_replace({c}, {_SPACE}, ' ', 'g'))"


CATEGORIES = ["Deductible", "Proof Of Loss", "Coverage Determination"]


@query(f"""WITH items AS (
  SELECT doc_id, i, category, {_squeezed('quote')} AS quote FROM (
    SELECT doc_id, unnest([0, 1, 2, 3, 4]) AS i, unnest(['Deductible', 'Deductible', 'Weather', 'Proof Of Loss', 'Proof Of Loss']) AS category,
      unnest([split_part(text, chr(10), 1), split_part(text, chr(10), 1), split_part(text, chr(10), 1), substr(text, 2, 60), 'There is no proof of ' || doc_id]) AS quote FROM documents)),
lines AS (SELECT DISTINCT doc_id, {_squeezed('l')} AS quote, TRUE AS whole FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)),
marked AS (SELECT doc_id, i, category, quote, min(i) OVER (PARTITION BY doc_id, category, quote) AS first, whole IS NULL AS lacks,
    contains({_squeezed('text')}, quote) AND contains(quote, ' ') AS inside FROM items LEFT JOIN lines USING (doc_id, quote) JOIN documents USING (doc_id))
SELECT doc_id, i, unnest(list_filter([CASE WHEN category = 'Weather' THEN 'unknown_category' END, CASE WHEN i > first THEN 'duplicate_item' END, CASE WHEN lacks AND inside THEN 'stitched_lines' END,
  CASE WHEN lacks AND NOT inside THEN 'complete_source_line_required' END, CASE WHEN category = 'Proof Of Loss' AND regexp_matches(quote, '(?i)\\b(no|not|without)\\b') THEN 'negative_proof' END], lambda c: c IS NOT NULL)) AS code FROM marked""")
def checklist_findings(t):
    """Checklist items held to their documents' lines, with one item for each rule."""
    line = F.split("text", "\n")[0]
    made = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("category"), q.alias("quote")) for i, (c, q) in enumerate([("Deductible", line), ("Deductible", line), ("Weather", line), ("Proof Of Loss", F.substring("text", 2, 60)), ("Proof Of Loss", F.concat(F.lit("There is no proof of "), F.col("doc_id").cast("string")))])])
    items = t.documents.select("doc_id", F.explode(made).alias("x")).select("doc_id", "x.*")
    return review.checklist_findings(items, t.documents.select("doc_id", "text"), CATEGORIES)


@query("""WITH r AS (SELECT source, count(*) AS expected, count(l.quality) + CASE WHEN source IN ('src1', 'src2', 'src3', 'src4') THEN count(*) - count(l.quality) ELSE 0 END AS ran,
  CASE WHEN source = 'src2' THEN ['m1', 'm2'] ELSE ['m1'] END AS models, coalesce(avg(l.quality), 0) AS f1 FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source)
SELECT source, CASE WHEN ran = 0 THEN 'not_run' WHEN ran < expected THEN 'incomplete' WHEN models <> ['m1'] THEN 'model_mismatch' WHEN f1 >= 0.85 THEN 'pass' ELSE 'fail' END AS status FROM r""")
def calibration_status(t):
    """The gate's five outcomes, over sources as calibration runs."""
    rows = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    runs = rows.groupBy("source").agg(F.count("*").alias("expected"), F.count("quality").alias("n"), F.coalesce(F.avg("quality"), F.lit(0.0)).alias("f1"))
    ran = F.when(F.col("source").isin("src1", "src2", "src3", "src4"), F.col("expected")).otherwise(F.col("n"))
    models = F.when(F.col("source") == "src2", F.array(F.lit("m1"), F.lit("m2"))).otherwise(F.array(F.lit("m1")))
    return runs.select("source", review.calibration_status(ran, F.col("expected"), models, F.array(F.lit("m1")), F.col("f1"), 0.85).alias("status"))


_OVERLAY = """SELECT CASE WHEN l.doc_id % 13 = 0 THEN l.doc_id + 1000000000 ELSE l.doc_id END AS doc_id, CASE WHEN l.doc_id % 7 = 0 THEN '' WHEN l.doc_id % 7 = 1 THEN 'zz' ELSE substr(sha256(d.text), 1, 12) END AS prefix,
  CASE WHEN l.doc_id % 11 = 0 THEN 'other' ELSE d.lang END AS kind, CASE WHEN l.doc_id % 17 = 0 THEN 'mood' ELSE 'quality' END AS field, CASE WHEN l.doc_id % 5 = 0 THEN 'draft' ELSE 'labeled' END AS status, l.quality::VARCHAR AS value FROM labels l JOIN documents d USING (doc_id)"""


@query(f"""SELECT CASE WHEN d.doc_id IS NULL THEN 'no_document' WHEN prefix = '' OR NOT starts_with(sha256(d.text), prefix) THEN 'hash_mismatch' WHEN kind <> d.lang THEN 'kind_mismatch' WHEN status <> 'labeled' THEN status
  WHEN field <> 'quality' THEN 'unregistered_field' ELSE 'used' END AS outcome, count(*) AS n FROM ({_OVERLAY}) o LEFT JOIN documents d ON d.doc_id = o.doc_id GROUP BY 1""")
def overlay_guards(t):
    """Labels laid over documents behind guards of identity, hash, class, status and field."""
    i = F.col("doc_id")
    docs = t.documents.select("doc_id", F.sha2("text", 256).alias("sha"), F.col("lang").alias("kind"))
    given = t.labels.select("doc_id", "quality").join(docs, "doc_id")
    records = given.select(
        F.when(i % 13 == 0, i + 1_000_000_000).otherwise(i).alias("doc_id"),
        F.when(i % 7 == 0, "").when(i % 7 == 1, "zz").otherwise(F.substring("sha", 1, 12)).alias("prefix"),
        F.when(i % 11 == 0, "other").otherwise(F.col("kind")).alias("kind"),
        F.when(i % 17 == 0, "mood").otherwise("quality").alias("field"),
        F.when(i % 5 == 0, "draft").otherwise("labeled").alias("status"),
        F.col("quality").cast("string").alias("value"),
    )
    return review.overlay(records, docs, ["labeled"], ["quality"]).groupBy("outcome").agg(F.count("*").alias("n"))


@query("""WITH k AS (SELECT sha256(text) AS digest, min(doc_id) AS survivor FROM documents GROUP BY 1), m AS (SELECT survivor, d.doc_id, l.quality = 1 AS accepted FROM documents d JOIN k ON sha256(d.text) = digest JOIN labels l USING (doc_id)),
b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY survivor ORDER BY accepted DESC, doc_id) = 1)
SELECT k.survivor AS doc_id, b.doc_id AS journal_id, CASE WHEN accepted THEN 'ingested' WHEN accepted IS NOT NULL THEN 'rejected' ELSE 'pending' END AS status FROM k LEFT JOIN b USING (survivor)""")
def journal_aliases(t):
    """Survivors of exact copies take a removed copy's accepted record if they have none."""
    rows = t.documents.select("doc_id", F.sha2("text", 256).alias("digest"))
    return review.journal_with_aliases(rows, t.labels.select("doc_id", (F.col("quality") == 1).alias("accepted")))


_SCORES = "(SELECT event_type AS arm, user_id AS doc, avg(value::DECIMAL(18, 6)) AS score FROM events GROUP BY ALL)"
_ARMS = "(SELECT event_type AS arm, CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'own' ELSE 'other' END AS vendor, length(event_type)::DOUBLE AS cost, event_type <> 'error' AS eligible FROM events GROUP BY event_type)"


@query(f"""WITH RECURSIVE s AS {_SCORES}, arms AS {_ARMS}, i AS (SELECT x.arm AS a, y.arm AS b, avg(x.score - y.score) AS mean, 1.96 * coalesce(stddev_samp(x.score - y.score), 0) / sqrt(count(*)) AS half FROM s x JOIN s y USING (doc) GROUP BY ALL),
o AS (SELECT arm, row_number() OVER (ORDER BY cost, arm) AS k FROM arms WHERE eligible AND vendor = 'own'),
p AS (SELECT k, arm AS pick FROM o WHERE k = 1 UNION ALL SELECT o.k, CASE WHEN i.mean - i.half > 0 THEN o.arm ELSE p.pick END FROM p JOIN o ON o.k = p.k + 1 JOIN i ON i.a = o.arm AND i.b = p.pick),
f AS (SELECT pick FROM p ORDER BY k DESC LIMIT 1), r AS (SELECT arms.*, pick, mean, mean - half AS lo, mean + half AS hi FROM arms, f JOIN i ON i.b = pick WHERE i.a = arms.arm),
n AS (SELECT arm FROM r WHERE eligible AND vendor <> 'own' AND lo >= -1.0 ORDER BY cost, arm LIMIT 1)
SELECT arm, vendor, cost, eligible, round(mean, 6) AS mean, round(lo, 6) AS lo, round(hi, 6) AS hi, CASE WHEN arm = pick THEN 'primary' WHEN arm = (SELECT arm FROM n) THEN 'second' WHEN hi < -1.0 THEN 'clearly worse' ELSE '' END AS role FROM r""")
def bakeoff_ranking(t):
    """Event types as arms: cheapest first, and a costlier one only if it is surely better."""
    scores = t.events.groupBy(F.col("event_type").alias("arm"), F.col("user_id").alias("doc")).agg(F.avg(F.col("value").cast("decimal(18,6)")).cast("double").alias("score"))
    vendor = F.when(F.col("event_type").isin("click", "view", "signup"), "own").otherwise("other")
    arms = t.events.select("event_type").distinct().select(F.col("event_type").alias("arm"), vendor.alias("vendor"), F.length("event_type").cast("double").alias("cost"), (F.col("event_type") != "error").alias("eligible"))
    out = review.rank_arms(arms, review.intervals(scores), 1.0)
    return out.select("arm", "vendor", "cost", "eligible", *[F.round(c, 6).alias(c) for c in ("mean", "lo", "hi")], "role")


@query("""SELECT doc_id, CASE k WHEN 0 THEN CASE WHEN quality IS NULL THEN 'error' ELSE 'accept' END WHEN 1 THEN CASE WHEN toxic IS NULL THEN 'error' ELSE 'accept' END WHEN 2 THEN 'accept' WHEN 3 THEN 'absent' WHEN 4 THEN 'unlabeled' ELSE CASE WHEN quality = 1 THEN 'accept' ELSE 'adjudicate' END END AS decision,
  CASE k WHEN 0 THEN quality::VARCHAR WHEN 1 THEN toxic::VARCHAR WHEN 2 THEN 'checked' WHEN 5 THEN CASE WHEN quality = 1 THEN '1' END END AS value FROM (SELECT doc_id, doc_id % 6 AS k, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))""")
def verdict_application(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    k = F.col("doc_id") % 6
    verdict = F.when(k == 0, "a").when(k == 1, "b").when(k == 2, "value").when(k == 3, "absent").when(k == 4, "wrong").otherwise("")
    decision = F.when(F.col("quality") == 1, "accept").otherwise("adjudicate")
    final = review.apply_verdict(verdict, decision, F.lit("1"), F.col("quality").cast("string"), F.col("toxic").cast("string"), F.lit("checked"))
    return rows.select("doc_id", final.alias("x")).select("doc_id", "x.decision", "x.value")


@query("SELECT d.doc_id, CASE WHEN d.lang = 'en' AND d.source <> 'src0' THEN 'source is gold' WHEN d.lang = 'en' AND l.quality = 1 THEN 'has labels' WHEN d.lang = 'de' AND l.toxic = 1 THEN 'answered' ELSE '' END AS reason FROM documents d LEFT JOIN labels l USING (doc_id)")
def gold_exclusion(t):
    """Why a row is gold, which a trial must leave out; empty if it isn't."""
    en, de = F.col("lang") == "en", F.col("lang") == "de"
    reason = F.when(en & (F.col("source") != "src0"), "source is gold").when(en & (F.col("quality") == 1), "has labels").when(de & (F.col("toxic") == 1), "answered").otherwise("")
    return t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left").select("doc_id", reason.alias("reason"))


@query("SELECT e.user_id, count(*) AS calls FROM events e WHERE sha256(e.event_type || chr(10) || (e.user_id % 3)) = sha256(e.event_type || chr(10) || CASE WHEN e.event_type = 'view' THEN '1' ELSE '2' END) GROUP BY e.user_id")
def current_version_calls(t):
    """Calls whose configuration is today's for their kind."""
    calls = t.events.select("user_id", "event_type", F.sha2(F.concat_ws("\n", "event_type", (F.col("user_id") % 3).cast("string")), 256).alias("config_sha"))
    kinds = t.events.select("event_type").distinct()
    config = kinds.select("event_type", F.sha2(F.concat_ws("\n", "event_type", F.when(F.col("event_type") == "view", "1").otherwise("2")), 256).alias("config_sha"))
    return review.current_calls(calls, config, ["event_type"]).groupBy("user_id").agg(F.count("*").alias("calls"))


@query("""WITH s AS (SELECT doc_id, w AS span, i * 10 AS start FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents) WHERE length(w) >= 9), f AS (SELECT doc_id, span, min(start)::INTEGER AS start FROM s GROUP BY ALL)
SELECT doc_id, span, start, row_number() OVER (PARTITION BY doc_id ORDER BY start, span)::INTEGER AS place FROM f""")
def evidence_spans(t):
    words = t.documents.select("doc_id", F.posexplode(F.split("text", " ")).alias("i", "span")).where("length(span) >= 9")
    return review.first_spans(words.select("doc_id", "span", ((F.col("i") + 1) * 10).cast("int").alias("start")))


@query("""SELECT lang AS name, count(DISTINCT s) AS declared, count(DISTINCT s) = 3 AND count(DISTINCT v) = 1 AS agree, min(v) AS least, max(v) AS most FROM (
  SELECT lang, 'card' AS s, min(source) AS v FROM documents GROUP BY lang UNION ALL SELECT lang, 'code', min(source) FROM documents WHERE n_chars > 100 GROUP BY lang UNION ALL SELECT lang, 'site', CASE WHEN lang = 'de' THEN 'src9' ELSE min(source) END FROM documents WHERE lang <> 'fr' GROUP BY lang) GROUP BY lang""")
def version_lockstep(t):
    """Whether card, code and site declare one version; a missing one disagrees."""
    docs = t.documents.select("lang", "source", "n_chars")
    one = lambda rows, name: rows.groupBy(F.col("lang").alias("name")).agg(F.min("source").alias("version")).withColumn("source", F.lit(name))
    site = one(docs.where("lang <> 'fr'"), "site").withColumn("version", F.when(F.col("name") == "de", "src9").otherwise(F.col("version")))
    return review.lockstep(one(docs, "card").unionByName(one(docs.where("n_chars > 100"), "code")).unionByName(site), ["card", "code", "site"])


@query("""WITH e AS (SELECT event_id, (props->>'k')::INTEGER AS k, event_type AS t FROM events)
SELECT event_id, 'a.k' AS path, k::VARCHAR AS old, (k + 1)::VARCHAR AS new FROM e WHERE event_id % 4 = 1 UNION ALL SELECT event_id, 'a.deep[0][1].b', k::VARCHAR, (k + 1)::VARCHAR FROM e WHERE event_id % 4 = 1 UNION ALL
SELECT event_id, 'list[1]', '"x"', NULL FROM e WHERE event_id % 4 = 2 UNION ALL SELECT event_id, 'a.deep[1]', '[]', NULL FROM e WHERE event_id % 4 = 2 UNION ALL SELECT event_id, 'a.deep[1][0]', NULL, '[]' FROM e WHERE event_id % 4 = 2 UNION ALL SELECT event_id, 'more', NULL, '{}' FROM e WHERE event_id % 4 = 3""")
def json_deep_diff(t):
    """Differing leaves of nested records: changed, missing and new ones by turns; what differs from run to run doesn't count."""
    k, m = F.get_json_object("props", "$.k"), F.col("event_id") % 4
    made = lambda number, inner, tail, more: F.concat(F.lit('{"a":{"k":'), number, F.lit(',"deep":[[1,{"b":'), number, F.lit("}],"), inner, F.lit(']},"run_at":'), F.rand().cast("string"), F.lit(',"list":["'), F.col("event_type"), F.lit('"'), tail, F.lit("]"), more, F.lit("}"))
    old = made(k, F.lit("[]"), F.lit(',"x"'), F.lit(""))
    new = made(F.when(m == 1, (k.cast("int") + 1).cast("string")).otherwise(k), F.when(m == 2, "[[]]").otherwise("[]"), F.when(m == 2, "").otherwise(',"x"'), F.when(m == 3, ',"more":{}').otherwise(""))
    return json_diff.changes(t.events.select("event_id", old.alias("old"), new.alias("new")), "event_id", "old", "new")


@query("""WITH r AS (SELECT event_id, unnest([{'c': 'related', 'r': event_id + 1}, {'c': 'related', 'r': event_id * 2}, {'c': 'parent', 'r': CASE WHEN event_id % 7 <> 0 THEN event_id - event_id % 7 END}]) AS x FROM events WHERE event_id % 11 <> 0)
SELECT DISTINCT event_id, x.c AS "column", x.r AS reference, CASE WHEN x.r IN (SELECT event_id FROM events) THEN 'removed' ELSE 'missing' END AS reason FROM r WHERE x.r IS NOT NULL AND x.r NOT IN (SELECT event_id FROM events WHERE event_id % 11 <> 0)""")
def dangling_references(t):
    """References of kept events to events that were removed or never were."""
    k = F.col("event_id")
    rows = t.events.where("event_id % 11 <> 0").select("event_id", F.array(k + 1, k * 2, k + 1, F.lit(None)).alias("related"), F.when(k % 7 != 0, k - k % 7).alias("parent"))
    return references.dangling(rows, "event_id", ["related", "parent"], t.events.where("event_id % 11 = 0").select("event_id"))


@query("""WITH v AS (SELECT doc_id, text, doc_id % 9 = 1 AS money, [substr(text, 4, 9), substr(text, 30, 20), CASE doc_id % 5 WHEN 0 THEN 'not in any text' WHEN 1 THEN '' ELSE right(text, 6) END] AS items FROM documents)
SELECT doc_id, CASE WHEN NOT money AND list_bool_and(list_transform(items, lambda x: trim(x, ' ') <> '' AND contains(text, x))) THEN list_transform(items, lambda x: {'start': instr(text, x)::INTEGER - 1, 'stop': instr(text, x)::INTEGER - 1 + length(x)::INTEGER, 'quote': x}) ELSE [] END AS spans FROM v""")
def value_evidence(t):
    """Where the values of a row stand in its text: all of them, or none."""
    m, text = F.col("doc_id") % 5, F.col("text")
    values = F.array(F.substring("text", 4, 9), F.substring("text", 30, 20), F.when(m == 0, "not in any text").when(m == 1, "").otherwise(F.right(text, F.lit(6))))
    return t.documents.select("doc_id", references.evidence(text, values, F.when(F.col("doc_id") % 9 == 1, "money").otherwise("free_text")).alias("spans"))


@query("""SELECT conv_id, turn, CASE WHEN turn % 5 = 0 THEN 'header' WHEN turn % 5 IN (1, 2) THEN 'subject' WHEN turn % 5 = 3 THEN 'family' ELSE 'single' END AS group_kind,
  CASE WHEN turn % 5 = 0 THEN 'h' || conv_id WHEN turn % 5 IN (1, 2) THEN 's' || conv_id % 3 WHEN turn % 5 = 3 THEN 'f' || role END AS group_id FROM conversations""")
def grouping_precedence(t):
    m, c = F.col("turn") % 5, F.col("conv_id")
    rows = t.conversations.select("conv_id", "turn", c.alias("custodian"), F.when(m == 0, F.concat(F.lit("h"), c.cast("string"))).alias("h"), F.when(m.isin(0, 1, 2), F.concat(F.lit("s"), (c % 3).cast("string"))).alias("s"), F.when(m.isin(2, 3), F.concat(F.lit("f"), "role")).alias("f"))
    return review.precedence(rows, "h", "s", "f").select("conv_id", "turn", "group_kind", "group_id")
