"""Queries of cell rules. Cells are written from the tables' values, the same way in both forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.functions import cells as C
from corpuslens.functions import exprs as X
from corpuslens.operators import release, review
from corpuslens.plans.base import query
from corpuslens.plans.release import _RULE

_WORDS = "regexp_extract_all(lower(text), '[a-z]+')"
_CELLS = f"""SELECT 'd' || doc_id AS k, CASE doc_id % 3 WHEN 0 THEN 'list' ELSE 'keywords' END AS kind, CASE WHEN doc_id % 11 = 0 THEN '"' || lang || '"' WHEN doc_id % 11 = 1 THEN '["a", "", "b"]' WHEN doc_id % 11 = 2 THEN '[1, 2, 3]' WHEN doc_id % 11 = 3 THEN '["a"' ELSE to_json({_WORDS}[1:(n_chars % 11)::INTEGER])::VARCHAR END AS v FROM documents
UNION ALL SELECT 'o' || o_orderkey, 'date', CASE WHEN o_orderkey % 9 = 0 THEN 'N/A' ELSE year(o_orderdate) || '-' || month(o_orderdate) || '-' || (day(o_orderdate) + 2) END FROM orders
UNION ALL SELECT 'p' || o_orderkey, 'vocabulary', CASE WHEN o_orderkey % 9 = 0 THEN ' NaN' WHEN o_orderkey % 9 = 1 THEN o_orderpriority || chr(8232) ELSE o_orderpriority END FROM orders
UNION ALL SELECT 'c' || c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'amount' WHEN 1 THEN 'score' WHEN 2 THEN 'share' ELSE 'text' END, CASE c_custkey % 4 WHEN 0 THEN '$' || CASE WHEN c_custkey % 12 = 0 THEN c_mktsegment ELSE c_acctbal::DECIMAL(12, 2)::VARCHAR END WHEN 3 THEN substr(c_mktsegment, 1, (c_nationkey % 3 + 1)::INTEGER) ELSE ((c_acctbal - 4500) / 3000)::DECIMAL(12, 4)::VARCHAR END FROM customer"""
VOCABULARY = ["1-URGENT", "3-MEDIUM"]


@query(f"""WITH c AS ({_CELLS}), j AS (SELECT *, json_type(try_cast(v AS JSON)) AS t, json_extract_string(try_cast(v AS JSON), '$[*]') AS items, list_transform(json_extract(try_cast(v AS JSON), '$[*]'), lambda x: json_type(x)) AS kinds,
  try_cast(replace(replace(v, '$', ''), ',', '') AS DOUBLE) AS n FROM c)
SELECT k, CASE WHEN regexp_matches(v, '[\\x{{2028}}\\x{{2029}}\\x{{85}}]') THEN 'line_boundary' WHEN lower(trim(v)) IN ('nan', 'none', 'null') THEN 'placeholder'
  WHEN kind IN ('keywords', 'list') THEN CASE WHEN t IS DISTINCT FROM 'ARRAY' THEN 'not_a_list' WHEN kind = 'keywords' AND len(items) NOT BETWEEN 3 AND 8 THEN 'list_length'
    WHEN len(list_filter(kinds, lambda x: x <> 'VARCHAR')) > 0 OR len(list_filter(items, lambda x: trim(x) = '')) > 0 THEN 'bad_entry' WHEN kind = 'keywords' AND len(list_distinct(items)) < len(items) THEN 'duplicate_entry' END
  WHEN kind = 'date' THEN CASE WHEN v <> 'N/A' AND try_strptime(v, '%Y-%m-%d') IS NULL THEN 'bad_date' END WHEN kind = 'vocabulary' THEN CASE WHEN v NOT IN ('1-URGENT', '3-MEDIUM') THEN 'outside_vocabulary' END
  WHEN kind = 'text' THEN CASE WHEN length(v) < 2 THEN 'too_short' END WHEN n IS NULL THEN 'not_a_number' WHEN (kind = 'amount' AND n < 0) OR (kind = 'score' AND abs(n) > 1) OR (kind = 'share' AND n NOT BETWEEN 0 AND 1) THEN 'outside_range' END AS problem FROM j""")
def cell_problems(t):
    """The first problem of each cell, over cells of eight kinds."""
    i, text = F.col("doc_id"), F.to_json(F.slice(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)), F.lit(1), (F.col("n_chars") % 11).cast("int")))
    lists = F.when(i % 11 == 0, F.concat(F.lit('"'), "lang", F.lit('"'))).when(i % 11 == 1, '["a", "", "b"]').when(i % 11 == 2, "[1, 2, 3]").when(i % 11 == 3, '["a"').otherwise(text)
    made = t.documents.select(F.concat(F.lit("d"), i.cast("string")).alias("k"), F.when(i % 3 == 0, "list").otherwise("keywords").alias("kind"), lists.alias("v"))
    o, day = F.col("o_orderkey"), F.col("o_orderdate")
    date = F.when(o % 9 == 0, "N/A").otherwise(F.concat_ws("-", F.year(day).cast("string"), F.month(day).cast("string"), (F.day(day) + 2).cast("string")))
    word = F.when(o % 9 == 0, " NaN").when(o % 9 == 1, F.concat("o_orderpriority", F.lit("\u2028"))).otherwise(F.col("o_orderpriority"))
    for tag, kind, v in (("o", "date", date), ("p", "vocabulary", word)):
        made = made.unionByName(t.orders.select(F.concat(F.lit(tag), o.cast("string")).alias("k"), F.lit(kind).alias("kind"), v.alias("v")))
    c = F.col("c_custkey")
    amount = F.concat(F.lit("$"), F.when(c % 12 == 0, F.col("c_mktsegment")).otherwise(F.col("c_acctbal").cast("decimal(12,2)").cast("string")))
    share = ((F.col("c_acctbal") - 4500) / 3000).cast("decimal(12,4)").cast("string")
    v = F.when(c % 4 == 0, amount).when(c % 4 == 3, F.substring(F.col("c_mktsegment"), F.lit(1), (F.col("c_nationkey") % 3 + 1).cast("int"))).otherwise(share)
    kind = F.when(c % 4 == 0, "amount").when(c % 4 == 1, "score").when(c % 4 == 2, "share").otherwise("text")
    made = made.unionByName(t.customer.select(F.concat(F.lit("c"), c.cast("string")).alias("k"), kind.alias("kind"), v.alias("v")))
    return made.select("k", C.cell_problem(F.col("kind"), F.col("v"), VOCABULARY).alias("problem"))


@query("""SELECT c_custkey, CASE WHEN k = 1 THEN round(c_acctbal, 2) END AS amount, CASE WHEN k = 4 THEN [c_name, c_mktsegment] WHEN k = 5 THEN [c_name] END AS items, CASE WHEN k = 7 THEN DATE '2020-01-01' + c_nationkey END AS day, CASE WHEN k = 9 THEN c_name END AS value, k = 2 AS bad FROM (SELECT *, c_custkey % 11 AS k FROM customer)""")
def typed_cells(t):
    """String cells as amounts, lists, days and texts; N/A, empty cells and empty lists are none."""
    k, n = F.col("c_custkey") % 11, F.col("c_nationkey")
    kind = F.when(k < 4, "money").when(k < 7, "list").when(k < 9, "date").otherwise("text")
    text = (
        F.when(k == 0, "n/a").when(k == 1, F.concat(F.lit("$"), F.col("c_acctbal").cast("decimal(12,2)").cast("string"))).when(k == 2, F.translate("c_mktsegment", "0123456789", "")).when(k == 3, "  ")
        .when(k == 4, F.to_json(F.array("c_name", F.lit(" "), "c_mktsegment"))).when(k == 5, F.col("c_name")).when(k == 6, "[]")
        .when(k == 7, F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), n), "MMMM d, yyyy")).when(k == 8, "N/A").when(k == 9, F.col("c_name")).otherwise("")
    )
    return t.customer.select("c_custkey", C.typed_cell(kind, text).alias("x")).select("c_custkey", "x.*")


@query("""WITH m AS (SELECT d.doc_id, lang, source, l.quality, list_filter([CASE WHEN l.quality IS NOT NULL THEN 'quality' END, 'toxic', CASE WHEN n_chars % 2 = 1 THEN 'entity' END, CASE WHEN d.doc_id % 4 = 1 THEN 'board' END, CASE WHEN d.doc_id % 5 = 2 THEN 'bylaws' END, CASE WHEN d.doc_id % 7 = 3 THEN 'mood' END], lambda k: k IS NOT NULL) AS keys FROM documents d LEFT JOIN labels l USING (doc_id)),
x AS (SELECT *, list_filter(keys, lambda k: k IN ('entity', 'board', 'bylaws')) AS more FROM m)
SELECT doc_id, list_sort(list_transform(list_filter(keys, lambda k: k = 'mood'), lambda k: 'unknown:' || k) || list_filter([CASE WHEN NOT list_contains(keys, 'quality') THEN 'missing:quality' END, CASE WHEN quality = 0 THEN 'bad-code:unlabeled' END], lambda k: k IS NOT NULL)
  || CASE WHEN lang <> 'en' THEN list_transform(more, lambda k: 'misplaced:' || k) ELSE list_transform(list_filter(more, lambda k: k <> 'entity' AND NOT (source = 'src0' AND k = 'board') AND NOT (source = 'src1' AND k = 'bylaws')), lambda k: 'foreign:' || k) END) AS problems FROM x""")
def presence_key_law(t):
    """Presence maps held to the law of their keys and codes; English rows may be extended."""
    rows = t.documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    i = F.col("doc_id")
    code = F.when(F.col("quality") == 0, "unlabeled").otherwise("populated")
    keys = {"quality": F.col("quality").isNotNull(), "toxic": F.lit(True), "entity": F.col("n_chars") % 2 == 1, "board": i % 4 == 1, "bylaws": i % 5 == 2, "mood": i % 7 == 3}
    presence = F.map_from_entries(F.array_compact(F.array(*[F.when(has, F.struct(F.lit(k).alias("key"), code.alias("value"))) for k, has in keys.items()])))
    problems = C.presence_problems(presence, F.col("lang"), F.col("source"), ["quality", "toxic"], ["entity"], {"src0": ["board"], "src1": ["bylaws"]}, "en", ["populated", "gap"])
    return rows.select("doc_id", problems.alias("problems"))


@query("""WITH p AS (SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'click' ELSE 'view' END AS original, event_type AS a, CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS b, value / 100 AS sa, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / 50 END AS sb FROM events),
r AS (SELECT event_id, a, CASE WHEN a NOT IN ('click', 'view', 'purchase') OR b NOT IN ('click', 'view', 'purchase') THEN 'out of vocabulary' WHEN a <> b THEN 'passes disagree' WHEN a = original THEN 'confirms' WHEN least(sa, coalesce(sb, 0)) >= 0.8 THEN 'confident change' ELSE 'unsure change' END AS reason FROM p)
SELECT event_id, reason IN ('confirms', 'confident change') AS accepted, CASE WHEN reason IN ('confirms', 'confident change') THEN a ELSE '' END AS label, reason FROM r""")
def two_pass_labels(t):
    i = F.col("event_id")
    original, b = F.when(F.col("user_id") % 2 == 0, "click").otherwise("view"), F.when(i % 3 == 0, "view").otherwise(F.col("event_type"))
    x = C.two_pass_label(original, F.col("event_type"), b, F.col("value") / 100, F.when(i % 5 != 0, F.col("value") / 50), ["click", "view", "purchase"], 0.8)
    return t.events.select("event_id", x.alias("x")).select("event_id", "x.*")


@query("""WITH a AS (SELECT doc_id, lang, CASE source WHEN 'src0' THEN 'en' WHEN 'src1' THEN 'de' END AS implied, [lang, CASE WHEN doc_id % 3 = 0 THEN 'de' ELSE lang END, CASE WHEN n_chars % 4 = 0 THEN 'fr' ELSE lang END, CASE WHEN n_chars % 4 = 0 THEN 'fr' ELSE lang END] AS given FROM documents),
r AS (SELECT doc_id, lang, implied, CASE WHEN doc_id % 10 = 0 THEN given[2:4] WHEN doc_id % 10 = 1 THEN ['es', 'es', 'es', 'es'] WHEN doc_id % 10 = 2 THEN ['es', 'es', 'it', 'es'] ELSE given END AS ans FROM a),
d AS (SELECT *, CASE WHEN len(ans) = 4 AND len(list_distinct(ans)) = 1 THEN CASE WHEN implied IS NOT NULL AND ans[1] <> implied THEN 'adjudicate' WHEN ans[1] = lang THEN 'confirm' ELSE 'change' END WHEN (implied IS NOT NULL AND lang <> implied) OR NOT list_contains(ans, lang) THEN 'adjudicate' ELSE 'keep' END AS decision FROM r)
SELECT doc_id, decision, CASE decision WHEN 'adjudicate' THEN '' WHEN 'keep' THEN lang ELSE ans[1] END AS label FROM d""")
def four_answer_labels(t):
    i, lang = F.col("doc_id"), F.col("lang")
    two = F.when(F.col("n_chars") % 4 == 0, "fr").otherwise(lang)
    given = F.array(lang, F.when(i % 3 == 0, "de").otherwise(lang), two, two)
    fixed = lambda *names: F.array(*map(F.lit, names))
    answers = F.when(i % 10 == 0, F.slice(given, 2, 3)).when(i % 10 == 1, fixed("es", "es", "es", "es")).when(i % 10 == 2, fixed("es", "es", "it", "es")).otherwise(given)
    implied = F.when(F.col("source") == "src0", "en").when(F.col("source") == "src1", "de")
    return t.documents.select("doc_id", C.four_answer_label(lang, implied, answers).alias("x")).select("doc_id", "x.*")


_SHARE = "len(list_filter(regexp_extract_all(lower({0}), '[a-z0-9]+'), lambda w: list_contains(regexp_extract_all(lower({1}), '[a-z0-9]+'), w))) / greatest(1, len(regexp_extract_all(lower({0}), '[a-z0-9]+')))::DOUBLE"


@query(f"""WITH r AS (SELECT lang, quality, {_SHARE.format("substr(text, 1, 100)", "substr(text, (doc_id % 40 + 1)::INTEGER, 400)")} >= 0.8 AS ok FROM labels JOIN documents USING (doc_id)),
c AS (SELECT lang, count(*) AS gold, count(*) FILTER (WHERE quality <> 1) AS not_accepted, count(*) FILTER (WHERE quality = 1 AND ok) AS correct, count(*) FILTER (WHERE quality = 1 AND NOT ok) AS wrong FROM r GROUP BY lang)
SELECT *, CASE WHEN correct + wrong > 0 THEN round(correct / (correct + wrong)::DOUBLE, 4) END AS accuracy, correct + wrong >= 5 AS gated FROM c""")
def gold_span_accuracy(t):
    """Accepted values against gold spans: right with 80 % of the words in the span; gated from five on."""
    value, gold = F.substring("text", 1, 100), F.substring(F.col("text"), (F.col("doc_id") % 40 + 1).cast("int"), F.lit(400))
    rows = t.labels.join(t.documents, "doc_id").select("lang", (F.col("quality") == 1).alias("accepted"), (C.token_share(value, gold) >= 0.8).alias("ok"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("gold"), F.count_if(~F.col("accepted")).alias("not_accepted"), F.count_if(F.col("accepted") & F.col("ok")).alias("correct"), F.count_if(F.col("accepted") & ~F.col("ok")).alias("wrong"))
    n = F.col("correct") + F.col("wrong")
    return counts.withColumn("accuracy", F.when(n > 0, F.round(F.col("correct") / n, 4))).withColumn("gated", n >= 5)


TERMS = ["is", "of the", "that", "den", "une", "license", "token", "el", "re"]


@query(f"""WITH q AS (SELECT doc_id, source || '_kind' AS sub, '"' || lang || ' one" and "' || source || '" ' || text AS text FROM documents),
f AS (SELECT doc_id, sub, list_transform(regexp_extract_all(text, '"([^"]{{3,40}})"', 1)[1:3], lambda x: trim(x)) AS quoted, list_transform(regexp_extract_all(regexp_replace(lower(text), '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g'), '(?:^|[^\\p{{L}}\\p{{N}}_])({'|'.join(TERMS).replace(' ', '  ')})(?:$|[^\\p{{L}}\\p{{N}}_])', 1), lambda x: replace(x, '  ', ' ')) AS found FROM q)
SELECT doc_id, ([replace(sub, '_', ' ')] || quoted || list_filter(found, lambda x, i: list_position(found, x) = i))[1:8] AS words FROM f""")
def document_keywords(t):
    """Up to eight keywords: the subclass, quoted phrases, and terms by first occurrence."""
    text = F.concat(F.lit('"'), "lang", F.lit(' one" and "'), "source", F.lit('" '), "text")
    return t.documents.select("doc_id", C.keywords(text, F.concat("source", F.lit("_kind")), TERMS).alias("words"))


_TARGET = "sha256(c_name || chr(10) || field || CASE WHEN seen THEN '' ELSE 'old' END)"


@query(f"""WITH rec AS (SELECT c_custkey AS doc_id, field, {_TARGET.replace('seen', 'TRUE')} AS target FROM customer, (SELECT DISTINCT event_type AS field FROM events)),
j AS (SELECT user_id AS doc_id, event_type AS field, event_id, {_TARGET.replace('seen', 'event_id % 4 <> 0').replace('field', 'event_type')} AS seen, CASE WHEN event_id % 3 = 0 THEN 'REJECT' ELSE 'ACCEPT' END AS decision, event_id % 5 < 2 AS confirmed, CASE WHEN event_id % 7 < 3 THEN 'no field' ELSE '' END AS blocker
  FROM events JOIN customer ON c_custkey = user_id QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1)
SELECT rec.doc_id, rec.field, CASE WHEN j.seen IS DISTINCT FROM target THEN 'awaiting_review' WHEN confirmed THEN CASE WHEN event_id % 2 = 0 THEN 'checkpointed' ELSE 'human_confirmed' END WHEN blocker <> '' AND decision = 'ACCEPT' THEN 'reviewed_needs_schema' ELSE 'changes_requested' END AS status,
  CASE WHEN j.seen = target THEN decision ELSE 'NOT_REVIEWED' END AS decision, j.seen IS NOT NULL AND j.seen <> target AS stale FROM rec LEFT JOIN j USING (doc_id, field)""")
def review_states(t):
    """The state of each customer's fields by its last event, which counts while its target is the same."""
    names = t.customer.select(F.col("c_custkey").alias("doc_id"), "c_name")
    fields = t.events.select(F.col("event_type").alias("field")).distinct().agg(F.collect_set("field").alias("fields"))  # one row a kind of event
    target = lambda tail: F.sha2(F.concat(F.concat_ws("\n", "c_name", "field"), tail), 256)
    records = names.join(F.broadcast(fields), F.lit(True)).withColumn("field", F.explode("fields")).select("doc_id", "field", target(F.lit("")).alias("target_sha"))
    i = F.col("event_id")
    seen = t.events.select("event_id", F.col("user_id").alias("doc_id"), F.col("event_type").alias("field")).join(names, "doc_id")
    journal = seen.select("doc_id", "field", "event_id", target(F.when(i % 4 != 0, "").otherwise("old")).alias("target_sha"), F.when(i % 3 == 0, "REJECT").otherwise("ACCEPT").alias("decision"), (i % 5 < 2).alias("confirmed"), F.when(i % 7 < 3, "no field").otherwise("").alias("blocker"))
    return review.review_states(records, journal, t.events.where("event_id % 2 = 0").select("event_id"))


@query("""WITH j AS (SELECT user_id, event_type, event_id, event_type = 'error' OR event_id % 6 = 0 AS error, event_id % 5 = 0 AS own, sha256(event_type || CASE WHEN event_id % 4 = 0 THEN 'old' ELSE '' END) AS input FROM events), w AS (SELECT DISTINCT user_id, event_type, sha256(event_type) AS input FROM events)
SELECT user_id, event_type, input, min(event_id) AS event_id FROM j WHERE NOT error AND NOT own AND (user_id, event_type, input) IN (SELECT (user_id, event_type, input) FROM w) AND (user_id, event_type, input) NOT IN (SELECT (user_id, event_type, input) FROM j WHERE own AND NOT error) GROUP BY ALL""")
def answer_reuse(t):
    """Answers of other journals that have the same configuration and input, for what isn't answered yet."""
    i = F.col("event_id")
    sha = lambda tail: F.sha2(F.concat("event_type", tail), 256).alias("input")
    journal = t.events.select("user_id", "event_type", "event_id", ((F.col("event_type") == "error") | (i % 6 == 0)).alias("error"), (i % 5 == 0).alias("own"), sha(F.when(i % 4 == 0, "old").otherwise("")))
    wanted = t.events.select("user_id", "event_type", sha(F.lit(""))).distinct()
    return review.reusable(wanted, journal, ["user_id", "event_type", "input"])


_PROVENANCE = "CASE doc_id % 7 WHEN 0 THEN 'gold:expert' WHEN 1 THEN 'deterministic:' || lang WHEN 2 THEN 'llm:m1+m2' WHEN 3 THEN 'override:relabel:m1' WHEN 4 THEN 'override:' || source WHEN 5 THEN 'reviewer:' || lang END"


@query(f"""WITH p AS (SELECT lang, {_PROVENANCE} AS p FROM documents JOIN labels USING (doc_id))
SELECT lang, CASE WHEN starts_with(p, 'override:relabel:') OR starts_with(p, 'llm') THEN 'llm' WHEN regexp_matches(p, '^(override|reviewer):') THEN 'reviewer' ELSE coalesce(regexp_extract(p, '^(gold|deterministic)'), 'none') END AS kind, count(*) AS n FROM p GROUP BY ALL""")
def provenance_kinds(t):
    """Values by who made them."""
    i = F.col("doc_id") % 7
    made = F.when(i == 0, "gold:expert").when(i == 1, F.concat(F.lit("deterministic:"), "lang")).when(i == 2, "llm:m1+m2").when(i == 3, "override:relabel:m1").when(i == 4, F.concat(F.lit("override:"), "source")).when(i == 5, F.concat(F.lit("reviewer:"), "lang"))
    rows = t.documents.select("doc_id", "lang", "source").join(t.labels.select("doc_id"), "doc_id")
    return rows.select("lang", C.provenance_kind(made).alias("kind")).groupBy("lang", "kind").agg(F.count("*").alias("n"))


@query(f"""WITH b AS (SELECT doc_id AS name, {_RULE.format('doc_id')} AS rule, CASE WHEN n_chars % 8 = 0 THEN 'train' ELSE {_RULE.format('doc_id')} END AS split, CASE WHEN source = 'src0' THEN '' ELSE upper(lang) || ' ' END AS kind FROM documents WHERE doc_id % 10 <> 3 UNION ALL SELECT doc_id, {_RULE.format('doc_id')}, {_RULE.format('doc_id')}, lang FROM documents WHERE doc_id % 50 = 0 AND source <> 'src0' AND n_chars % 8 <> 0),
t AS (SELECT doc_id AS name, {_RULE.format('doc_id')} AS rule, {_RULE.format('doc_id')} AS split, CASE WHEN n_chars % 3 = 0 THEN 'en' ELSE lang END AS kind FROM documents WHERE doc_id % 10 <> 4),
bn AS (SELECT name, any_value(split) AS split, min(kind) AS kind FROM b GROUP BY name), x AS (SELECT bn.name AS bn, t.name AS tn, bn.split AS bs, t.split AS ts, bn.kind AS bk, t.kind AS tk FROM bn FULL JOIN t USING (name))
SELECT f.fact, f.value::BIGINT AS value FROM (SELECT count(bn) AS c, count(tn) AS d, count(*) FILTER (WHERE tn IS NULL) AS e, count(*) FILTER (WHERE bn IS NULL) AS f, count(*) FILTER (WHERE bs <> ts) AS g, count(*) FILTER (WHERE tn IS NOT NULL AND trim(bk) <> '') AS h, count(*) FILTER (WHERE trim(bk) <> '' AND lower(trim(bk)) = lower(trim(tk))) AS i FROM x),
LATERAL (VALUES ('blind_rows', (SELECT count(*) FROM b)), ('truth_rows', (SELECT count(*) FROM t)), ('blind_names', c), ('truth_names', d), ('only_blind', e), ('only_truth', f), ('splits_differ', g), ('blind_rule_mismatches', (SELECT count(*) FROM b WHERE split <> rule)), ('truth_rule_mismatches', 0), ('kinds_filled', h), ('kinds_agree', i)) f(fact, value)""")
def config_audit(t):
    """Two configurations of a release held to each other: names, splits, the split rule, kinds."""
    i, rule = F.col("doc_id"), X.split_of(F.col("doc_id"))
    split = F.when(F.col("n_chars") % 8 == 0, "train").otherwise(rule)
    kind = F.when(F.col("source") == "src0", "").otherwise(F.concat(F.upper("lang"), F.lit(" ")))
    blind = t.documents.where(i % 10 != 3).select(i.alias("name"), split.alias("split"), kind.alias("kind"))
    again = t.documents.where("doc_id % 50 = 0 and source <> 'src0' and n_chars % 8 <> 0").select(i.alias("name"), rule.alias("split"), F.col("lang").alias("kind"))
    truth = t.documents.where(i % 10 != 4).select(i.alias("name"), rule.alias("split"), F.when(F.col("n_chars") % 3 == 0, "en").otherwise(F.col("lang")).alias("kind"))
    return release.config_audit(blind.unionByName(again), truth)


@query("""SELECT doc_id, CASE WHEN quality IS NOT NULL THEN quality::VARCHAR WHEN len(regexp_extract_all(lower(text), '\\b(token|license|version)\\b')) > len(regexp_extract_all(lower(text), '\\b(?:no|not|without)\\s+(?:[a-z]+\\s+){0,2}(token|license|version)\\b')) THEN 'technical' WHEN lang = 'en' THEN 'written by ' || source ELSE '' END AS purpose FROM documents LEFT JOIN labels USING (doc_id)""")
def completion_fills(t):
    """Empty cells filled by a rule on words that aren't negated, else by a template; others stay."""
    rows = t.documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    technical = F.when(C.mentioned(F.col("text"), "(token|license|version)"), "technical")
    template = F.when(F.col("lang") == "en", F.concat(F.lit("written by "), "source"))
    return rows.select("doc_id", C.fill(F.col("quality").cast("string"), technical, template).alias("purpose"))


_W = "list_distinct(regexp_extract_all(lower({0}), '[a-z0-9]+'))"
_JACCARD = f"(len(list_intersect({_W.format('a')}, {_W.format('b')})) / len(list_distinct({_W.format('a')} || {_W.format('b')}))::DOUBLE)"


@query(f"""WITH c AS (SELECT c_custkey, c_custkey % 8 AS k, c_nationkey % 4 AS m, c_name, c_mktsegment AS s, c_acctbal::DECIMAL(12, 2) AS bal FROM customer),
v AS (SELECT c_custkey, k, m, bal, CASE k WHEN 0 THEN s WHEN 1 THEN c_name WHEN 2 THEN c_name || ' deals in ' || lower(s) WHEN 7 THEN '' END AS a,
  CASE k WHEN 0 THEN CASE WHEN m = 0 THEN s || 'x' ELSE ' ' || lower(s) || '.' END WHEN 1 THEN c_name || [' Inc.', ', of the north', ' (1) (2) (3)', ''][m + 1] WHEN 2 THEN [c_name, c_name || ' deals', c_name || ' deals in', lower(s) || ' in ' || c_name][m + 1] WHEN 7 THEN CASE WHEN m = 0 THEN s END END AS b FROM c)
SELECT c_custkey, CASE k WHEN 0 THEN regexp_replace(lower(a), '[^a-z0-9]', '', 'g') = regexp_replace(lower(b), '[^a-z0-9]', '', 'g') WHEN 1 THEN {_JACCARD} >= 0.5 AND len(list_intersect({_W.format('a')}, {_W.format('b')})) = least(len({_W.format('a')}), len({_W.format('b')})) WHEN 2 THEN {_JACCARD} >= 0.6
  WHEN 3 THEN m < 2 WHEN 4 THEN m <> 0 WHEN 5 THEN m <> 3 WHEN 6 THEN m = 1 ELSE b IS NULL END AS agree FROM v""")
def typed_agreement(t):
    """Two raters' cells of eight kinds, by each kind's own measure."""
    k, m, name, s = F.col("c_custkey") % 8, F.col("c_nationkey") % 4, F.col("c_name"), F.col("c_mktsegment")
    pick = lambda *options: F.get(F.array(*options), m)
    by = lambda *options: F.coalesce(*[F.when(k == n, c) for n, c in enumerate(options)])
    day = F.date_add(F.lit("2021-03-01").cast("date"), (F.col("c_custkey") % 300).cast("int"))
    cents = F.concat(F.lit("$"), F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    more = F.concat(F.lit("USD "), (F.col("c_acctbal").cast("decimal(12,2)") + (m >= 2).cast("int")).cast("string"))
    listed = lambda *names: F.to_json(F.array(*[c if not isinstance(c, str) else F.lit(c) for c in names]))
    tail = lambda x: F.concat(name, F.lit(x))
    lower = F.lower(s)
    a = by(s, name, F.concat(name, F.lit(" deals in "), lower), cents, F.date_format(day, "yyyy-MM-dd"), listed("A b", "c", "d", "e", name), F.concat(F.lit("x-"), name), F.lit(""))
    b = by(
        F.when(m == 0, F.concat(s, F.lit("x"))).otherwise(F.concat(F.lit(" "), lower, F.lit("."))), pick(tail(" Inc."), tail(", of the north"), tail(" (1) (2) (3)"), name),
        pick(name, tail(" deals"), tail(" deals in"), F.concat(lower, F.lit(" in "), name)), more, pick(F.lit("soon"), F.date_format(day, "M/d/yyyy"), F.date_format(day, "MMMM d, yyyy"), F.date_format(day, "yyyy-MM-dd")),
        pick(listed(name, "a  B", "C", "d.", "E"), listed("a b", "c", "d", "e"), listed("a b", "c", "d", "e", name, "f"), listed("a b", "c", "d")), pick(F.lit("x"), F.concat(F.lit("X "), name), F.lit(""), F.upper(name)), F.when(m == 0, s),
    )
    kind = F.get(F.array(*map(F.lit, ("label", "name", "free_text", "money", "date", "list", "id", "name"))), k)
    rows = t.customer.select("c_custkey", kind.alias("kind"), a.alias("a"), b.alias("b"))
    return rows.select("c_custkey", C.agrees(F.col("kind"), F.col("a"), F.col("b")).alias("agree"))


@query("""WITH o AS (SELECT o_orderkey, o_orderkey % 8 AS k, o_totalprice::DECIMAL(14, 2) AS p, o_orderdate::DATE AS d, o_orderpriority AS w FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE WHEN 3 THEN FALSE WHEN 4 THEN TRUE WHEN 5 THEN TRUE WHEN 6 THEN w = '5-LOW' ELSE FALSE END AS grounded FROM o""")
def value_grounding(t):
    """Whether each order's note supports a value said of it: amounts, dates, names, free text."""
    k, price, day = F.col("o_orderkey") % 8, F.col("o_totalprice").cast("decimal(14,2)"), F.to_date("o_orderdate")
    text = F.concat(F.lit("Total **due** "), F.format_number(price, 2), F.lit(" on "), F.date_format(day, "MMMM d, yyyy"), F.lit(", in  the spring; priority "), "o_orderpriority")
    by = lambda *options: F.coalesce(*[F.when(k == n, c) for n, c in enumerate(options)])
    value = by(
        F.concat(F.lit("$"), price.cast("string")), F.concat(F.lit("$"), (price + 1).cast("string")), F.date_format(day, "yyyy-MM-dd"), F.date_format(F.date_add(day, 1), "yyyy-MM-dd"),
        F.concat(F.lit("DUE "), F.format_number(price, 2)), F.lit("the spring total, say"), F.lit("5 low"), F.lit("in the spring"),
    )
    kind = F.get(F.array(*map(F.lit, ("money", "money", "date", "date", "date", "free_text", "name", "date"))), k)
    rows = t.orders.select("o_orderkey", kind.alias("kind"), value.alias("value"), text.alias("text"))
    return rows.select("o_orderkey", C.grounded(F.col("kind"), F.col("value"), F.col("text"), X.dates_in("text")).alias("grounded"))
