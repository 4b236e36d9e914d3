"""Queries of repaired labels, families of spellings, spans by category and counts of labels on two surfaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators import relabel, release, spans
from corpuslens.operators.relabel import Kind
from corpuslens.plans.base import query

KINDS = [
    Kind("bylaws", "Bylaws", "rules", "govern", r"\bby-?laws\b", ("address",)),
    Kind("charter", "Charter", "founding", "form", r"\b(?:charter|articles)\b", ("address", "state")),
    Kind("minutes", "Board minutes", "meeting", "decide", r"\bminutes\b", ("date",)),
    Kind("power_of_attorney", "Power of attorney", "authority", "authorise", r"\bpowers? of attorney\b", ("address", "date")),
    Kind("other", "Corporate record", "record", "file"),
]
CORE = ["address", "date", "state"]

_REGISTRY = "(VALUES " + ", ".join(f"('{k.name}', '{k.phrase}', '{k.record_type}', '{k.intent}', {repr(k.cue) if k.cue else 'NULL'}, {list(k.applicable)}::VARCHAR[])".replace("\\\\", "\\") for k in KINDS) + ") g(kind, phrase, rtype, gintent, cue, applies)"
#: The rows to repair, in words that both engines read.
_ROWS = """SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'bylaws' WHEN 1 THEN 'Charter' WHEN 2 THEN 'mi_nutes' ELSE 'unknown thing' END AS subclass,
 CASE c_custkey % 11 WHEN 0 THEN concat('Bylaws of ', c_name, ' (CIK 123) (SEC EDGAR exhibit 3.1)') WHEN 1 THEN concat('Charter of ', c_name, ' /DE/ (ABCD) (CIK 77) (SEC EDGAR exhibit 3.2)')
  WHEN 2 THEN concat('Minutes of ', c_name, ' (UK) (CIK 5) (SEC EDGAR exhibit)') WHEN 3 THEN 'The Charter of a company' WHEN 4 THEN 'Minutes and charter' WHEN 5 THEN 'By-laws as amended'
  WHEN 6 THEN concat('Minutes of ', c_name, ' (CIK 5)') WHEN 7 THEN '' WHEN 9 THEN 'A list of names' WHEN 10 THEN concat('Power of ', c_name, ' Inc. (XYZ.A) /NY/ (CIK 6) (SEC EDGAR exhibit 24)') END AS subject,
 CASE c_custkey % 5 WHEN 0 THEN array('EX-3.1', 'bylaws', 'Delaware') WHEN 1 THEN array('10-K', '0001234567-12-000123', 'merger') WHEN 3 THEN array('s-1/a', 'Minutes') WHEN 4 THEN array('Acme (CIK 42)', 'power of_attorney', c_name) END AS keywords,
 CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'rules' END AS record_type, CASE c_custkey % 3 WHEN 1 THEN 'govern' WHEN 2 THEN 'other' END AS intent,
 CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'heuristic' WHEN 2 THEN 'expert' WHEN 3 THEN 'expert' END AS intent_source,
 CASE WHEN c_custkey % 2 = 0 THEN 'x' ELSE '' END AS address, CASE WHEN c_custkey % 6 = 0 THEN 'populated' ELSE 'gap' END AS state_code FROM customer"""


@query(rf"""WITH r AS ({_ROWS.replace("array(", "list_value(")}), o AS (SELECT r.*, coalesce((SELECT kind FROM {_REGISTRY} WHERE replace(kind, '_', '') = regexp_replace(lower(subclass), '[^a-z0-9]', '', 'g')), 'other') AS own,
  contains(coalesce(subject, ''), '(SEC EDGAR exhibit') AS tmpl FROM r),
c AS (SELECT o.*, CASE WHEN tmpl THEN [] ELSE (SELECT coalesce(list(kind), []) FROM {_REGISTRY} WHERE regexp_matches(lower(subject), cue)) END AS cued,
  CASE WHEN tmpl THEN replace(replace(regexp_replace(replace(replace(regexp_extract(subject, '^\S+ of (.*) \(CIK \d+\) \(SEC EDGAR exhibit.*\)$', 1), '(UK)', '[UK]'), '(AG)', '[AG]'), '(\s*(/[A-Z][A-Z]/|\([A-Z][A-Z0-9.-]*\)))+$', ''), '[UK]', '(UK)'), '[AG]', '(AG)') END AS company FROM o),
m AS (SELECT c.*, len(cued) = 1 AND NOT list_contains(cued, own) AS moved FROM c), k AS (SELECT m.*, g.* FROM m JOIN {_REGISTRY} ON g.kind = CASE WHEN moved THEN cued[1] ELSE own END),
f AS (SELECT *, list_filter(keywords, lambda w: NOT regexp_full_match(lower(w), 'ex-.*|\d{{10}}-\d\d-\d{{6}}|8-k|s-1(/a)?|10-[kq](/a)?') AND NOT regexp_matches(w, '\(CIK \d+\)')) AS kept FROM k),
l AS (SELECT *, list_concat([phrase], list_filter(kept, lambda w: lower(replace(w, '_', ' ')) <> replace(kind, '_', ' '))) AS led FROM f),
n AS (SELECT *, CASE WHEN keywords IS NULL THEN NULL WHEN company IS NULL THEN kept WHEN list_contains(led, company) THEN led ELSE list_concat(led, [company]) END AS kws,
  CASE WHEN moved OR coalesce(record_type, '') NOT IN (SELECT rtype FROM {_REGISTRY}) THEN rtype ELSE record_type END AS rt, CASE WHEN coalesce(intent_source, '') IN ('', 'heuristic') THEN gintent ELSE intent END AS it FROM l)
SELECT id, CASE WHEN moved THEN kind ELSE subclass END AS subclass, company AS entity_name, CASE WHEN company IS NULL THEN subject ELSE phrase || ' of ' || rtrim(company, '.') || '.' END AS subject, array_to_string(kws, '|') AS keywords, rt AS record_type, it AS intent,
  array_to_string(list_filter(['address=' || CASE WHEN NOT list_contains(applies, 'address') AND address = '' THEN 'not_applicable' ELSE 'gap' END, CASE WHEN NOT list_contains(applies, 'date') THEN 'date=not_applicable' END, CASE WHEN company IS NOT NULL THEN 'entity_name=populated' END,
    'record_type=populated', 'state=' || CASE WHEN NOT list_contains(applies, 'state') AND state_code <> 'populated' THEN 'not_applicable' ELSE state_code END], lambda x: x IS NOT NULL), ',') AS presence,
  array_to_string(list_filter([CASE WHEN moved THEN 'subclass:' || own || '->' || kind END, CASE WHEN company IS NOT NULL THEN 'entity_name' END, CASE WHEN company IS NOT NULL THEN 'subject' END, CASE WHEN kws IS DISTINCT FROM keywords THEN 'keywords' END,
    CASE WHEN rt IS DISTINCT FROM record_type THEN 'record_type' END, CASE WHEN it IS DISTINCT FROM intent THEN 'intent:' || coalesce(intent, '') || '->' || it END], lambda x: x IS NOT NULL), ',') AS changes FROM n""")
def repaired_records(t):
    """Records of every kind of fault, repaired; maps and lists are joined into strings."""
    rows = t.spark.sql(_ROWS.replace("FROM customer", "FROM {customer}"), customer=t.customer).withColumn("entity_name", F.lit(None).cast("string"))
    rows = rows.withColumn("fields", F.create_map(F.lit("address"), "address")).withColumn("presence", F.create_map(F.lit("address"), F.lit("gap"), F.lit("state"), "state_code", F.lit("record_type"), F.lit("gap")))
    out = relabel.relabel_records(rows, KINDS, CORE)
    pairs = F.sort_array(F.transform(F.map_entries("presence"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return out.select("id", "subclass", "entity_name", "subject", F.array_join("keywords", "|").alias("keywords"), "record_type", "intent", F.array_join(pairs, ",").alias("presence"), F.array_join("changes", ",").alias("changes"))


@query("""WITH f AS (SELECT p_type AS key, upper(p_type[1:1]) || lower(p_type[2:]) || ' goods' AS label, [p_type || '-ware', 'All ' || lower(p_type)] AS surfaces FROM part GROUP BY ALL),
a AS (SELECT regexp_replace(lower(unnest(list_concat([key, label], surfaces))), '[^a-z0-9]', '', 'g') AS spelling, key FROM f)
SELECT p_partkey, spelt, coalesce((SELECT min(key) FROM a WHERE a.spelling = regexp_replace(lower(spelt), '[^a-z0-9]', '', 'g')), 'other') AS family
FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN lower(p_type) WHEN 1 THEN p_type || ' Goods!' WHEN 2 THEN p_type || '_WARE' WHEN 3 THEN 'all-' || p_type WHEN 4 THEN p_name END AS spelt FROM part)""")
def family_match(t):
    """Spellings of part types, some of none, and the family of each."""
    k, kind = F.col("p_partkey") % 6, F.col("p_type")
    families = t.part.select(kind.alias("key")).distinct().select("key", F.concat(F.initcap("key"), F.lit(" goods")).alias("label"), F.array(F.concat("key", F.lit("-ware")), F.concat(F.lit("All "), F.lower("key"))).alias("surfaces"), F.col("key").alias("place"))
    spelt = F.when(k == 0, F.lower(kind)).when(k == 1, F.concat(kind, F.lit(" Goods!"))).when(k == 2, F.concat(kind, F.lit("_WARE"))).when(k == 3, F.concat(F.lit("all-"), kind)).when(k == 4, F.col("p_name"))
    return relabel.family_of(t.part.select("p_partkey", spelt.alias("spelt")), "spelt", families)


#: Spans of documents: words, a heading, shifted and late ones, copies, and one outside the text.
_SPANS = """SELECT doc_id, 'Opening' AS name, 0 AS start, substring(text, 1, 12) AS text FROM documents UNION ALL SELECT doc_id, 'Opening', 40, substring(text, 41, 12) FROM documents UNION ALL
SELECT doc_id, 'Vowel', 20, substring(text, 21, 3) FROM documents UNION ALL SELECT doc_id, 'Vowel', 20, substring(text, 21, 3) FROM documents WHERE doc_id % 2 = 0 UNION ALL
SELECT doc_id, 'Body', 30, substring(text, 32, 9) FROM documents UNION ALL SELECT doc_id, 'Body', 900, substring(text, 901, 10) FROM documents UNION ALL SELECT doc_id, 'Long', 5, substring(text, 6, 60) FROM documents UNION ALL
SELECT doc_id, substring(text, 1, 5), 0, substring(text, 1, 5) FROM documents UNION ALL SELECT doc_id, 'Mood', 0, substring(text, 1, 4) FROM documents WHERE doc_id % 5 = 0 UNION ALL SELECT doc_id, 'Body', -1, 'abc' FROM documents WHERE doc_id % 7 = 0 UNION ALL SELECT doc_id, 'Body', CAST(NULL AS INTEGER), 'abc' FROM documents WHERE doc_id % 9 = 0"""
_CATEGORIES = [("Opening", None, 20), ("Vowel", "[aeiou]", None), ("Body", None, None), ("Long", None, None)]
_VERDICTS = rf"""SELECT s.doc_id, s.name, s.start, s.text, s.copies, CASE WHEN v.name IS NULL THEN 'unknown_category' WHEN s.text IS NULL OR s.start IS NULL OR length(regexp_replace(s.text, '^\s+|\s+$', '', 'g')) < 2 THEN 'malformed'
 WHEN s.start < 0 OR s.start + length(s.text) > length(coalesce(d.text, '')) THEN 'outside' WHEN substr(d.text, s.start + 1, length(s.text)) <> s.text THEN 'not_verbatim' WHEN length(s.text) > 50 THEN 'too_long'
 WHEN regexp_replace(lower(s.text), '[^a-z0-9]', '', 'g') = regexp_replace(lower(s.name), '[^a-z0-9]', '', 'g') THEN 'heading_only' WHEN probe IS NOT NULL AND NOT regexp_matches(s.text, probe, 'i') THEN 'failed_probe' WHEN s.start > latest THEN 'too_late' ELSE 'ok' END AS verdict
FROM (SELECT doc_id, name, start, text, count(*) AS copies FROM ({_SPANS}) GROUP BY ALL) s LEFT JOIN (SELECT 'Opening' AS name, NULL AS probe, 20 AS latest UNION ALL VALUES ('Vowel', '[aeiou]', NULL), ('Body', NULL, NULL), ('Long', NULL, NULL) UNION ALL
 SELECT DISTINCT substr(text, 1, 5), NULL, NULL FROM documents WHERE doc_id % 3 = 0 AND length(text) >= 5) v USING (name) JOIN documents d USING (doc_id)"""


def _verdicts(t):
    own = t.documents.where("doc_id % 3 = 0 AND length(text) >= 5").select(F.substring("text", 1, 5).alias("name"), F.lit(None).cast("string").alias("probe"), F.lit(None).cast("int").alias("latest")).distinct()
    categories = t.rows(_CATEGORIES, "name string, probe string, latest int").unionByName(own)
    return spans.span_verdicts(t.spark.sql(_SPANS.replace("FROM documents", "FROM {documents}"), documents=t.documents), t.documents.select("doc_id", "text"), categories, 50)


@query(_VERDICTS)
def span_verdicts(t):
    """Spans by category against their documents; some categories are headings of the texts."""
    return _verdicts(t)


@query(f"""WITH c AS (SELECT doc_id, count(DISTINCT name) FILTER (WHERE verdict = 'ok') AS present, coalesce(bool_or(verdict = 'unknown_category'), false) AS odd, coalesce(bool_or(verdict = 'ok' AND name IN ('Vowel', 'Body')), false) AS core FROM documents LEFT JOIN ({_VERDICTS}) USING (doc_id) GROUP BY doc_id)
SELECT doc_id, present, unnest(list_filter([CASE WHEN odd THEN 'unknown_categories' END, CASE WHEN present < 3 THEN 'few_categories' END, CASE WHEN NOT core THEN 'none_of_required' END], lambda p: p IS NOT NULL)) AS problem FROM c""")
def span_problems(t):
    """Documents with unknown categories, fewer than three, or neither of two that are required."""
    return spans.span_problems(_verdicts(t), t.documents, 3, ["Vowel", "Body"])


@query("""WITH e AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), u AS (SELECT user_id, count(*) FILTER (WHERE event_type <> 'error') AS labels, sum(n) + CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END AS declared, CASE WHEN user_id % 5 <> 0 THEN sum(n) END AS told FROM e GROUP BY user_id)
SELECT status, count(*) AS n FROM (SELECT CASE WHEN told IS NULL THEN 'not_told' WHEN told <> declared THEN 'sums_differ' WHEN declared < labels THEN 'below_labels' ELSE 'agrees' END AS status FROM u) GROUP BY status""")
def label_surfaces(t):
    """The declared number of labels against the counts that the metadata tell as JSON."""
    each = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    pairs = F.map_from_entries(F.collect_list(F.struct("event_type", "n")))  # one entry a kind of event
    u = F.col("user_id")
    rows = each.groupBy("user_id").agg(
        F.count_if(F.col("event_type") != "error").alias("labels"),
        (F.sum("n") + F.when(u % 4 == 0, 1).otherwise(0)).alias("declared"),
        F.when(u % 10 == 0, F.lit("{")).when(u % 5 != 0, F.to_json(pairs)).alias("told"),
    )
    return rows.groupBy(release.surface_status(F.col("labels"), F.col("declared"), F.col("told")).alias("status")).agg(F.count("*").alias("n"))
