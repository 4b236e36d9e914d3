"""Queries of release gates and of derivations for a release. Faults are put in by id, for each gate one."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from corpuslens.functions import exprs as X
from corpuslens.operators import release
from corpuslens.plans.base import query

_RULE = "CASE WHEN (('0x' || substr(md5({0}::VARCHAR), 1, 16))::UBIGINT % 10 * 6 + ('0x' || substr(md5({0}::VARCHAR), 17, 16))::UBIGINT % 10) % 10 = 0 THEN 'test' ELSE 'train' END"


@query(f"""WITH b AS (SELECT doc_id, text, 'f' || doc_id AS filename, {_RULE.format("('f' || doc_id)")} AS rule FROM documents),
d AS (SELECT doc_id, filename, text, rule AS split FROM b WHERE doc_id % 71 <> 1), t AS (SELECT *, CASE WHEN doc_id % 89 = 1 THEN 'other' ELSE rule END AS split FROM b UNION ALL SELECT *, rule FROM b WHERE doc_id % 73 = 1),
f AS (SELECT 'missing_in_default' AS gate, t.filename FROM t LEFT JOIN d USING (doc_id) WHERE d.doc_id IS NULL UNION ALL
SELECT 'split_rule', filename FROM t WHERE split <> rule UNION ALL SELECT 'split_disagrees', t.filename FROM t JOIN d USING (doc_id) WHERE t.split <> d.split UNION ALL
SELECT 'hash_drift', t.filename FROM t LEFT JOIN d USING (doc_id) WHERE CASE WHEN t.doc_id % 97 = 1 THEN d.text IS NOT NULL OR sha256('') <> 'x' ELSE d.doc_id IS NULL AND t.text <> '' END UNION ALL
SELECT 'empty_document_id', filename FROM t WHERE doc_id % 67 = 1 UNION ALL SELECT 'gt_fields_unreadable', filename FROM t WHERE doc_id % 83 = 1 UNION ALL
SELECT 'label_in_metadata', d.filename FROM d JOIN t USING (doc_id) WHERE d.doc_id % 79 = 1 UNION ALL SELECT DISTINCT 'duplicate_filename', filename FROM t WHERE doc_id % 73 = 1 UNION ALL
SELECT DISTINCT 'duplicate_document_id', filename FROM t WHERE doc_id % 73 = 1 AND doc_id % 67 <> 1)
SELECT gate, count(*) AS n FROM f GROUP BY gate""")
def release_invariants(t):
    """Violations by gate of a release whose faults are known."""
    i, name = F.col("doc_id"), F.concat(F.lit("f"), F.col("doc_id").cast("string"))
    base = t.documents.select("doc_id", "lang", "text", name.alias("filename")).withColumn("split", X.split_of(F.col("filename")))
    meta = F.create_map(F.lit("lang"), F.col("lang"), F.when(i % 79 == 1, F.lit("expected_kind")).otherwise(F.lit("origin")), F.lit("x"))
    default = base.where("doc_id % 71 <> 1").select("filename", F.col("text").alias("doc_text"), meta.alias("metadata"), "split")
    truth = base.select(
        "doc_id", "filename", F.when(i % 67 == 1, "").otherwise(X.document_id(F.lit("c"), F.col("filename"))).alias("document_id"), F.when(i % 89 == 1, "other").otherwise(F.col("split")).alias("split"),
        F.when(i % 97 == 1, "x").otherwise(F.sha2("text", 256)).alias("content_sha256"), F.when(i % 83 == 1, '{"a":').otherwise('{"a": [1]}').alias("gt_fields"),
    )
    again = truth.where("doc_id % 73 = 1").withColumn("split", X.split_of(F.col("filename")))
    found = release.invariants(default, truth.unionByName(again).drop("doc_id"), ["quality", "toxic"])
    return found.groupBy("gate").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT doc_id, text, 'a' || chr(13) || chr(10) || text || chr(7) AS raw, 'a' || chr(10) || text AS clean FROM documents)
SELECT gate, count(*) AS n FROM (
  SELECT unnest(list_filter([CASE WHEN doc_id % 61 = 1 OR doc_id % 59 = 1 THEN 'row_set' END, CASE WHEN doc_id % 53 = 1 AND doc_id % 61 <> 1 AND doc_id % 59 <> 1 THEN 'split_moved' END,
    CASE WHEN doc_id % 47 = 1 AND doc_id % 61 <> 1 AND doc_id % 59 <> 1 THEN 'kind_moved' END, CASE WHEN doc_id % 43 = 1 AND doc_id % 61 <> 1 AND doc_id % 59 <> 1 THEN 'text_not_cleaned' END,
    CASE WHEN doc_id % 41 = 1 AND doc_id % 61 <> 1 THEN 'hash_drift' END, CASE WHEN doc_id % 37 = 1 AND doc_id % 61 <> 1 THEN 'prompt_not_empty' END, CASE WHEN doc_id % 31 = 1 AND doc_id % 61 <> 1 THEN 'presence_keys' END,
    CASE WHEN doc_id % 29 = 1 AND doc_id % 61 <> 1 THEN 'unapproved_label' END, CASE WHEN doc_id % 23 = 1 AND doc_id % 61 <> 1 AND doc_id % 59 <> 1 THEN 'legacy_changed' END,
    CASE WHEN doc_id % 61 = 1 OR doc_id % 19 = 1 OR doc_id % 43 = 1 THEN 'span_drift' END, CASE WHEN doc_id % 59 = 1 AND doc_id % 61 <> 1 THEN 'id_not_opaque' END], lambda g: g IS NOT NULL)) AS gate FROM s WHERE length(text) > 0
  UNION ALL SELECT 'row_set' FROM s WHERE doc_id % 59 = 1 AND doc_id % 61 <> 1) GROUP BY gate""")
def stage_conformance(t):
    """Rows by gate in which a built stage departs from its source, each fault at known ids."""
    i = F.col("doc_id")
    raw = F.concat(F.lit("a\r\n"), "text", F.lit("\x07"))
    base = t.documents.where("length(text) > 0").select("doc_id", "text", X.document_id(F.lit("c"), i.cast("string")).alias("document_id"), X.split_of(i).alias("split"), F.col("lang").alias("kind"))
    source = base.select("document_id", "split", "kind", raw.alias("doc_text"), F.lit('{"a":1}').alias("legacy"))
    text = F.when(i % 43 == 1, F.concat(F.lit("z"), X.clean_text(raw))).otherwise(X.clean_text(raw))
    built = base.where("doc_id % 61 <> 1").withColumn("doc_text", text)
    stage = built.select(
        F.when(i % 59 == 1, F.concat(F.lit("doc"), i.cast("string"))).otherwise(F.col("document_id")).alias("document_id"), F.when(i % 53 == 1, "other").otherwise(F.col("split")).alias("split"),
        F.when(i % 47 == 1, "other").otherwise(F.col("kind")).alias("kind"), "doc_text", F.when(i % 41 == 1, "x").otherwise(F.sha2("doc_text", 256)).alias("content_sha256"), F.when(i % 37 == 1, "p").otherwise("").alias("prompt"),
        F.create_map(F.lit("quality"), F.lit("gap"), F.when(i % 31 == 1, F.lit("mood")).otherwise(F.lit("toxic")), F.lit("gap")).alias("presence"),
        F.create_map(F.lit("quality"), F.when(i % 29 == 1, "llm:m9").otherwise("llm:m1")).alias("provenance"), F.when(i % 23 == 1, "{}").otherwise('{"a":1}').alias("legacy"),
    )
    ids = F.when((i % 59 == 1) & (i % 61 != 1), F.concat(F.lit("doc"), i.cast("string"))).otherwise(F.col("document_id"))
    spans = base.select(ids.alias("document_id"), F.lit(2).alias("start"), F.when(i % 19 == 1, F.concat(F.lit("!"), F.substring("text", 1, 9))).otherwise(F.substring("text", 1, 9)).alias("text"))
    return release.conformance(stage, source, spans, ["quality", "toxic"], ["m1"]).groupBy("gate").agg(F.count("*").alias("n"))


@query("SELECT 'data/' || s_suppkey AS path, CASE WHEN s_suppkey % 5 = 0 THEN 'not_listed' WHEN s_suppkey % 5 = 1 THEN 'missing' ELSE 'sha_mismatch' END AS finding FROM supplier WHERE s_suppkey % 5 < 3")
def manifest_check(t):
    """A manifest against the files that it should list."""
    path, k = F.concat(F.lit("data/"), F.col("s_suppkey").cast("string")), F.col("s_suppkey") % 5
    sha = F.sha2("s_name", 256)
    entries = t.supplier.where(k != 0).select(path.alias("path"), sha.alias("sha256"))
    files = t.supplier.where(k != 1).select(path.alias("path"), F.when(k == 2, "changed").otherwise(sha).alias("sha256"))
    return release.manifest_findings(entries, files)


@query(f"""WITH b AS (SELECT doc_id, sha256(text) AS h, {_RULE.format('doc_id')} AS split FROM documents), k AS (SELECT h, min(doc_id) AS doc_id FROM b GROUP BY h)
SELECT 'rows' AS fact, count(*) AS value FROM b UNION ALL SELECT 'kept', count(*) FROM k UNION ALL SELECT 'removed', (SELECT count(*) FROM b) - count(*) FROM k UNION ALL SELECT unnest(['lost_texts', 'surviving_copies', 'split_moved']), 0""")
def dedup_verification(t):
    base = t.documents.select("doc_id", F.sha2("text", 256).alias("digest"), X.split_of(F.col("doc_id")).alias("split"))
    kept = base.groupBy("digest").agg(F.min_by(F.struct("doc_id", "split"), "doc_id").alias("x")).select("x.doc_id", "digest", "x.split")
    return release.verify_dedup(base, kept)


_TASKS = "SELECT user_id, count(DISTINCT event_type) AS n, sum(CASE WHEN user_id % 4 = 0 THEN 0 ELSE 1 END) AS declared FROM events WHERE event_type <> 'error' GROUP BY user_id"


@query(f"""WITH r AS ({_TASKS}), k AS (SELECT event_type, count(DISTINCT user_id) AS n FROM events WHERE event_type <> 'error' GROUP BY 1)
SELECT f.fact, '' AS key, f.value::DOUBLE AS value FROM (SELECT count(*) AS a, avg(n) AS b, min(n) AS c, max(n) AS d, count(*) FILTER (WHERE declared >= n) AS e FROM r), LATERAL (VALUES ('rows_with_labels', a::DOUBLE), ('mean', b), ('least', c::DOUBLE), ('most', d::DOUBLE), ('consistent', e::DOUBLE)) f(fact, value)
UNION ALL SELECT 'distinct_tasks', '', count(*) FROM k UNION ALL SELECT * FROM (SELECT 'task', event_type, n FROM k ORDER BY n DESC, event_type LIMIT 3)""")
def label_audit(t):
    """Label maps of users (kinds of event that they have) with a declared count each."""
    own = t.events.where("event_type <> 'error'").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    maps = own.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("labels"), F.sum(F.when(F.col("user_id") % 4 == 0, 0).otherwise(F.col("n"))).alias("declared"))
    return release.label_audit(maps, 3)


@query("SELECT coalesce(nullif(split_part(regexp_replace(url, '^[a-z]+://[^/]*/?', ''), '/', 1), ''), '.') AS part, count(*) AS files, sum(strlen(html))::BIGINT AS bytes FROM pages GROUP BY 1")
def file_tally(t):
    """Files and bytes by the first component of their path."""
    first = F.split(F.regexp_replace("url", r"^[a-z]+://[^/]*/?", ""), "/")[0]
    return t.pages.groupBy(F.when(first == "", ".").otherwise(first).alias("part")).agg(F.count("*").alias("files"), F.sum(F.octet_length("html")).alias("bytes"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 IN (2, 4) THEN c_name || ' (UK)' ELSE c_name END AS name FROM customer")
def filer_names(t):
    """Filer names without registry numbers, state codes and tickers; a country stays."""
    k = F.col("c_custkey") % 5
    tail = F.when(k == 0, " (CIK 0001308648)").when(k == 1, " /DE/ (ABCD) (CIK 77)").when(k == 2, " (UK) (CIK 5)").when(k == 3, "  (XYZ.A) /NY/").otherwise(" (UK) (TICK)")
    return t.customer.select("c_custkey", X.clean_filer(F.concat("c_name", tail), ["DE", "NY", "CA"], ["UK", "AG", "SA"]).alias("name"))


CUES = {"bylaws": r"\bby-?laws\b", "charter": r"\bcharter\b", "minutes": r"\bminutes\b"}


@query("""SELECT o_orderkey, CASE WHEN k = 1 AND own <> 'minutes' THEN 'minutes' WHEN k = 3 AND own <> 'charter' THEN 'charter' ELSE own END AS subclass,
  list_filter([CASE WHEN (k = 1 AND own <> 'minutes') OR (k = 3 AND own <> 'charter') THEN 'subclass' END, CASE WHEN o_orderkey % 4 = 0 OR (k = 1 AND own <> 'minutes') OR (k = 3 AND own <> 'charter') THEN 'record_type' END], lambda c: c IS NOT NULL) AS changes
FROM (SELECT o_orderkey, o_orderkey % 4 AS k, ['bylaws', 'charter', 'minutes'][(o_orderkey % 3 + 1)::INTEGER] AS own FROM orders)""")
def relabel_rows(t):
    """A row goes to another subclass if exactly one other's cue is in its subject and not its own."""
    own = F.element_at(F.array(F.lit("bylaws"), F.lit("charter"), F.lit("minutes")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    k = F.col("o_orderkey") % 4
    subject = F.when(k == 1, "Minutes of the board").when(k == 2, "Minutes and charter, and by-laws").when(k == 3, "The Charter of a company").otherwise("A record")
    rows = t.orders.select("o_orderkey", own.alias("own"), subject.alias("subject"), F.when(k == 0, "").otherwise(F.concat(own, F.lit("_doc"))).alias("record_type"))
    return rows.select("o_orderkey", X.relabel(F.col("own"), F.col("subject"), F.col("record_type"), CUES, {n: f"{n}_doc" for n in CUES}).alias("x")).select("o_orderkey", "x.subclass", "x.changes")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL WHEN o_orderstatus = CASE o_orderkey % 3 WHEN 0 THEN 'F' ELSE 'O' END THEN o_orderstatus END AS value, o_orderkey % 3 <> 2 AND o_orderstatus <> CASE o_orderkey % 3 WHEN 0 THEN 'F' ELSE 'O' END AS contradicts FROM orders")
def derived_labels(t):
    """A label that an expert's answer confirms; none without an answer; a mark if they contradict."""
    k = F.col("o_orderkey") % 3
    answer = F.when(k == 0, "All done").when(k == 1, "Not yet").otherwise("Unclear")
    token = X.crosswalk(answer, {"All done": "F", "Not yet": "O"}, "")
    known = token != ""
    return t.orders.select("o_orderkey", F.when(known & (token == F.col("o_orderstatus")), token).alias("value"), (known & (token != F.col("o_orderstatus"))).alias("contradicts"))


@query("""SELECT doc_id, sha256(text) AS content_sha256, CASE WHEN l.doc_id IS NULL THEN '{"lang":"' || lang || '"}' ELSE '{"lang":"' || lang || '","quality_label":"' || quality || '","toxic_label":"' || toxic || '"}' END AS gt_fields FROM documents d LEFT JOIN labels l USING (doc_id)""")
def legacy_projection(t):
    """Class records as flat rows of an older release: fields under their old keys, empty ones left out."""
    rows = t.documents.select("doc_id", "text", "lang").join(t.labels, "doc_id", "left")
    flat = F.to_json(F.struct("lang", F.col("quality").cast("string").alias("quality_label"), F.col("toxic").cast("string").alias("toxic_label")))
    return rows.select("doc_id", F.sha2("text", 256).alias("content_sha256"), flat.alias("gt_fields"))


@query("""SELECT o_orderkey, 'Claim ' || o_orderkey || E'\\nFiled: ' || strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderstatus = 'P' THEN '' ELSE E'\\nStatus: ' || CASE o_orderstatus WHEN 'O' THEN 'open' ELSE 'closed' END END || E'\\nNot a real document.' AS text FROM orders""")
def rendered_claims(t):
    """Documents rendered from rows by a template; lines without a value are left out."""
    status = X.crosswalk(F.col("o_orderstatus"), {"O": "open", "F": "closed"}, "")
    lines = F.array(F.concat(F.lit("Claim "), F.col("o_orderkey").cast("string")), F.concat(F.lit("Filed: "), F.date_format("o_orderdate", "yyyy-MM-dd")), F.when(status != "", F.concat(F.lit("Status: "), status)), F.lit("Not a real document."))
    return t.orders.select("o_orderkey", F.array_join(F.array_compact(lines), "\n").alias("text"))


@query("""SELECT lang, high, low, least(1, round(high + 0.005, 6)) AS probe_high, greatest(0, round(low - 0.005, 6)) AS probe_low FROM (SELECT lang, CASE lang WHEN 'de' THEN 0.998 ELSE 0.97 END::DOUBLE AS high, CASE lang WHEN 'fr' THEN 0.002 ELSE 0.88 END::DOUBLE AS low FROM (SELECT DISTINCT lang FROM documents))""")
def confidence_bands(t):
    """Bands by class over the global ones, and probes just outside, within 0 and 1."""
    own = t.rows([("de", 0.998, None), ("fr", None, 0.002)], "lang string, h double, l double")
    rows = t.documents.select("lang").distinct().join(F.broadcast(own), "lang", "left")
    bands = rows.select("lang", F.coalesce("h", F.lit(0.97)).alias("high"), F.coalesce("l", F.lit(0.88)).alias("low"))
    return bands.withColumn("probe_high", F.least(F.lit(1.0), F.round(F.col("high") + 0.005, 6))).withColumn("probe_low", F.greatest(F.lit(0.0), F.round(F.col("low") - 0.005, 6)))


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'no_label' WHEN sha256(d.text) <> sha256(CASE WHEN d.doc_id % 9 = 0 THEN d.text || ' ' ELSE d.text END) THEN 'text_changed' ELSE 'carried' END AS status, CASE WHEN d.doc_id % 9 <> 0 THEN l.quality END AS quality FROM documents d LEFT JOIN labels l USING (doc_id)")
def legacy_reconcile(t):
    """Labels of one revision carried to another where the text is the same."""
    text = F.when(F.col("doc_id") % 9 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text"))
    then = t.documents.join(t.labels, "doc_id").select("doc_id", "quality", F.sha2(text, 256).alias("then"))
    both = t.documents.select("doc_id", F.sha2("text", 256).alias("now")).join(then, "doc_id", "left")
    status = F.when(F.col("then").isNull(), "no_label").when(F.col("then") != F.col("now"), "text_changed").otherwise("carried")
    return both.select("doc_id", status.alias("status"), F.when(F.col("then") == F.col("now"), F.col("quality")).alias("quality"))


@query("SELECT count(*) AS rows, count(*) FILTER (WHERE doc_id % 12 = 0) AS leaks, count(*) - (SELECT count(*) FROM labels) AS unlabeled, count(*) = (count(*) - (SELECT count(*) FROM labels)) + (SELECT count(*) FROM labels) AS adds_up FROM documents")
def legacy_dump_audit(t):
    """Rows of a dump whose metadata names a label, and whether its parts add up to it."""
    meta = F.create_map(F.lit("lang"), F.col("lang"), F.when(F.col("doc_id") % 12 == 0, F.lit("Quality")).when(F.col("doc_id") % 12 == 1, F.lit("note")).otherwise(F.lit("origin")), F.lit("1"))
    leak = F.exists(F.map_keys(meta), lambda k: release.is_label_key(k, ["quality", "toxic"]))
    marked = t.documents.select("doc_id", leak.alias("leak")).join(t.labels.select("doc_id", F.lit(1).alias("has")), "doc_id", "left")
    sums = marked.agg(F.count("*").alias("rows"), F.count_if("leak").alias("leaks"), F.count_if(F.col("has").isNull()).alias("unlabeled"), F.count("has").alias("labeled"))
    return sums.select("rows", "leaks", "unlabeled", (F.col("rows") == F.col("unlabeled") + F.col("labeled")).alias("adds_up"))


@F.pandas_udf(LongType())
def library_tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Tokens by the tiktoken library, or a quarter of the characters where it isn't installed.

    The vocabulary is read once a task. A null text has no tokens.
    """
    try:
        import base64

        import public_tokenizers
        import tiktoken
    except ImportError:
        for text in texts:
            yield text.map(lambda t: -(-len(t or "") // 4))
        return
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    for text in texts:
        yield text.map(lambda t: len(encode(t or "")))


@query()
def token_count(t):
    return t.benchmark.select("item_id", library_tokens("text").alias("tokens"))
