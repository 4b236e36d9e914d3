"""Queries of scalar derivations: identity, text, money, presence, findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.functions import exprs as X
from corpuslens.functions import udfs
from corpuslens.operators.release import is_label_key
from corpuslens.plans.base import query
from corpuslens.sources.files import expand_json, safe_line


@query("SELECT doc_id, CASE WHEN (('0x' || substr(md5(doc_id::VARCHAR), 1, 16))::UBIGINT % 10 * 6 + ('0x' || substr(md5(doc_id::VARCHAR), 17, 16))::UBIGINT % 10) % 10 = 0 THEN 'test' ELSE 'train' END AS split FROM documents")
def split_rule(t):
    return t.documents.select("doc_id", X.split_of(F.col("doc_id")).alias("split"))


@query(r"SELECT doc_id, sha256(text) AS sha, sha256(trim(regexp_replace(text, '[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))) AS normal_sha FROM documents")
def content_hash(t):
    return t.documents.select("doc_id", F.sha2("text", 256).alias("sha"), F.sha2(X.squeeze(F.col("text")), 256).alias("normal_sha"))


@query("SELECT doc_id, 'DOC-' || substr(sha256(source || chr(10) || doc_id::VARCHAR), 1, 16) AS document_id, CASE WHEN source IN ('src0', 'src1') THEN 'core' ELSE source END AS corpus FROM documents")
def document_identity(t):
    corpus = F.when(F.col("source").isin("src0", "src1"), "core").otherwise(F.col("source"))
    return t.documents.select("doc_id", X.document_id(F.col("source"), F.col("doc_id").cast("string")).alias("document_id"), corpus.alias("corpus"))


@query("SELECT doc_id, length(text) / 4.0::DOUBLE AS est, (length(text) // 4)::BIGINT AS est_floor, ceil(length(text) / 4.0)::BIGINT AS est_ceil FROM documents")
def token_estimate(t):
    n = F.length("text")
    return t.documents.select("doc_id", X.tokens(n).alias("est"), F.floor(n / 4).alias("est_floor"), F.ceil(n / 4).alias("est_ceil"))


@query("SELECT doc_id, CASE WHEN n_chars / 4.0 <= 4096 THEN '<=4k' WHEN n_chars / 4.0 <= 16384 THEN '<=16k' WHEN n_chars / 4.0 <= 32768 THEN '<=32k' ELSE '>32k' END AS band FROM documents")
def context_band(t):
    return t.documents.select("doc_id", X.context_band(X.tokens(F.col("n_chars"))).alias("band"))


@query("""SELECT d.doc_id, f.field, CASE WHEN f.v IS NOT NULL AND trim(f.v) NOT IN ('', '[]', '{}') THEN 'populated'
  WHEN d.source = 'src0' THEN 'pending' WHEN f.field = 'toxic' AND d.lang <> 'en' THEN 'not_applicable' ELSE 'gap' END AS code
FROM (SELECT d.doc_id, d.source, d.lang, l.quality::VARCHAR AS quality, l.toxic::VARCHAR AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)) d,
LATERAL (VALUES ('quality', d.quality), ('toxic', d.toxic)) f(field, v)""")
def presence_classify(t):
    """Ordered rules: populated, pending source, not applicable, gap."""
    rows = t.documents.select("doc_id", "source", "lang").join(t.labels, "doc_id", "left")
    long = rows.select("doc_id", "source", "lang", F.expr("stack(2, 'quality', cast(quality as string), 'toxic', cast(toxic as string)) as (field, v)"))
    code = F.when(X.is_populated(F.col("v")), "populated").when(F.col("source") == "src0", "pending").when((F.col("field") == "toxic") & (F.col("lang") != "en"), "not_applicable").otherwise("gap")
    return long.select("doc_id", "field", code.alias("code"))


@query("""SELECT doc_id, list_sort(list_filter([CASE WHEN q IS NULL THEN 'missing:quality' END, CASE WHEN x IS NULL THEN 'missing:toxic' END,
  CASE WHEN q = 0 AND x = 1 THEN 'bad-code:quality' END], lambda p: p IS NOT NULL)) AS problems
FROM (SELECT d.doc_id, l.quality AS q, l.toxic AS x FROM documents d LEFT JOIN labels l USING (doc_id))""")
def presence_law(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    have = F.filter(F.array(F.when(F.col("quality").isNotNull(), F.lit("quality")), F.when(F.col("toxic").isNotNull(), F.lit("toxic"))), lambda k: k.isNotNull())
    lacking = F.transform(F.array_except(F.array(F.lit("quality"), F.lit("toxic")), have), lambda k: F.concat(F.lit("missing:"), k))
    bad = F.when((F.col("quality") == 0) & (F.col("toxic") == 1), F.array(F.lit("bad-code:quality"))).otherwise(F.array().cast("array<string>"))
    return rows.select("doc_id", F.array_sort(F.concat(lacking, bad)).alias("problems"))


@query("SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 'returns' WHEN 'A' THEN 'archive' ELSE 'general' END AS desk, l_quantity > 45 AS review FROM lineitem")
def routing_lookup(t):
    desks = F.create_map(F.lit("R"), F.lit("returns"), F.lit("A"), F.lit("archive"))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.coalesce(F.try_element_at(desks, F.col("l_returnflag")), F.lit("general")).alias("desk"), (F.col("l_quantity") > 45).alias("review"))


@query(r"SELECT conv_id, turn, lower(trim(regexp_replace(regexp_replace('Re: [EXT] FW: ' || text, '^(\s*(re|fw|fwd|aw)\s*:|\s*\[[^\]]*\])+', '', 'i'), '[\s\x{85}\x{a0}\x{2028}\x{2029}]+', ' ', 'g'))) AS subject FROM conversations")
def subject_normalize(t):
    return t.conversations.select("conv_id", "turn", X.normalize_subject(F.concat(F.lit("Re: [EXT] FW: "), "text")).alias("subject"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(replace(text, '.' || chr(10), '.' || chr(13) || chr(10) || chr(7)), '\r\n?', chr(10), 'g'), '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') AS clean,
  length(regexp_replace(regexp_replace(substr(replace(text, '.' || chr(10), '.' || chr(13) || chr(10) || chr(7)), 1, 200), '\r\n?', chr(10), 'g'), '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'))::INTEGER
  - CASE WHEN substr(replace(text, '.' || chr(10), '.' || chr(13) || chr(10) || chr(7)), 200, 2) = chr(13) || chr(10) THEN 1 ELSE 0 END AS at FROM documents""")
def text_cleanup(t):
    """Cleaned text and where its 200th character went, over texts made untidy first."""
    dirty = F.expr("replace(text, concat('.', chr(10)), concat('.', chr(13), chr(10), chr(7)))")
    rows = t.documents.select("doc_id", dirty.alias("d"))
    return rows.select("doc_id", X.clean_text(F.col("d")).alias("clean"), X.clean_offset(F.col("d"), F.lit(200)).alias("at"))


@query(r"""WITH d AS (SELECT doc_id, replace(replace(replace(text, chr(10), chr(13) || chr(10)), '. ', '.' || chr(160) || chr(7)), ', ', chr(13)) AS t FROM documents), s AS (SELECT doc_id, t, unnest(range(0, 8)) AS k FROM d), r AS (SELECT doc_id, k, t, (k * 53)::INTEGER AS a, (k * 53 + k * k)::INTEGER AS b FROM s), c AS (
SELECT *, length(regexp_replace(translate(regexp_replace(substr(t, 1, a), '\r\n?', chr(10), 'g'), chr(160), ' '), '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')) - (a > 0 AND substr(t, a, 2) = chr(13) || chr(10))::INTEGER AS x,
  length(regexp_replace(translate(regexp_replace(substr(t, 1, b), '\r\n?', chr(10), 'g'), chr(160), ' '), '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')) - (b > 0 AND substr(t, b, 2) = chr(13) || chr(10))::INTEGER AS y FROM r)
SELECT doc_id, k::INTEGER AS k, CASE WHEN b <= length(t) THEN x::INTEGER END AS start, CASE WHEN b <= length(t) THEN y::INTEGER END AS stop, CASE WHEN b <= length(t) THEN substr(regexp_replace(translate(regexp_replace(t, '\r\n?', chr(10), 'g'), chr(160), ' '), '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'), (x + 1)::INTEGER, (y - x)::INTEGER) END AS quote,
  CASE WHEN b > length(t) THEN 'out of text' WHEN x = y THEN 'lost' END AS problem FROM c""")
def span_remap(t):
    """Eight spans of each text, some of them beyond it or of dropped characters, moved on to the cleaned text."""
    dirty = F.replace(F.replace(F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit(". "), F.lit(".\u00a0\x07")), F.lit(", "), F.lit("\r"))
    spans = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.struct((k * 53).alias("start"), (k * 53 + k * k).alias("stop")))
    rows = t.documents.select("doc_id", dirty.alias("text"))
    return rows.select("doc_id", F.posexplode(X.remap_spans(F.col("text"), spans)).alias("k", "s")).select("doc_id", "k", "s.start", "s.stop", "s.quote", "s.problem")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice)::DOUBLE * 1000 WHEN o_orderkey % 3 = 1 THEN -floor(o_totalprice)::DOUBLE ELSE floor(o_totalprice)::DOUBLE END AS amount FROM orders""")
def money_parse(t):
    n = F.format_number(F.floor("o_totalprice"), 0)
    text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("$"), n, F.lit("k"))).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("($"), n, F.lit(")"))).otherwise(F.concat(F.lit("USD "), n, F.lit(" net")))
    return t.orders.select("o_orderkey", X.parse_money(text).alias("amount"))


@query("SELECT o_orderkey, o_orderdate::DATE AS d FROM orders")
def date_parse(t):
    day = F.to_date("o_orderdate")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "yyyy-MM-dd")).when(F.col("o_orderkey") % 3 == 1, F.date_format(day, "M/d/yyyy")).otherwise(F.date_format(day, "MMMM d, yyyy"))
    return t.orders.select("o_orderkey", X.parse_date(text).alias("d"))


@query()
def quote_locate(t):
    """Where a quote, folded and marked up, is in its document; a UDF maps the offsets back."""
    quote = F.upper(F.substring("text", 20, 40))
    return t.documents.select("doc_id", udfs.quote_span(F.col("text"), quote).alias("s")).select("doc_id", "s.start", "s.stop")


@query("""SELECT b.item_id, d.doc_id, len(list_intersect(b.w, d.w)) / len(b.w)::DOUBLE AS ratio FROM
 (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM benchmark) b JOIN
 (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM documents) d ON d.doc_id % (SELECT count(*) FROM benchmark) = b.item_id""")
def token_grounding(t):
    """How many of an item's words are in the document that it is dealt to."""
    n = t.benchmark.count()
    items = t.benchmark.select("item_id", X.word_set(F.col("text")).alias("b"))
    docs = t.documents.select("doc_id", (F.col("doc_id") % n).alias("item_id"), X.word_set(F.col("text")).alias("d"))
    return docs.join(F.broadcast(items) if n < 100_000 else items, "item_id").select("item_id", "doc_id", (F.size(F.array_intersect("b", "d")) / F.size("b")).alias("ratio"))


@query("""SELECT doc_id, start, CASE WHEN start + length(span) > length(text) THEN 'out_of_range' WHEN substr(text, start + 1, length(span)) <> span THEN 'offset_drift' WHEN upper(span) = span AND length(trim(span)) < 4 THEN 'heading_only' ELSE 'ok' END AS verdict
FROM (SELECT doc_id, text, s.start, s.span FROM documents, LATERAL (VALUES (10, substr(text, 11, 20)), (30, substr(text, 32, 20)), (1000, substr(text, 1001, 20) || '!')) s(start, span))""")
def span_offset_audit(t):
    spans = "stack(3, 10, substring(text, 11, 20), 30, substring(text, 32, 20), 1000, concat(substring(text, 1001, 20), '!')) as (start, span)"
    rows = t.documents.select("doc_id", "text", F.expr(spans))
    n = F.length("span")
    verdict = F.when(F.col("start") + n > F.length("text"), "out_of_range").when(F.expr("substring(text, start + 1, length(span)) <> span"), "offset_drift").when((F.upper("span") == F.col("span")) & (F.length(F.trim("span")) < 4), "heading_only").otherwise("ok")
    return rows.select("doc_id", "start", verdict.alias("verdict"))


_FINDINGS_SQL = """SELECT o_orderkey, f.code, f.severity FROM orders, LATERAL (VALUES
  (CASE WHEN o_totalprice < 2000 THEN 'small_amount' END, 'warning'), (CASE WHEN o_orderpriority LIKE '1-%' AND o_orderstatus = 'O' THEN 'urgent_open' END, 'error'),
  (CASE WHEN o_orderdate < TIMESTAMP '1993-01-01' THEN 'old_date' END, 'info')) f(code, severity) WHERE f.code IS NOT NULL"""


def findings(orders):
    """Zero or more findings of each row, as an exploded array of rule structs."""
    rule = lambda test, code, severity: F.when(test, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity")))
    rules = F.array_compact(F.array(
        rule(F.col("o_totalprice") < 2000, "small_amount", "warning"),
        rule(F.col("o_orderpriority").startswith("1-") & (F.col("o_orderstatus") == "O"), "urgent_open", "error"),
        rule(F.col("o_orderdate") < F.lit("1993-01-01").cast("timestamp"), "old_date", "info"),
    ))
    return orders.select("o_orderkey", "o_orderstatus", F.explode(rules).alias("f")).select("o_orderkey", "o_orderstatus", "f.code", "f.severity")


@query(_FINDINGS_SQL)
def quality_findings(t):
    return findings(t.orders).drop("o_orderstatus")


@query(f"SELECT severity, code, count(*) AS n FROM ({_FINDINGS_SQL}) GROUP BY ALL")
def findings_summary(t):
    return findings(t.orders).groupBy("severity", "code").agg(F.count("*").alias("n"))


@query(f"SELECT o_orderkey, list_sort(list(DISTINCT code)) AS codes FROM ({_FINDINGS_SQL}) GROUP BY o_orderkey")
def backfill_queue(t):
    return findings(t.orders).groupBy("o_orderkey").agg(F.array_sort(F.collect_set("code")).alias("codes"))


@query("""SELECT doc_id, list_sort(list_filter([CASE WHEN regexp_matches(lower(text), '\\blicense') THEN 'license' END, CASE WHEN contains(text, '@') THEN 'contact' END,
 CASE WHEN contains(lower(text), 'token') AND NOT contains(lower(text), 'no token') THEN 'secret' END], lambda x: x IS NOT NULL)) AS marks FROM documents""")
def rule_derivation(t):
    low = F.lower("text")
    rules = F.array(F.when(low.rlike("(?<![0-9a-z_])license"), F.lit("license")), F.when(F.col("text").contains("@"), F.lit("contact")), F.when(low.contains("token") & ~low.contains("no token"), F.lit("secret")))
    return t.documents.select("doc_id", F.array_sort(F.array_compact(rules)).alias("marks"))


@query("SELECT doc_id, CASE WHEN length(text) <= 300 THEN text ELSE substr(text, 1, 200) || ' [...] ' || right(text, 100) END AS w FROM documents")
def text_window(t):
    return t.documents.select("doc_id", X.text_window(F.col("text"), 200, 100, " [...] ").alias("w"))


@query("SELECT event_id, event_type, (props->>'k')::INTEGER AS k FROM events")
def json_expand(t):
    return expand_json(t.events.select("event_id", "event_type", "props"), "props", "k int, event_type string").drop("props")


@query(r"SELECT doc_id, replace(replace(replace(text || chr(8232) || chr(133), chr(8232), '\u2028'), chr(8233), '\u2029'), chr(133), '\u0085') AS line FROM documents")
def line_boundary_sanitize(t):
    return t.documents.select("doc_id", safe_line(F.concat("text", F.lit("\u2028\u0085"))).alias("line"))


@query("SELECT count(*) AS changed, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS rerouted FROM customer WHERE c_mktsegment = 'BUILDING'")
def conditional_rewrite_drift(t):
    """Rows that a conditional rewrite changes, told by the difference of both tables."""
    old = t.customer.select("c_custkey", "c_mktsegment")
    new = old.withColumn("c_mktsegment", F.when(F.col("c_mktsegment") == "BUILDING", "CONSTRUCTION").otherwise(F.col("c_mktsegment")))
    changed = new.exceptAll(old)
    return changed.agg(F.count("*").alias("changed"), F.count_if(F.col("c_mktsegment") == "CONSTRUCTION").alias("rerouted"))


@query()
def html_to_text(t):
    return t.pages.select("page_id", udfs.html_to_text("html").alias("text"))


_AGREEMENT = """SELECT conv_id, string_agg('Section ' || (turn + 1) || '.' || length(role) || ' Duties of ' || upper(substr(role, 1, 1)) || substr(role, 2) || '.' || chr(10) || '"Fee ' || turn || '" means ' || replace(text, chr(10), ' ') || chr(10) || repeat('x', 90) || chr(10), '' ORDER BY turn) AS body FROM conversations GROUP BY conv_id"""


def agreements(t):
    """Conversations written as agreements: a section a turn, after a table of contents."""
    n, role = F.col("turn"), F.initcap("role")
    head = F.concat(F.lit("Section "), (n + 1).cast("string"), F.lit("."), F.length("role").cast("string"), F.lit(" Duties of "), role)
    body = F.concat(head, F.lit(".\n\"Fee "), n.cast("string"), F.lit('" means '), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("\n"), F.repeat(F.lit("x"), F.lit(90)), F.lit("\n"))
    parts = F.array_sort(F.collect_list(F.struct("turn", F.concat(head, F.lit(" .... 7\n")).alias("entry"), body.alias("body"))))
    made = t.conversations.groupBy("conv_id").agg(parts.alias("p"))
    return made.select("conv_id", F.concat(F.array_join("p.entry", ""), F.array_join("p.body", "")).alias("text"))


@query(f"SELECT conv_id, length(body) - length(replace(body, chr(10) || repeat('x', 90), chr(10) || repeat('x', 89))) AS n_sections FROM ({_AGREEMENT})")
def section_headings(t):
    """Operative sections of each agreement: entries of the contents are none."""
    return agreements(t).select("conv_id", F.size(F.filter(udfs.sections("text"), lambda s: s["operative"])).cast("long").alias("n_sections"))


@query("""SELECT conv_id, substr('Section 2.' || length(role) || ' Duties of ' || upper(substr(role, 1, 1)) || substr(role, 2) || '.' || chr(10) || '"Fee 1" means ' || replace(text, chr(10), ' ') || chr(10) || repeat('x', 90) || chr(10), 1, 400) AS section,
  substr('"Fee 1" means ' || replace(text, chr(10), ' '), 1, 150) AS definition FROM conversations WHERE turn = 1""")
def section_windows(t):
    """The section numbered 2.x of each agreement, capped, and the definition of a term."""
    rows = agreements(t).select("conv_id", "text", F.filter(udfs.sections("text"), lambda s: s["operative"] & s["number"].startswith("2.") & s["title"].rlike("(?i)duties of"))[0].alias("s")).where("s is not null")
    window = F.expr("substring(text, s.start + 1, least(400, s.stop - s.start))")
    return rows.select("conv_id", window.alias("section"), X.definition(F.col("text"), "Fee 1", 150).alias("definition"))


@query("SELECT o_orderkey, [o_orderdate::DATE::VARCHAR, (o_orderdate::DATE + 1)::VARCHAR, (o_orderdate::DATE + 2)::VARCHAR] AS dates FROM orders")
def dates_in_text(t):
    """All full dates of a text in their three written forms; an impossible one is left out."""
    day = F.to_date("o_orderdate")
    text = F.concat(F.lit("From "), F.date_format(day, "yyyy-MM-dd"), F.lit(" (not 2/30/2020) to "), F.date_format(F.date_add(day, 1), "MMMM d, yyyy"), F.lit("; due "), F.date_format(F.date_add(day, 2), "d MMM yyyy"), F.lit("."))
    return t.orders.select("o_orderkey", X.dates_in(text).alias("dates"))


@query(r"""WITH m AS (SELECT conv_id, string_agg(CASE WHEN turn = 0 THEN 'From: ' || role || '@x.org' || chr(10) || 'Subject:  Re: item ' || conv_id || chr(10) WHEN role = 'user' THEN 'To: ' || turn || chr(10) ELSE '' END || text, chr(10) ORDER BY turn) AS mail,
  string_agg(text, chr(10) ORDER BY turn) AS body FROM conversations GROUP BY conv_id)
SELECT conv_id, trim(body) AS body, sha256(trim(body)) AS body_sha, CASE WHEN contains(mail, 'Subject:') THEN 'Re: item ' || conv_id ELSE '' END AS subject FROM m""")
def email_headers(t):
    """A mail's body without header lines, its hash, and the first subject."""
    head = F.when(F.col("turn") == 0, F.concat(F.lit("From: "), "role", F.lit("@x.org\nSubject:  Re: item "), F.col("conv_id").cast("string"), F.lit("\n"))).when(F.col("role") == "user", F.concat(F.lit("To: "), F.col("turn").cast("string"), F.lit("\n"))).otherwise("")
    parts = F.array_sort(F.collect_list(F.struct("turn", F.concat(head, "text").alias("x"))))
    mails = t.conversations.groupBy("conv_id").agg(F.array_join(parts["x"], "\n").alias("mail"))
    rows = mails.select("conv_id", X.strip_headers(F.col("mail")).alias("body"), F.regexp_extract("mail", r"(?im)^subject:[ \t]*(.*)$", 1).alias("subject"))
    return rows.withColumn("body_sha", F.sha2("body", 256))


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O' THEN 'rush' WHEN o_orderpriority = '1-URGENT' THEN 'urgent' WHEN o_orderpriority = '3-MEDIUM' THEN 'normal' ELSE 'other' END AS family FROM orders""")
def crosswalk(t):
    """An external label by itself, else by what is before its slash, else the rest."""
    label = F.concat_ws(" / ", "o_orderpriority", "o_orderstatus")
    table = {"1-URGENT / O": "rush", "2-HIGH / O": "rush", "1-URGENT": "urgent", "3-MEDIUM": "normal"}
    return t.orders.select("o_orderkey", X.crosswalk(label, table, "other").alias("family"))


@query("SELECT c_custkey, CASE WHEN lower(trim(v)) IN ('nan', 'none', 'null') THEN '' ELSE v END AS v FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'NaN' WHEN c_custkey % 7 = 1 THEN ' null' ELSE c_name END AS v FROM customer)")
def placeholder_scrub(t):
    v = F.when(F.col("c_custkey") % 7 == 0, "NaN").when(F.col("c_custkey") % 7 == 1, " null").otherwise(F.col("c_name"))
    return t.customer.select("c_custkey", X.scrub(v).alias("v"))


@query("SELECT event_id, try_cast(props->>'k' AS INTEGER) AS k, nullif(event_type, 'error') AS kind FROM events")
def typed_cast(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"), F.nullif("event_type", F.lit("error")).alias("kind"))


@query("SELECT c_custkey, (['Ash', 'Birch', 'Cedar', 'Elm', 'Fir'])[(('0x' || substr(sha256(c_name), 1, 8))::BIGINT % 5 + 1)::INTEGER] AS alias FROM customer")
def pseudonyms(t):
    return t.customer.select("c_custkey", X.pseudonym(F.col("c_name"), ["Ash", "Birch", "Cedar", "Elm", "Fir"]).alias("alias"))


@query("SELECT doc_id, list_sort(list_distinct(regexp_extract_all(lower(text), 'licen[sc]ed?|token|version'))) AS words FROM documents")
def keyword_extract(t):
    return t.documents.select("doc_id", F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("licen[sc]ed?|token|version"), F.lit(0)))).alias("words"))


@query("SELECT event_id, sha256(event_type || chr(10) || props) AS input_sha FROM events")
def request_key(t):
    return t.events.select("event_id", F.sha2(F.concat_ws("\n", "event_type", "props"), 256).alias("input_sha"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN ['lang', 'origin'] ELSE ['lang'] END AS blind_keys,
  list_sort(list_filter([CASE WHEN quality IS NOT NULL THEN 'Quality=' || quality END, CASE WHEN quality IS NOT NULL THEN 'gt_toxic=' || toxic END, CASE WHEN doc_id % 3 = 1 THEN 'expected_kind=' || lang END, CASE WHEN doc_id % 3 = 2 THEN 'my_label_note=' || source END], lambda x: x IS NOT NULL)) AS moved
FROM documents LEFT JOIN labels USING (doc_id)""")
def strip_labels(t):
    """Label-shaped keys leave a blind row's metadata for the labels' side; other keys stay."""
    k = F.col("doc_id") % 3
    pair = lambda key, value: F.struct(F.lit(key).alias("key"), F.col(value).cast("string").alias("value"))
    third = F.when(k == 0, pair("origin", "source")).when(k == 1, pair("expected_kind", "lang")).otherwise(pair("my_label_note", "source"))
    labels = F.when(F.col("quality").isNotNull(), F.array(pair("Quality", "quality"), pair("gt_toxic", "toxic"))).otherwise(F.array().cast("array<struct<key:string,value:string>>"))
    meta = F.map_from_entries(F.concat(F.array(pair("lang", "lang"), third), labels))
    rows = t.documents.join(t.labels, "doc_id", "left").select("doc_id", meta.alias("m"))
    leaks = lambda k, v: is_label_key(k, ["quality", "toxic"])
    moved = F.transform(F.map_entries(F.map_filter("m", leaks)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return rows.select("doc_id", F.array_sort(F.map_keys(F.map_filter("m", lambda k, v: ~leaks(k, v)))).alias("blind_keys"), F.array_sort(moved).alias("moved"))
