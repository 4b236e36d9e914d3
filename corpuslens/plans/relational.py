"""Queries of joins, sets, duplicates, orders, threads and gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpuslens.functions import exprs as X
from corpuslens.operators import containment, dedup, grouping, ordering
from corpuslens.plans.base import query

_SPLIT = "CASE WHEN (('0x' || substr(md5(doc_id::VARCHAR), 1, 16))::UBIGINT % 10 * 6 + ('0x' || substr(md5(doc_id::VARCHAR), 17, 16))::UBIGINT % 10) % 10 = 0 THEN 'test' ELSE 'train' END"
_NORMAL = r"trim(regexp_replace(text, '[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))"


@query("SELECT o_orderkey, count(*) AS lines, count(*) FILTER (WHERE l_linenumber = 1) AS firsts FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def aligned_join(t):
    """One row per order from lines summed first; a missing, null or repeated key is an error."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"), F.count_if(F.col("l_linenumber") == 1).alias("firsts"))
    orders = t.orders.select("o_orderkey").join(lines, "o_orderkey", "left_semi")  # orders without lines aren't aligned
    return dedup.aligned(orders, lines, "o_orderkey")


@query("SELECT d.doc_id, d.lang, l.quality, coalesce(l.toxic, -1) AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def left_enrich(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left").select("doc_id", "lang", "quality", F.coalesce("toxic", F.lit(-1)).alias("toxic"))


@query(f"WITH r AS (SELECT sha256({_NORMAL}) AS h, min(doc_id) AS first_id FROM documents WHERE {_SPLIT} = 'train' GROUP BY 1) SELECT d.doc_id, r.first_id FROM documents d JOIN r ON sha256({_NORMAL}) = r.h WHERE {_SPLIT} = 'test'")
def hash_semi_join(t):
    """Test documents whose normalised text a train document has, with the first such one."""
    rows = t.documents.select("doc_id", X.split_of(F.col("doc_id")).alias("split"), F.sha2(X.squeeze(F.col("text")), 256).alias("h"))
    index = rows.where("split = 'train'").groupBy("h").agg(F.min("doc_id").alias("first_id"))
    return rows.where("split = 'test'").join(index, "h").select("doc_id", "first_id")


@query("SELECT coalesce(c_custkey, o_custkey) AS key, c_custkey IS NOT NULL AS in_customer FROM customer FULL JOIN (SELECT DISTINCT o_custkey + 100 AS o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ON c_custkey = o_custkey WHERE c_custkey IS NULL OR o_custkey IS NULL")
def key_symdiff(t):
    orders = t.orders.where("o_orderpriority = '1-URGENT'").select((F.col("o_custkey") + 100).alias("o_custkey")).distinct()
    both = t.customer.select("c_custkey").join(orders, F.col("c_custkey") == F.col("o_custkey"), "full")
    return both.where("c_custkey is null or o_custkey is null").select(F.coalesce("c_custkey", "o_custkey").alias("key"), F.col("c_custkey").isNotNull().alias("in_customer"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def anti_join(t):
    return t.customer.join(t.orders.where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT count(*) AS joined, count(*) FILTER (WHERE l.n = o.n) AS same_lines, count(*) FILTER (WHERE abs(l.total - o.o_totalprice) < 1) AS same_total FROM (SELECT o_orderkey, o_totalprice, o_orderkey % 7 AS n FROM orders WHERE o_orderkey % 5 <> 0) o JOIN (SELECT l_orderkey, count(*) AS n, sum(l_extendedprice::DECIMAL(18, 2)) AS total FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey")
def parity_audit(t):
    """Orders against facts recomputed from their lines, over the keys that both sides have."""
    a = t.orders.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("k"), "o_totalprice", (F.col("o_orderkey") % 7).alias("n"))
    b = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("m"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("total"))
    both = a.join(b, "k")
    return both.agg(F.count("*").alias("joined"), F.count_if(F.col("n") == F.col("m")).alias("same_lines"), F.count_if(F.abs(F.col("total") - F.col("o_totalprice")) < 1).alias("same_total"))


_PAIRS = "(SELECT DISTINCT user_id AS a, ((user_id * 7 + 3) % 50)::BIGINT AS b FROM events)"


@query(f"SELECT a, b FROM {_PAIRS} p WHERE NOT EXISTS (SELECT 1 FROM {_PAIRS} q WHERE q.a = p.b AND q.b = p.a)")
def relation_symmetry(t):
    pairs = t.events.select(F.col("user_id").alias("a"), ((F.col("user_id") * 7 + 3) % 50).alias("b")).distinct()
    return pairs.join(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")


_SPANS = "SELECT l_orderkey AS k, l_returnflag AS cat, l_linenumber * 10 AS s, l_linenumber * 10 + l_quantity::INTEGER AS e FROM lineitem"


@query(f"SELECT p.k, p.cat, p.s, p.e FROM ({_SPANS}) p WHERE EXISTS (SELECT 1 FROM ({_SPANS}) g WHERE g.k = p.k AND g.cat = p.cat AND g.s <> p.s AND p.s < g.e AND g.s < p.e)")
def span_overlap(t):
    spans = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("cat"), (F.col("l_linenumber") * 10).alias("s"), (F.col("l_linenumber") * 10 + F.col("l_quantity").cast("int")).alias("e"))
    p, g = spans.alias("p"), spans.alias("g")
    return p.join(g, F.expr("p.k = g.k and p.cat = g.cat and p.s <> g.s and p.s < g.e and g.s < p.e"), "left_semi")


@query(r"""WITH d AS (SELECT doc_id, lower(trim(regexp_replace(text, '[\s\x{85}\x{a0}\x{2028}]+', ' ', 'g'))) AS n FROM documents), b AS (SELECT item_id, trim(substr(lower(trim(regexp_replace(text, '[\s\x{85}\x{a0}\x{2028}]+', ' ', 'g'))), 1, 200)) AS x FROM benchmark)
SELECT item_id, doc_id FROM b, d WHERE length(x) >= 40 AND contains(n, x)""")
def evidence_containment(t):
    """Items whose first 200 characters a document has, both folded."""
    fold = lambda c: F.lower(X.squeeze(c))
    items = t.benchmark.select(F.col("item_id").alias("item"), F.trim(F.substring(fold(F.col("text")), 1, 200)).alias("excerpt")).where("length(excerpt) >= 40")
    found = containment.contained(t.documents.select(F.col("doc_id").alias("doc"), "text"), items, fold)
    return found.select(F.col("item").alias("item_id"), F.col("doc").alias("doc_id"))


@query("SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def union_all(t):
    return t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).unionByName(t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")))


@query("SELECT 'both' AS kind, count(*) AS n FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'customer_only', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'supplier_only', count(*) FROM (SELECT s_nationkey FROM supplier EXCEPT SELECT c_nationkey FROM customer)")
def set_ops(t):
    c, s = t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k"))
    parts = {"both": c.intersect(s), "customer_only": c.subtract(s), "supplier_only": s.subtract(c)}
    out = None
    for kind, df in parts.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def _hashed(t):
    return t.documents.select("doc_id", "lang", "source", X.split_of(F.col("doc_id")).alias("split"), F.sha2("text", 256).alias("sha"), F.sha2(X.squeeze(F.col("text")), 256).alias("normal"))


@query("SELECT sha256(text) AS sha, count(*) AS n, min(doc_id) AS first_key, max(doc_id) AS last_key, count(DISTINCT lang) AS lang_values, count(DISTINCT source) AS source_values FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_dedup_groups(t):
    return dedup.duplicate_groups(_hashed(t), "sha", "doc_id", ["lang", "source"])


@query(f"SELECT sha256(text) AS sha, doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY (source = 'src0') DESC, {_SPLIT} = 'train' DESC, doc_id) = 1")
def dedup_survivor(t):
    order = [F.desc(F.col("source") == "src0"), F.desc(F.col("split") == "train"), F.asc("doc_id")]
    return dedup.survivors(_hashed(t), "sha", order).select("sha", "doc_id", "source")


@query(f"WITH x AS (SELECT sha256(lower({_NORMAL})) AS normal, sha256(text) AS raw, {_SPLIT} AS split FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN replace(text, ' ', '  ') ELSE text END AS text FROM documents)) SELECT normal, count(*) AS n, count(DISTINCT raw) AS texts, count(DISTINCT split) > 1 AS cross_split FROM x GROUP BY 1 HAVING count(DISTINCT raw) > 1")
def near_dup_groups(t):
    """Texts equal after folding; every other one has double spaces so that copies differ."""
    text = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit(" "), F.lit("  "))).otherwise(F.col("text"))
    rows = t.documents.select(F.sha2(F.lower(X.squeeze(text)), 256).alias("normal"), F.sha2(text, 256).alias("raw"), X.split_of(F.col("doc_id")).alias("split"))
    return dedup.near_groups(rows, "normal", "raw", "split")


@query(f"SELECT doc_id FROM documents WHERE {_SPLIT} = 'test' AND sha256({_NORMAL}) IN (SELECT sha256({_NORMAL}) FROM documents WHERE {_SPLIT} = 'train')")
def leakage_drop(t):
    rows = _hashed(t).select("doc_id", "split", "normal")
    return rows.where("split = 'test'").join(rows.where("split = 'train'").select("normal"), "normal", "left_semi").select("doc_id")


@query("SELECT c_custkey, 'c_mktsegment' AS \"column\", c_mktsegment AS old, CASE WHEN c_custkey % 10 = 1 THEN upper(c_mktsegment) || '!' ELSE c_mktsegment END AS new FROM customer WHERE c_custkey % 10 = 1 AND c_custkey % 10 <> 0 UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment, NULL FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT c_custkey, 'c_nationkey', c_nationkey::VARCHAR, NULL FROM customer WHERE c_custkey % 10 = 0")
def drift_diff(t):
    old = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    seg = F.when(F.col("c_custkey") % 10 == 1, F.concat(F.upper("c_mktsegment"), F.lit("!"))).otherwise(F.col("c_mktsegment"))
    return dedup.drift(old, old.where("c_custkey % 10 <> 0").withColumn("c_mktsegment", seg), "c_custkey", ["c_mktsegment", "c_nationkey"])


_FACTS = "SELECT event_type AS key, count(*) AS n FROM events WHERE {} GROUP BY 1"


@query(f"SELECT coalesce(a.key, b.key) AS key, a.n AS old, b.n AS new FROM ({_FACTS.format('user_id < 40')}) a FULL JOIN ({_FACTS.format('user_id < 45 OR user_id > 48')}) b ON a.key = b.key WHERE a.n IS DISTINCT FROM b.n")
def spec_diff(t):
    facts = lambda rows: rows.groupBy(F.col("event_type").alias("key")).agg(F.count("*").alias("n"))
    a, b = facts(t.events.where("user_id < 40")).withColumnRenamed("n", "old"), facts(t.events.where("user_id < 45 or user_id > 48")).withColumnRenamed("n", "new")
    return a.join(b, "key", "full").where("not (old <=> new)")


@query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INTEGER - 1 AS position, count(*) OVER (PARTITION BY conv_id) AS size FROM conversations")
def thread_position(t):
    return grouping.positions(t.conversations.select("conv_id", "turn"), "conv_id", ["turn"])


@query("SELECT conv_id, turn, list_filter((SELECT list(c2.turn ORDER BY c2.turn) FROM conversations c2 WHERE c2.conv_id = c.conv_id), lambda x: x <> c.turn) AS related FROM conversations c")
def related_ids(t):
    rows = t.conversations.select("conv_id", "turn", F.col("turn").alias("at"))
    return grouping.related(rows, "conv_id", "turn", "at")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def latest_record(t):
    return ordering.first_by(t.events.select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("SELECT user_id, event_id, accepted, size FROM (SELECT user_id, event_id, event_type = 'purchase' AND event_id % 5 = 0 AS accepted, length(props) AS size FROM events) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY accepted DESC, CASE WHEN accepted THEN event_id END DESC NULLS LAST, size DESC, event_id) = 1")
def journal_fold(t):
    rows = t.events.select("user_id", "event_id", ((F.col("event_type") == "purchase") & (F.col("event_id") % 5 == 0)).alias("accepted"), F.length("props").cast("long").alias("size"))
    return ordering.fold_journal(rows, ["user_id"], "accepted", "size", "event_id")


@query("SELECT doc_id, lang, draw_rank FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('s1' || doc_id::VARCHAR), doc_id)::INTEGER AS draw_rank FROM documents) WHERE draw_rank <= 10")
def stratified_draw(t):
    return ordering.draw(t.documents.select("doc_id", "lang"), ["lang"], "doc_id", 10, "s1")


@query("SELECT doc_id, source, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 8)::INTEGER AS chunk FROM documents")
def chunk_plan(t):
    return ordering.chunks(t.documents.select("doc_id", "source"), ["source"], "doc_id", 8)


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // ((count(*) OVER () + 6) // 7) AS slice FROM documents")
def slice_plan(t):
    """Seven slices of equal size in order of doc_id, the last one perhaps smaller."""
    return ordering.parts(t.documents.select("doc_id"), "doc_id", 7)


@query("WITH m AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INTEGER AS t2 FROM conversations), r AS (SELECT *, row_number() OVER (ORDER BY t2, conv_id) AS rn FROM m) SELECT conv_id, turn, t2 AS place, (rn + (rn - 1) // 5)::BIGINT AS position FROM r")
def round_robin_interleave(t):
    out = ordering.interleave(t.conversations.select("conv_id", F.col("turn").alias("key")), "conv_id", "key", 5)
    return out.select("conv_id", F.col("key").alias("turn"), F.col("turn").alias("place"), "position")


@query("SELECT p_partkey, p_brand FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY sha256('r1' || p_partkey), p_partkey) AS rn FROM part) ORDER BY rn, p_brand LIMIT 30")
def round_robin_pick(t):
    """One of each stratum in turn after a seeded shuffle, until 30 are picked."""
    rank = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.sha2(F.concat(F.lit("r1"), F.col("p_partkey").cast("string")), 256), "p_partkey"))
    return t.part.select("p_partkey", "p_brand", rank.alias("rn")).orderBy("rn", "p_brand").limit(30).drop("rn")


@query("SELECT user_id, event_type, count(*) AS size, min(ts) AS first_at, max(ts) AS last_at FROM events GROUP BY ALL HAVING count(*) >= 2 AND max(ts) - min(ts) <= INTERVAL 20 DAY")
def subject_threads(t):
    return grouping.subject_threads(t.events.select("user_id", "event_type", "ts"), ["user_id", "event_type"], "ts", 20)


@query("""WITH RECURSIVE e AS (SELECT event_type AS p, event_id AS a, event_id - event_id % 7 AS b FROM events WHERE event_id % 7 <> 0), u AS (SELECT p, a, b FROM e UNION SELECT p, b, a FROM e), r AS (SELECT p, a, a AS root FROM u UNION SELECT u.p, u.a, r.root FROM u JOIN r ON u.p = r.p AND u.b = r.a)
SELECT p, a, min(root) AS root FROM r GROUP BY ALL""")
def reply_components(t):
    rows = t.events.where("event_id % 7 <> 0")
    edges = rows.select(F.col("event_type").alias("p"), F.col("event_id").alias("a"), (F.col("event_id") - F.col("event_id") % 7).alias("b"))
    return grouping.reply_components(edges, ["p"])


@query("WITH a AS (SELECT p_partkey FROM part ORDER BY sha256('b1' || p_partkey::VARCHAR), p_partkey LIMIT 5) SELECT p_partkey, t.role, p_partkey || '-' || t.role AS member FROM a, (VALUES ('cover'), ('body'), ('annex')) t(role)")
def bundle_expand(t):
    anchors = t.part.select("p_partkey").orderBy(F.sha2(F.concat(F.lit("b1"), F.col("p_partkey").cast("string")), 256), "p_partkey").limit(5)
    out = anchors.withColumn("role", F.explode(F.array(*map(F.lit, ("cover", "body", "annex")))))
    return out.withColumn("member", F.concat_ws("-", F.col("p_partkey").cast("string"), "role"))


@query("SELECT a.doc_id, count(*) AS others FROM documents a JOIN documents b ON a.text = b.text AND a.doc_id <> b.doc_id GROUP BY a.doc_id")
def cross_id_duplicates(t):
    """Documents whose text another id has: from group sizes, not from pairs."""
    rows = t.documents.select("doc_id", F.sha2("text", 256).alias("h"))
    sizes = rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(sizes, "h").select("doc_id", (F.col("n") - 1).alias("others"))


@query("SELECT 'orphan_line' AS gate, count(*) AS violations FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'duplicate_order', count(*) - count(DISTINCT o_orderkey) FROM orders UNION ALL SELECT 'bad_discount', count(*) FROM lineitem WHERE l_discount NOT BETWEEN 0 AND 1 UNION ALL SELECT 'length_mismatch', count(*) FROM documents WHERE n_chars <> length(text) UNION ALL SELECT 'empty_text', count(*) FROM documents WHERE text IS NULL OR trim(text) = ''")
def conformance_gates(t):
    """Each gate is a query of its violations; a gate passes if there are none."""
    gates = {
        "orphan_line": t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti"),
        "bad_discount": t.lineitem.where("l_discount not between 0 and 1"),
        "length_mismatch": t.documents.where("n_chars <> length(text)"),
        "empty_text": t.documents.where("text is null or trim(text) = ''"),
    }
    repeats = t.orders.groupBy("o_orderkey").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"))
    out = repeats.select(F.lit("duplicate_order").alias("gate"), "violations")
    for name, bad in gates.items():
        out = out.unionByName(bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("gate"), "violations"))
    return out


@query("""WITH c AS (SELECT DISTINCT item_id FROM benchmark b, documents d WHERE contains(d.text, b.text)) SELECT count(*) AS checked, count(*) FILTER (WHERE item_id NOT IN (FROM c)) AS missing FROM benchmark""")
def verbatim_check(t):
    """Excerpts that must stand letter for letter in some document, and how many don't."""
    items = t.benchmark.select(F.col("item_id").alias("item"), F.col("text").alias("excerpt"))
    found = containment.contained(t.documents.select(F.col("doc_id").alias("doc"), "text"), items).select(F.col("item").alias("item_id")).distinct()
    return t.benchmark.join(found.withColumn("has", F.lit(1)), "item_id", "left").agg(F.count("*").alias("checked"), F.count_if(F.col("has").isNull()).alias("missing"))
