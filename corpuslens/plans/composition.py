"""Queries of composition, coverage and distribution."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpuslens.functions import exprs as X
from corpuslens.operators import stats
from corpuslens.plans.base import query

_TEST = "(('0x' || substr(md5(doc_id::VARCHAR), 1, 16))::UBIGINT % 10 * 6 + ('0x' || substr(md5(doc_id::VARCHAR), 17, 16))::UBIGINT % 10) % 10 = 0"
_TOKENS = "(SELECT doc_id, lang, source, length(text) / 4.0::DOUBLE AS tokens FROM documents)"
BUDGETS = [256, 512, 1024, 4096]


def token_rows(t):
    return t.documents.select("doc_id", "lang", "source", X.tokens(F.length("text")).alias("tokens"))


@query(f"SELECT lang, source, count(*) AS total, count(*) FILTER (WHERE NOT {_TEST}) AS train, count(*) FILTER (WHERE {_TEST}) AS test, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS share_pct, 100.0::DOUBLE * count(*) FILTER (WHERE {_TEST}) / count(*) AS test_pct FROM documents GROUP BY lang, source")
def strata_table(t):
    return stats.strata(t.documents.select("doc_id", "lang", "source"), ["lang", "source"], X.md5_mod(F.col("doc_id").cast("string"), 10) == 0)


@query("SELECT round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 9) AS entropy_bits, max(n) / min(n)::DOUBLE AS imbalance, count(*) AS kinds FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL)")
def imbalance_metrics(t):
    out = stats.entropy_bits(t.documents.groupBy("lang", "source").agg(F.count("*").alias("n")), "n")
    return out.withColumn("entropy_bits", F.round("entropy_bits", 9))


@query(f"""WITH c AS (SELECT lang, {_TEST} AS s, count(*) AS o FROM documents GROUP BY ALL), m AS (SELECT lang, s, o, sum(o) OVER (PARTITION BY lang) * sum(o) OVER (PARTITION BY s) / (sum(o) OVER ())::DOUBLE AS e FROM c)
SELECT round(sum((o - e) * (o - e) / e), 6) AS chi2, ((count(DISTINCT lang) - 1) * (count(DISTINCT s) - 1))::BIGINT AS dof FROM m""")
def chi2_split(t):
    cells = t.documents.select("lang", X.split_of(F.col("doc_id")).alias("s")).groupBy("lang", "s").agg(F.count("*").alias("o"))
    own = lambda *c: F.sum("o").over(Window.partitionBy(*c))
    e = own("lang") * own("s") / own()
    with_e = cells.withColumn("e", e)
    return with_e.agg(F.round(F.sum((F.col("o") - F.col("e")) ** 2 / F.col("e")), 6).alias("chi2"), ((F.count_distinct("lang") - 1) * (F.count_distinct("s") - 1)).alias("dof"))


@query("SELECT n_name, count(*) AS rows, array_to_string(list_slice(list_sort(list(DISTINCT c_mktsegment)), 1, 3), '; ') AS segments, count(DISTINCT nullif(c_mktsegment, '')) AS n_segments, count(*) FILTER (WHERE c_acctbal > 0) AS filled FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def provenance_by_type(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    cells = rows.groupBy("n_name", "c_mktsegment").agg(F.count("*").alias("n"), F.count_if(F.col("c_acctbal") > 0).alias("f"))
    rank = F.row_number().over(Window.partitionBy("n_name").orderBy("c_mktsegment"))
    three = cells.where("c_mktsegment is not null").withColumn("k", rank).where("k <= 3").groupBy("n_name").agg(F.array_join(F.array_sort(F.collect_list("c_mktsegment")), "; ").alias("segments"))
    sums = cells.groupBy("n_name").agg(F.sum("n").alias("rows"), F.count_if(F.col("c_mktsegment") != "").alias("n_segments"), F.sum("f").alias("filled"))
    return sums.join(three, "n_name", "left").select("n_name", "rows", F.coalesce("segments", F.lit("")).alias("segments"), "n_segments", "filled")


@query("SELECT o_orderstatus, count(*) AS filled, min(year(o_orderdate))::INTEGER AS first_year, max(year(o_orderdate))::INTEGER AS last_year FROM orders GROUP BY 1")
def date_span(t):
    year = F.coalesce(F.year(X.parse_date(F.date_format("o_orderdate", "yyyy-MM-dd"))), F.date_format("o_orderdate", "yyyy").try_cast("int"))
    return t.orders.withColumn("y", year).groupBy("o_orderstatus").agg(F.count("y").alias("filled"), F.min("y").alias("first_year"), F.max("y").alias("last_year"))


@query("""WITH x AS (SELECT d.lang, l.quality IS NOT NULL AS quality, contains(d.text, '@') AS contact FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT lang, f.field, count(*) AS n, count(*) FILTER (WHERE f.v) AS filled, count(*) FILTER (WHERE f.v) / count(*)::DOUBLE AS rate FROM x, LATERAL (VALUES ('quality', quality), ('contact', contact)) f(field, v) GROUP BY ALL""")
def fill_rate(t):
    rows = t.documents.select("doc_id", "lang", "text").join(t.labels, "doc_id", "left")
    return stats.fill_rates(rows, ["lang"], {"quality": X.is_populated(F.col("quality")), "contact": F.col("text").contains("@")})


@query(f"SELECT CASE WHEN GROUPING(s) = 1 THEN 'all' ELSE s END AS split, count(*) AS n FROM (SELECT CASE WHEN {_TEST} THEN 'test' ELSE 'train' END AS s FROM documents) GROUP BY ROLLUP (s)")
def row_counts(t):
    rows = t.documents.select(X.split_of(F.col("doc_id")).alias("s"))
    return rows.rollup("s").agg(F.count("*").alias("n")).select(F.coalesce("s", F.lit("all")).alias("split"), "n")


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY n DESC, event_type")
def value_counts(t):
    return t.events.where("event_type is not null").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type")


_DESCRIBE = ", ".join(["count(tokens) AS n", "round(avg(tokens), 6) AS mean", "round(stddev_samp(tokens), 6) AS std", "min(tokens) AS min", *[f"round(quantile_cont(tokens, {v}), 6) AS p{round(100 * v)}" for v in stats.LEVELS], "max(tokens) AS max"])


def _rounded(df):
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, 6).alias(c) if kinds[c] == "double" and c not in ("min", "max") else F.col(c) for c in df.columns])


@query(f"SELECT lang, {_DESCRIBE} FROM {_TOKENS} GROUP BY lang")
def describe_by_type(t):
    return _rounded(stats.describe(token_rows(t), "tokens", ["lang"]))


@query(f"WITH top AS (SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 10) SELECT source, {_DESCRIBE} FROM {_TOKENS} WHERE source IN (FROM top) GROUP BY source")
def describe_top_subclass(t):
    rows = token_rows(t)
    top = rows.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source").limit(10)
    return _rounded(stats.describe(rows.join(top, "source", "left_semi"), "tokens", ["source"]))


_BUDGET_SQL = ", ".join(f"({b})" for b in BUDGETS)


@query(f"SELECT budget, count(*) FILTER (WHERE tokens <= budget) AS within, 100.0::DOUBLE * count(*) FILTER (WHERE tokens <= budget) / count(*) AS pct, count(*) AS n FROM {_TOKENS}, (VALUES {_BUDGET_SQL}) b(budget) GROUP BY budget")
def budget_coverage(t):
    return stats.coverage(token_rows(t), "tokens", BUDGETS, [])


@query(f"SELECT lang, budget, count(*) FILTER (WHERE tokens <= budget) AS within, 100.0::DOUBLE * count(*) FILTER (WHERE tokens <= budget) / count(*) AS pct, count(*) AS n FROM {_TOKENS}, (VALUES {_BUDGET_SQL}) b(budget) GROUP BY lang, budget")
def budget_coverage_by_type(t):
    return stats.coverage(token_rows(t), "tokens", BUDGETS, ["lang"])


KINDS = ["click", "error", "purchase", "signup", "view"]
_MATRIX = "SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS {k}" for k in KINDS) + " FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE value > 190) GROUP BY user_id"


def matrix(t):
    """Users by kinds of event; users with a pending mark (a very large value) are left out."""
    events = t.events.select("user_id", "event_type", "value")
    open_ = events.join(events.where("value > 190").select("user_id").distinct(), "user_id", "left_anti")
    return open_.groupBy("user_id").agg(*[F.count_if(F.col("event_type") == k).alias(k) for k in KINDS])


@query(_MATRIX)
def clause_matrix(t):
    return matrix(t)


_LONG = f"(SELECT k.kind, k.n FROM ({_MATRIX}) m, LATERAL (VALUES {', '.join(f"('{k}', m.{k})" for k in KINDS)}) k(kind, n))"


def _long(t):
    return matrix(t).select(F.expr(f"stack({len(KINDS)}, {', '.join(f"'{k}', {k}" for k in KINDS)}) as (kind, n)"))


@query(f"SELECT kind, count(*) FILTER (WHERE n > 0) AS present, 100.0::DOUBLE * count(*) FILTER (WHERE n > 0) / count(*) AS coverage_pct, round(avg(n) FILTER (WHERE n > 0), 9) AS mean_present, max(n) AS most FROM {_LONG} GROUP BY kind")
def clause_stats(t):
    n = F.col("n")
    return _long(t).groupBy("kind").agg(F.count_if(n > 0).alias("present"), (100 * F.count_if(n > 0) / F.count("*")).alias("coverage_pct"), F.round(F.avg(F.when(n > 0, n)), 9).alias("mean_present"), F.max("n").alias("most"))


@query(f"SELECT kind, round(avg(n), 6) AS mean, round(1.96 * stddev_samp(n) / sqrt(count(*)), 6) AS half FROM {_LONG} WHERE n > 0 GROUP BY kind")
def clause_ci(t):
    return _long(t).where("n > 0").groupBy("kind").agg(F.round(F.avg("n"), 6).alias("mean"), F.round(1.96 * F.stddev_samp("n") / F.sqrt(F.count("*")), 6).alias("half"))


@query(f"SELECT kind, count(*) FILTER (WHERE n > 0) AS present FROM {_LONG} GROUP BY kind ORDER BY present DESC, kind LIMIT 3")
def top_clauses(t):
    return _long(t).groupBy("kind").agg(F.count_if(F.col("n") > 0).alias("present")).orderBy(F.desc("present"), "kind").limit(3)


@query(f"""WITH h AS (SELECT user_id, {', '.join(f"max((event_type = '{k}')::INT) AS {k}" for k in KINDS)} FROM events GROUP BY user_id), n AS (SELECT count(*) AS n FROM h),
p AS ({' UNION ALL '.join(f"SELECT '{a}' AS a, '{b}' AS b, sum({a} * {b}) AS n11, sum({a}) AS n1, sum({b}) AS n2 FROM h" for a in KINDS for b in KINDS)})
SELECT a, b, CASE WHEN n1 * (n - n1) * n2 * (n - n2) = 0 THEN 0 ELSE round((n * n11 - n1 * n2) / sqrt((n1 * (n - n1) * n2 * (n - n2))::DOUBLE), 9) END::DOUBLE AS phi FROM p, n""")
def phi_matrix(t):
    out = stats.phi(t.events.select("user_id", "event_type"), "event_type", "user_id", KINDS)
    return out.withColumn("phi", F.round("phi", 9))


@query("""WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL), k AS (SELECT count(*) AS n FROM part)
SELECT p_brand, sum(c.n)::BIGINT AS parts, count(*) AS kinds, arg_max(p_type, (c.n, 0)) FILTER (WHERE TRUE) IS NOT NULL AS has_mode, (SELECT p_type FROM c c2 WHERE c2.p_brand = c.p_brand ORDER BY n DESC, p_type LIMIT 1) AS mode, 100.0::DOUBLE * sum(c.n) / any_value(k.n) AS coverage_pct FROM c, k GROUP BY p_brand""")
def task_stats(t):
    cells = t.part.groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), "p_type"))["p_type"]
    out = cells.groupBy("p_brand").agg(F.sum("n").alias("parts"), F.count("*").alias("kinds"), F.lit(True).alias("has_mode"), best.alias("mode"))
    return out.withColumn("coverage_pct", 100 * F.col("parts") / F.sum("parts").over(Window.partitionBy()))


@query("SELECT r_name, count(DISTINCT n_nationkey) AS tasks, count(c_custkey) AS rows FROM region JOIN nation ON r_regionkey = n_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY r_name ORDER BY rows DESC, r_name")
def category_coverage(t):
    rows = t.region.join(t.nation, F.col("r_regionkey") == F.col("n_regionkey")).join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.groupBy("r_name").agg(F.count_distinct("n_nationkey").alias("tasks"), F.count("c_custkey").alias("rows")).orderBy(F.desc("rows"), "r_name")


@query("SELECT count(v) AS n, round(avg(v::DECIMAL(18, 4)), 4)::DOUBLE AS mean, round(quantile_cont(v, 0.5), 6) AS median, round(stddev_samp(v), 3) AS std, min(v) AS min, max(v) AS max FROM (SELECT l_extendedprice AS v FROM lineitem WHERE l_extendedprice > 0)")
def amount_stats(t):
    v = t.lineitem.select(F.col("l_extendedprice").cast("string").try_cast("double").alias("v")).where("v > 0")
    sums = v.agg(F.count("v").alias("n"), F.round(F.sum(F.col("v").cast("decimal(18,4)")).cast("double") / F.count("v"), 4).alias("mean"), F.round(F.stddev_samp("v"), 3).alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    middle = stats.percentiles(v, "v", [], {"median": 0.5}).select(F.round("median", 6).alias("median"))
    return sums.join(middle, how="left").select("n", "mean", "median", "std", "min", "max")


@query("""WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT least(30, floor((l_extendedprice - lo) / ((hi - lo) / 30))::INTEGER + 1) AS bin, count(*) AS n FROM lineitem, b GROUP BY 1""")
def amount_histogram(t):
    v = t.lineitem.select(F.col("l_extendedprice").alias("v"))
    low, high = v.agg(F.min("v"), F.max("v")).first()
    if low is None:
        return v.limit(0).select(F.lit(1).alias("bin"), F.lit(1).cast("long").alias("n"))
    at = F.floor((F.col("v") - F.lit(low)) / ((F.lit(high) - F.lit(low)) / 30)).cast("int") + 1
    return v.select(F.least(F.lit(30), at).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))


_CROSS = "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL"


@query(_CROSS)
def crosstab(t):
    return stats.crosstab(t.orders, "o_orderstatus", "o_orderpriority").drop("share")


@query(f"SELECT o_orderstatus, o_orderpriority, n / sum(n) OVER (PARTITION BY o_orderstatus)::DOUBLE AS share FROM ({_CROSS})")
def crosstab_share(t):
    return stats.crosstab(t.orders, "o_orderstatus", "o_orderpriority").drop("n")


@query("SELECT o_orderpriority, count(*) AS n, quantile_cont(date_diff('day', o_orderdate::DATE, l_shipdate::DATE), 0.5) AS median_days FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def date_delay(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate").join(t.lineitem.select("l_orderkey", "l_shipdate"), F.col("o_orderkey") == F.col("l_orderkey"))
    days = rows.select("o_orderpriority", F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("d"))
    return days.groupBy("o_orderpriority").agg(F.count("d").alias("n")).join(stats.percentiles(days, "d", ["o_orderpriority"], {"median_days": 0.5}), "o_orderpriority")


@query("SELECT o_orderstatus, min(year(o_orderdate))::INTEGER AS first, max(year(o_orderdate))::INTEGER AS last, quantile_cont(year(o_orderdate), 0.5) AS median, count(*) AS n FROM orders GROUP BY 1")
def temporal_summary(t):
    rows = t.orders.select("o_orderstatus", F.year("o_orderdate").alias("y"))
    sums = rows.groupBy("o_orderstatus").agg(F.min("y").alias("first"), F.max("y").alias("last"), F.count("*").alias("n"))
    return sums.join(stats.percentiles(rows, "y", ["o_orderstatus"], {"median": 0.5}), "o_orderstatus")


@query("SELECT year(o_orderdate)::INTEGER AS y, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")
def year_timeline(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("y"), "o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT 'k' AS key, count(DISTINCT props->>'k') AS n FROM events UNION ALL SELECT 'event_type', count(DISTINCT event_type) FROM events")
def cardinality(t):
    maps = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("event_type"), F.col("event_type")))
    return t.events.select(F.explode(maps).alias("key", "value")).groupBy("key").agg(F.count_distinct("value").alias("n"))


_RATIO = f"SELECT lang, source, count(*) AS total, count(*) FILTER (WHERE {_TEST}) / count(*)::DOUBLE AS test_share FROM documents GROUP BY ALL"


def _ratio(t):
    s = stats.strata(t.documents.select("doc_id", "lang", "source"), ["lang", "source"], X.md5_mod(F.col("doc_id").cast("string"), 10) == 0)
    return s.select("lang", "source", "total", (F.col("test") / F.col("total")).alias("test_share"))


@query(f"SELECT *, test_share < 0.05 OR test_share > 0.25 AS skewed FROM ({_RATIO})")
def strata_ratio(t):
    return _ratio(t).withColumn("skewed", (F.col("test_share") < 0.05) | (F.col("test_share") > 0.25))


@query(f"SELECT * FROM ({_RATIO}) WHERE total < 10")
def minority_strata(t):
    return _ratio(t).where("total < 10")


@query(f"WITH top AS (SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 15), l AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL) SELECT x.source, round(quantile_cont(tokens, 0.5), 6) AS median, (SELECT lang FROM l WHERE l.source = x.source ORDER BY n DESC, lang LIMIT 1) AS modal FROM {_TOKENS} x WHERE source IN (FROM top) GROUP BY x.source")
def length_by_subclass(t):
    rows = token_rows(t)
    counts = rows.groupBy("source", "lang").agg(F.count("*").alias("n"))
    modal = counts.groupBy("source").agg(F.sum("n").alias("m"), F.min(F.struct((-F.col("n")).alias("neg"), "lang"))["lang"].alias("modal"))
    top = modal.orderBy(F.desc("m"), "source").limit(15)
    middle = stats.percentiles(rows, "tokens", ["source"], {"median": 0.5})
    return middle.join(top, "source").select("source", F.round("median", 6).alias("median"), "modal")


_CODES = """SELECT lang, code, count(*) AS n FROM (SELECT d.lang, CASE WHEN l.quality IS NOT NULL THEN 'populated' WHEN d.source = 'src0' THEN 'pending' ELSE 'gap' END AS code FROM documents d LEFT JOIN labels l USING (doc_id)) GROUP BY ALL"""


@query(f"SELECT lang, coalesce(sum(n) FILTER (WHERE code = 'populated'), 0)::BIGINT AS populated, coalesce(sum(n) FILTER (WHERE code = 'pending'), 0)::BIGINT AS pending, coalesce(sum(n) FILTER (WHERE code = 'gap'), 0)::BIGINT AS gap, 100.0::DOUBLE * coalesce(sum(n) FILTER (WHERE code = 'populated'), 0) / sum(n) FILTER (WHERE code <> 'pending') AS coverage_pct FROM ({_CODES}) GROUP BY lang")
def coverage_matrix(t):
    rows = t.documents.select("doc_id", "lang", "source").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    code = F.when(X.is_populated(F.col("quality")), "populated").when(F.col("source") == "src0", "pending").otherwise("gap")
    out = rows.select("lang", code.alias("code")).groupBy("lang").pivot("code", ["populated", "pending", "gap"]).count().fillna(0)
    return out.withColumn("coverage_pct", 100 * F.col("populated") / (F.col("populated") + F.col("gap")))


@query("""WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source), m AS (SELECT (list_sort(list(n)))[(count(*) // 2 + 1)::INTEGER] AS upper_median FROM c)
SELECT source, n, n < upper_median / 2.0 AS scarce, row_number() OVER (ORDER BY n, source)::INTEGER AS rank FROM c, m""")
def expansion_priority(t):
    """Strata by scarcity: less than half of the upper median; one row a stratum is ranked."""
    counts = t.documents.groupBy("source").agg(F.count("*").alias("n"))
    every = F.array_sort(F.collect_list("n").over(Window.partitionBy()))
    middle = F.element_at(every, (F.size(every) / 2).cast("int") + 1)
    return counts.select("source", "n", (F.col("n") < middle / 2).alias("scarce"), F.row_number().over(Window.orderBy("n", "source")).alias("rank"))


@query("SELECT count(*) AS rows, count(DISTINCT doc_id) AS ids, count(*) FILTER (WHERE n > 1) AS duplicate_rows, count(DISTINCT CASE WHEN n > 1 THEN h END) AS duplicate_groups FROM (SELECT doc_id, sha256(text) AS h, count(*) OVER (PARTITION BY text) AS n FROM documents)")
def baseline_audit(t):
    groups = t.documents.select("doc_id", F.sha2("text", 256).alias("h")).groupBy("h").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids"))
    many = F.col("n") > 1
    return groups.agg(F.sum("n").alias("rows"), F.sum("ids").alias("ids"), F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("duplicate_rows"), F.count_if(many).alias("duplicate_groups"))


@query(f"SELECT lang, count(*) AS rows, count(*) FILTER (WHERE {_TEST}) AS test_rows, count(*) FILTER (WHERE (source < 'src3') <> ({_TEST})) AS mismatches FROM documents GROUP BY lang")
def split_rule_audit(t):
    """A published split (here: some sources) against the rule, by language."""
    rows = t.documents.select("lang", (F.col("source") < "src3").alias("published"), (X.split_of(F.col("doc_id")) == "test").alias("rule"))
    return rows.groupBy("lang").agg(F.count("*").alias("rows"), F.count_if("rule").alias("test_rows"), F.count_if(F.col("published") != F.col("rule")).alias("mismatches"))


@query("SELECT event_type, count(*) AS n, event_type IN ('click', 'view', 'purchase') AS known FROM events GROUP BY event_type")
def vocab_coverage(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n")).withColumn("known", F.col("event_type").isin("click", "view", "purchase"))


@query("SELECT 'rows' AS fact, '' AS key, count(*) AS value FROM documents UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source")
def release_facts(t):
    """Facts of one table from one pass: grouping sets as (fact, key, value)."""
    sets = t.documents.select("lang", "source").groupingSets([[], ["lang"], ["source"]], "lang", "source").agg(F.count("*").alias("value"), F.grouping_id().alias("g"))
    fact = F.when(F.col("g") == 3, "rows").when(F.col("g") == 1, "lang").otherwise("source")
    return sets.select(fact.alias("fact"), F.when(F.col("g") == 3, "").when(F.col("g") == 1, F.col("lang")).otherwise(F.col("source")).alias("key"), "value")


@query("SELECT lang, count(*) AS applicable, count(l.quality) AS covered, (count(*) - count(l.quality))::BIGINT AS residue FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY lang")
def coverage_residue(t):
    rows = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return rows.groupBy("lang").agg(F.count("*").alias("applicable"), F.count("quality").alias("covered")).withColumn("residue", F.col("applicable") - F.col("covered"))


@query("SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) / count(*) OVER (PARTITION BY lang)::DOUBLE AS y FROM documents")
def ecdf(t):
    return stats.ecdf(t.documents.select("doc_id", "lang", "n_chars"), "n_chars", "doc_id", "lang")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20")
def top_k_longest(t):
    return t.documents.select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(20)
