"""Queries of class records: a class is a language, a subclass a source, a field a row of the registry.

Old cells come from the documents and labels. Some of them are odd by id (N/A amounts,
codes without values, corrections). The gates run over a release in which one row or
statement in some is changed; their SQL evaluates each gate over the same release.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.operators import records as R
from corpuslens.plans.base import query
from corpuslens.sources.tables import written

#: class, field, type, source, legacy_key, subclasses
FIELDS = [
    (c, *f)
    for c in ("de", "en", "es", "fr")
    for f in (
        ("amount", "money", "gold", "amt", None),
        ("grade", "text", "gold", "quality", None),
        ("kind", "text", "deterministic", None, None),
        ("risk", "text", "label", None, ["src0", "src1", "src2", "src3"] if c == "fr" else None),
        ("seen", "date", "gold", None, None),
        ("words", "list", "gold", "kw", None),
    )
    if (c, f[0]) != ("de", "words")
]


def registry(t) -> DataFrame:
    return t.rows(FIELDS, R.REGISTRY)


def _rows(t) -> DataFrame:
    k, m = F.col("doc_id"), lambda n: F.col("doc_id") % n
    graded = t.labels.groupBy("doc_id").agg(F.max("quality").cast("string").alias("quality"))
    first = F.col("first")
    d = t.documents.select("doc_id", "lang", "source", "n_chars", F.substring_index("text", " ", 1).alias("first")).join(graded, "doc_id", "left")
    gt = F.create_map(
        F.lit("amt"), F.when(m(7) == 0, "N/A").when(m(7) == 1, "").otherwise(F.concat(F.lit("$"), F.col("n_chars").cast("string"), F.lit("k"))),
        F.lit("quality"), F.col("quality"),
        F.lit("seen"), F.when(m(5) > 0, F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 900).cast("int")), "M/d/yyyy")),
        F.lit("kw"), F.when(m(3) == 0, F.to_json(F.array(first, F.lit(" "), F.lit("x")))).otherwise(first),
    )
    presence = F.map_from_entries(F.array_compact(F.array(*[F.when(when, F.struct(F.lit(key), code)) for key, when, code in [
        ("amt", m(7) < 6, F.lit(R.POPULATED)), ("quality", F.col("quality").isNotNull(), F.lit(R.POPULATED)), ("seen", F.lit(True), F.when(m(5) > 0, R.POPULATED).otherwise(R.ABSENT)),
    ]])))
    derived = F.map_from_entries(F.array_compact(F.array(F.when(m(11) > 0, F.struct(F.lit("kind"), F.col("source"))))))
    return d.select(k.alias("document_id"), F.col("lang").alias("class"), F.col("source").alias("subclass"), F.when(m(2) == 0, "hand").alias("method"), gt.alias("gt"), presence.alias("presence"), derived.alias("derived"))


def _given(t) -> DataFrame:
    """Labels of risk for the rated documents, and corrections of grades for some."""
    risk = t.labels.select(F.col("doc_id").alias("document_id"), F.lit("risk").alias("field"), F.col("toxic").cast("string").alias("value"), F.lit(R.POPULATED).alias("presence"), F.lit("llm:m1").alias("provenance"), F.lit(False).alias("override"))
    fixed = t.documents.where("doc_id % 50 = 0").select(F.col("doc_id").alias("document_id"), F.lit("grade").alias("field"), F.lit("5").alias("value"), F.lit(R.POPULATED).alias("presence"), F.lit("override:reviewer:a").alias("provenance"), F.lit(True).alias("override"))
    kept = t.documents.where("doc_id % 50 = 1").select(F.col("doc_id").alias("document_id"), F.lit("seen").alias("field"), F.lit("2000-01-01").alias("value"), F.lit(R.POPULATED).alias("presence"), F.lit("llm:m1").alias("provenance"), F.lit(False).alias("override"))
    return risk.unionByName(fixed).unionByName(kept)


_REGISTRY = "(VALUES " + ", ".join("(" + ", ".join("NULL" if x is None else str(x) if isinstance(x, list) else f"'{x}'" for x in f) + ")" for f in FIELDS) + ") reg(class, field, type, source, legacy_key, subclasses)"
_CELLS = f"""g AS (SELECT doc_id, max(quality)::VARCHAR AS quality FROM labels GROUP BY doc_id), o AS (SELECT d.doc_id, lang, d.source AS subclass, CASE doc_id % 2 WHEN 0 THEN 'gold:hand' ELSE 'gold:unknown' END AS gold, n_chars, quality, string_split(text, ' ')[1] AS w FROM documents d LEFT JOIN g USING (doc_id)),
c AS (SELECT doc_id AS document_id, class, subclass, field, type, quality, w, n_chars, gold, subclasses IS NULL OR list_contains(subclasses, subclass) AS applies FROM o JOIN {_REGISTRY} ON class = lang),
own AS (SELECT *, CASE WHEN NOT applies THEN 'not_applicable' WHEN field = 'kind' THEN CASE WHEN document_id % 11 > 0 THEN 'populated' ELSE 'pending_annotation' END WHEN field = 'amount' THEN CASE document_id % 7 WHEN 0 THEN 'schema_documented_absence' WHEN 1 THEN 'pending_annotation' ELSE 'populated' END
  WHEN field = 'grade' THEN CASE WHEN quality IS NULL THEN 'pending_annotation' ELSE 'populated' END WHEN field = 'seen' THEN CASE WHEN document_id % 5 > 0 THEN 'populated' ELSE 'schema_documented_absence' END WHEN field = 'words' AND (trim(w, ' ') <> '' OR document_id % 3 = 0) THEN 'populated' ELSE 'pending_annotation' END AS code FROM c),
val AS (SELECT *, CASE WHEN code <> 'populated' THEN NULL WHEN field = 'kind' THEN subclass WHEN field = 'amount' THEN (n_chars * 1000)::DECIMAL(30, 2)::VARCHAR WHEN field = 'grade' THEN quality WHEN field = 'seen' THEN (DATE '2020-01-01' + (document_id % 900)::INTEGER)::VARCHAR ELSE NULL END AS v FROM own),
lab AS (SELECT doc_id AS document_id, 'risk' AS field, toxic::VARCHAR AS lv, 'llm:m1' AS lp, false AS force FROM labels UNION ALL SELECT doc_id, 'grade', '5', 'override:reviewer:a', true FROM documents WHERE doc_id % 50 = 0 UNION ALL SELECT doc_id, 'seen', '2000-01-01', 'llm:m1', false FROM documents WHERE doc_id % 50 = 1),
rec AS (SELECT document_id, class, subclass, field, type, CASE WHEN fills THEN lv WHEN field = 'words' AND code = 'populated' THEN to_json(CASE WHEN document_id % 3 = 0 THEN list_filter([w, 'x'], lambda x: trim(x, ' ') <> '') ELSE [w] END)::VARCHAR ELSE v END AS value,
  CASE WHEN fills THEN 'populated' ELSE code END AS presence, CASE WHEN fills THEN lp WHEN code IN ('not_applicable', 'pending_annotation') THEN '' WHEN field = 'kind' THEN 'deterministic' ELSE gold END AS provenance,
  CASE WHEN NOT fills AND field = 'amount' AND document_id % 7 = 1 THEN 'no value' END AS problem FROM (SELECT val.*, lv, lp, lv IS NOT NULL AND applies AND (code = 'pending_annotation' OR force) AS fills FROM val LEFT JOIN lab USING (document_id, field)))"""


@query(f"WITH {_CELLS} SELECT * FROM rec")
def class_records(t):
    """Value, presence and provenance of each registered field; labels fill pending cells only, but for overrides."""
    return R.class_records(_rows(t), registry(t), _given(t))


@query(f"""WITH {_CELLS} SELECT document_id, subclass, max(value) FILTER (WHERE field = 'amount')::DOUBLE AS amount, max(value) FILTER (WHERE field = 'grade') AS grade, max(value) FILTER (WHERE field = 'kind') AS kind, max(value) FILTER (WHERE field = 'risk') AS risk, max(value) FILTER (WHERE field = 'seen')::DATE AS seen,
  json_extract_string(max(value) FILTER (WHERE field = 'words'), '$[*]') AS words, count(*) FILTER (WHERE presence = 'populated') AS n_populated FROM rec WHERE class = 'en' GROUP BY ALL""")
def class_table(t):
    """One class as a typed table, its columns made from the registry."""
    wide = R.class_table(R.class_records(_rows(t), registry(t), _given(t)), registry(t), "en")
    return wide.withColumn("n_populated", F.size(F.map_filter("presence", lambda k, v: v == R.POPULATED)).cast("long")).drop("presence", "provenance")


_MD5 = "('0x' || substr(md5(concat_ws(chr(31), document_id::VARCHAR, field, coalesce(value, chr(0)), coalesce(presence, chr(0)))), 1, 8))::BIGINT"
_GATES = f"""WITH {_CELLS}, rel AS (SELECT document_id, class, subclass, CASE WHEN document_id % 67 = 1 AND field = 'risk' THEN 'riskk' ELSE field END AS field, type, CASE WHEN document_id % 73 = 1 AND field = 'amount' AND value IS NOT NULL THEN 'a lot' WHEN document_id % 79 = 1 AND field = 'kind' THEN 'src0' ELSE value END AS value,
  CASE WHEN document_id % 83 = 1 AND field = 'seen' THEN 'maybe' ELSE presence END AS presence, provenance FROM rec WHERE NOT (document_id % 61 = 1 AND field = 'grade')),
want AS (SELECT class, list(field ORDER BY field) AS wanted FROM {_REGISTRY} GROUP BY class), own2 AS (SELECT document_id, class, list(field ORDER BY field) AS fields FROM rel GROUP BY ALL),
legal AS (SELECT *, value IS NULL OR CASE type WHEN 'money' THEN regexp_matches(value, '^[0-9]+[.][0-9][0-9]$') ELSE true END AS fits FROM rel),
back AS (SELECT document_id, field, value, presence FROM rec), man AS (SELECT class, count(*) + (class = 'es')::INTEGER AS rows, sum({_MD5})::BIGINT AS digest FROM rel GROUP BY class),
st AS (SELECT class, field, count(*) FILTER (WHERE presence <> 'not_applicable') AS applicable, count(*) FILTER (WHERE presence IN ('populated', 'schema_documented_absence')) AS covered FROM rel GROUP BY ALL)
SELECT 'registry_parity' AS gate, class || '.' || field AS item, 1::BIGINT AS violations FROM {_REGISTRY} FULL JOIN (SELECT class AS pc, field AS pf, CASE WHEN field = 'seen' AND class = 'en' THEN 'text' ELSE type END AS pin FROM {_REGISTRY} WHERE NOT (class = 'fr' AND field = 'kind')) ON class = pc AND field = pf WHERE type IS DISTINCT FROM pin
UNION ALL SELECT 'fields', class, count(*) FROM own2 LEFT JOIN want USING (class) WHERE fields IS DISTINCT FROM wanted GROUP BY class
UNION ALL SELECT 'codes', presence, count(*) FROM rel WHERE presence NOT IN ('populated', 'schema_documented_absence', 'pending_annotation', 'not_applicable') GROUP BY presence
UNION ALL SELECT 'values', class || '.' || field, count(*) FROM legal WHERE NOT fits OR (value IS NOT NULL) <> (presence = 'populated') GROUP BY ALL
UNION ALL SELECT 'round_trip', field, count(*) FROM (SELECT coalesce(r.field, b.field) AS field, r.value, r.presence, b.value AS v, b.presence AS p FROM rel r FULL JOIN back b ON r.document_id = b.document_id AND r.field = b.field) WHERE value IS DISTINCT FROM v OR presence IS DISTINCT FROM p GROUP BY field
UNION ALL SELECT 'manifest', class, 1 FROM (SELECT class, count(*) AS n, sum({_MD5})::BIGINT AS d FROM rel GROUP BY class) JOIN man USING (class) WHERE n <> rows OR d <> digest
UNION ALL SELECT 'sourced', class || '.' || field, count(*) FROM rel WHERE field = 'kind' AND presence <> 'not_applicable' AND NOT coalesce((provenance = 'deterministic' OR provenance LIKE 'gold:%' OR contains(provenance, 'reviewer:')) AND value = subclass, false) GROUP BY ALL
UNION ALL SELECT 'residue', class || '.' || field, count(*) - CASE WHEN field = 'grade' THEN 1000000000 WHEN field = 'risk' AND class <> 'fr' THEN 1000000000 ELSE 0 END FROM rel WHERE presence NOT IN ('populated', 'schema_documented_absence', 'not_applicable') GROUP BY class, field HAVING count(*) > CASE WHEN field = 'grade' THEN 1000000000 WHEN field = 'risk' AND class <> 'fr' THEN 1000000000 ELSE 0 END
UNION ALL SELECT 'card', class || '.' || field, 1 FROM st WHERE class = 'de' AND field = 'seen'"""


@query(_GATES)
def record_gates(t):
    """Nine gates over a release that has one fault for each."""
    reg = registry(t)
    made = written(R.class_records(_rows(t), reg, _given(t)))
    m, field = lambda n: F.col("document_id") % n == 1, F.col("field")
    release = made.where(~(m(61) & (field == "grade")))
    release = release.withColumn("presence", F.when(m(83) & (field == "seen"), "maybe").otherwise(F.col("presence")))
    release = release.withColumn("value", F.when(m(73) & (field == "amount") & F.col("value").isNotNull(), "a lot").when(m(79) & (field == "kind"), "src0").otherwise(F.col("value")))
    release = written(release.withColumn("field", F.when(m(67) & (field == "risk"), "riskk").otherwise(field)))
    pinned = reg.where("not (class = 'fr' and field = 'kind')").withColumn("type", F.when((F.col("class") == "en") & (field == "seen"), "text").otherwise(F.col("type")))
    manifest = R.manifest(release).withColumn("rows", F.col("rows") + (F.col("class") == "es").cast("int"))
    accepted = reg.where("field = 'grade' or (field = 'risk' and class <> 'fr')").select("class", "field", F.lit(10**9).alias("most"))
    stated = R.standing(release).withColumn("applicable", F.col("applicable") + ((F.col("class") == "de") & (field == "seen")).cast("int"))
    gates = [R.registry_parity(reg, pinned), R.schema_law(release, reg), R.round_trip(release, R.legacy_maps(made, reg), reg), R.manifest_law(release, manifest), R.sourced(release, "kind"), R.residue(release, accepted), R.card(release, stated)]
    out = gates[0]
    for g in gates[1:]:
        out = out.unionByName(g)
    return out
