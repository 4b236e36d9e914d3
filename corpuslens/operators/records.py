"""Class records from a registry of fields, their way back to legacy maps, and gates over both.

The registry is a table: class, field, type (text, money, date, list), source (gold,
deterministic, label), legacy_key (the key in old maps; null: the field's name) and
subclasses (those that have the field; null: all). Every plan below is made from its rows,
so a new field is a new row, and it goes to all tasks: by class, rows would meet it in a
task a class. A record is one row a document and field: value (in one written form a type),
presence and provenance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import exprs as X

REGISTRY = "class string, field string, type string, source string, legacy_key string, subclasses array<string>"
LABELS = "document_id long, field string, value string, presence string, provenance string, override boolean"
#: The codes of presence, and what stands for "not applicable" in dates and amounts.
POPULATED, ABSENT, PENDING, NONE = "populated", "schema_documented_absence", "pending_annotation", "not_applicable"
CODES = (POPULATED, ABSENT, PENDING, NONE)
NA = ("N/A", "NA", "NONE")


def is_na(raw: Column) -> Column:
    return F.coalesce(F.upper(F.trim(raw)).isin(*NA), F.lit(False))


def written_value(raw: Column, kind: Column) -> Column:
    """``raw`` in the written form of its type; null if it is empty or doesn't have that type.

    An amount with two decimals, an ISO date, a JSON list of the strings that aren't blank (a text
    that is no list is a list of one), or the text itself.
    """
    some = F.when(F.trim(raw) != "", raw)
    items = F.coalesce(F.from_json(F.when(some.contains("["), some), "array<string>"), F.when(~some.startswith("["), F.array(some)))
    items = F.filter(items, lambda x: F.trim(x) != "")
    money = F.when(~is_na(raw), X.parse_money(some)).cast("decimal(30,2)").cast("string")
    day = F.when(~is_na(raw), X.parse_date(F.trim(some))).cast("string")
    return F.when(kind == "money", money).when(kind == "date", day).when(kind == "list", F.when(F.size(items) > 0, F.to_json(items))).otherwise(some)


def class_records(rows: DataFrame, registry: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """``(document_id, class, subclass, field, type, value, presence, provenance, problem)``, a row for each document and field.

    ``rows``: document_id, class, subclass, method, and the maps gt, presence (by legacy
    key) and derived (by field). Derived values fill deterministic fields. Otherwise the old
    cell is taken over where its code says that it is populated or absent, or where a gold
    field without a code has a value; all else that applies is pending. ``labels`` fill
    pending cells, and others too if they override. A populated cell without a value is
    absent if it says N/A, else it is pending with the problem ``no value``. Of several
    labels of a cell the overriding one counts, then the first by provenance.
    """
    rows = rows.select("document_id", "class", "subclass", "method", "gt", "presence", "derived")
    if labels is not None:  # they meet the document's one row, before its fields are rows
        given = F.struct("value", "presence", "provenance")
        named = labels.join(F.broadcast(registry.select("field")), "field", "left_semi")
        best = named.groupBy("document_id", "field").agg(F.min_by(F.struct(given.alias("cell"), F.col("override").alias("override")), F.struct(~F.col("override"), F.col("provenance"), F.col("value"))).alias("label"))
        rows = rows.join(best.groupBy("document_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "label"))).alias("labels")), "document_id", "left")
    each = rows.join(F.broadcast(registry), "class")
    key = F.coalesce("legacy_key", "field")
    old, code = F.try_element_at("gt", key), F.try_element_at("presence", key)
    each = each.select("document_id", "class", "subclass", "field", "type", "source", F.coalesce("method", F.lit("unknown")).alias("method"), old.alias("raw"), code.alias("code"), F.try_element_at("derived", F.col("field")).alias("made"), (F.col("subclasses").isNull() | F.array_contains("subclasses", F.coalesce("subclass", F.lit("")))).alias("applies"), *([F.try_element_at("labels", F.col("field")).alias("label")] if labels is not None else []))
    each = each.withColumn("read", written_value(F.col("raw"), F.col("type")))
    value, gold = F.col("read"), F.concat(F.lit("gold:"), "method")
    cell = lambda v, presence, source: F.struct(v.cast("string").alias("value"), F.lit(presence).alias("presence"), source.alias("provenance"))
    null, no_one = F.lit(None), F.lit("")
    own = F.when(~F.col("applies"), cell(null, NONE, no_one))
    own = own.when((F.col("source") == "deterministic") & F.col("made").isNotNull(), cell(F.col("made"), POPULATED, F.lit("deterministic")))
    own = own.when(F.col("source") == "deterministic", cell(null, PENDING, no_one))
    own = own.when((F.col("code") == POPULATED) & value.isNotNull(), cell(value, POPULATED, gold))
    own = own.when((F.col("code") == ABSENT) | ((F.col("code") == POPULATED) & is_na(F.col("raw"))), cell(null, ABSENT, gold))
    own = own.when(F.col("code").isNull() & (F.col("source") == "gold") & value.isNotNull(), cell(value, POPULATED, gold)).otherwise(cell(null, PENDING, no_one))
    problem = F.when(F.col("applies") & (F.col("source") != "deterministic") & (F.col("code") == POPULATED) & value.isNull() & ~is_na(F.col("raw")), "no value")
    out = each.withColumns({"cell": own, "problem": problem})
    if labels is not None:
        fills = F.col("label").isNotNull() & (F.col("cell.presence") != NONE) & ((F.col("cell.presence") == PENDING) | F.col("label.override"))
        out = out.withColumn("problem", F.when(~fills, F.col("problem"))).withColumn("cell", F.when(fills, F.col("label.cell")).otherwise(F.col("cell")))
    return out.select("document_id", "class", "subclass", "field", "type", "cell.value", "cell.presence", "cell.provenance", "problem")


def class_table(records: DataFrame, registry: DataFrame, name: str) -> DataFrame:
    """The records of one class as a table with a typed column a field, and maps of presence and provenance."""
    fields = registry.where(F.col("class") == name).select("field", "type").orderBy("field").collect()  # one row a field of the registry
    maps = [F.map_from_entries(F.collect_list(F.struct("field", c))).alias(c) for c in ("value", "presence", "provenance")]
    wide = records.where(F.col("class") == name).groupBy("document_id", "subclass").agg(*maps)
    text = lambda f: F.try_element_at("value", F.lit(f))
    typed = {"money": lambda c: c.try_cast("double"), "list": lambda c: F.from_json(c, "array<string>"), "date": lambda c: c.try_cast("date")}
    return wide.select("document_id", "subclass", *[typed.get(r["type"], lambda c: c)(text(r["field"])).alias(r["field"]) for r in fields], "presence", "provenance")


def legacy_maps(records: DataFrame, registry: DataFrame) -> DataFrame:
    """``(document_id, gt, presence, derived)``: the maps from which ``class_records`` makes these records again."""
    named = records.join(F.broadcast(registry.select("class", "field", "source", F.coalesce("legacy_key", "field").alias("key"))), ["class", "field"]).where(F.col("presence") != NONE)
    entry = lambda k, v, when: F.map_from_entries(F.collect_list(F.when(when, F.struct(F.col(k).alias("k"), F.col(v).alias("v")))))
    made, here = F.col("source") == "deterministic", F.col("presence") == POPULATED
    return named.groupBy("document_id").agg(entry("key", "value", ~made & here).alias("gt"), entry("key", "presence", ~made).alias("presence"), entry("field", "value", made & here).alias("derived"))


def _told(gate: str, bad: DataFrame, item: Column) -> DataFrame:
    return bad.groupBy(item.cast("string").alias("item")).agg(F.count("*").alias("violations")).select(F.lit(gate).alias("gate"), "item", "violations")


def registry_parity(registry: DataFrame, pinned: DataFrame) -> DataFrame:
    """Fields whose type is another in ``pinned(class, field, type)``, or that one side lacks."""
    a, b = registry.select("class", "field", F.col("type").alias("own")), pinned.select("class", "field", F.col("type").alias("pin"))
    return _told("registry_parity", a.join(b, ["class", "field"], "full").where("not (own <=> pin)"), F.concat_ws(".", "class", "field"))


def schema_law(records: DataFrame, registry: DataFrame) -> DataFrame:
    """Documents that lack a registered field, have a foreign or repeated one, an unknown code, or a value against their code or type."""
    wanted = registry.groupBy("class").agg(F.array_sort(F.collect_list("field")).alias("wanted"))
    fields = records.groupBy("document_id", "class").agg(F.array_sort(F.collect_list("field")).alias("own")).join(F.broadcast(wanted), "class", "left")
    keys = _told("fields", fields.where("not (own <=> wanted)"), F.col("class"))
    codes = _told("codes", records.where(~F.coalesce(F.col("presence").isin(*CODES), F.lit(False))), F.coalesce("presence", F.lit("null")))
    wrong = (F.col("value").isNotNull() & ~F.col("value").eqNullSafe(written_value(F.col("value"), F.col("type")))) | (F.col("value").isNotNull() != (F.col("presence") == POPULATED))
    return keys.unionByName(codes).unionByName(_told("values", records.where(wrong), F.concat_ws(".", "class", "field")))


def round_trip(records: DataFrame, legacy: DataFrame, registry: DataFrame) -> DataFrame:
    """Fields whose value or presence isn't the same after going to ``legacy(document_id, gt, presence, derived)`` and back."""
    rows = records.select("document_id", "class", "subclass").distinct().join(legacy, "document_id").withColumn("method", F.lit("legacy"))
    back = class_records(rows, registry).select("document_id", "field", F.col("value").alias("v"), F.col("presence").alias("p"))
    both = records.join(back, ["document_id", "field"], "full")
    return _told("round_trip", both.where("not (value <=> v) or not (presence <=> p)"), F.coalesce("field", F.lit("")))


def digest(*columns: str) -> Column:
    """An order-free digest of a group's rows: the sum of the first 32 bits of their md5."""
    row = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]))
    return F.sum(F.conv(F.substring(row, 1, 8), 16, 10).cast("long"))


def manifest(records: DataFrame) -> DataFrame:
    """``(class, rows, digest)`` of each class."""
    return records.groupBy("class").agg(F.count("*").alias("rows"), digest("document_id", "field", "value", "presence").alias("digest"))


def manifest_law(records: DataFrame, stated: DataFrame) -> DataFrame:
    """Classes whose rows or digest aren't those of ``stated(class, rows, digest)``, or that one side lacks."""
    own = manifest(records).select("class", F.col("rows").alias("n"), F.col("digest").alias("d"))
    return _told("manifest", own.join(stated, "class", "full").where("not (n <=> rows) or not (d <=> digest)"), F.col("class"))


def sourced(records: DataFrame, field: str) -> DataFrame:
    """Documents whose ``field`` has no value, no source, or another value than their subclass."""
    rows = records.where((F.col("field") == field) & (F.col("presence") != NONE))
    good = F.col("provenance").rlike("^(deterministic$|gold:)|reviewer:") & (F.col("value") == F.col("subclass"))
    return _told("sourced", rows.where(~F.coalesce(good, F.lit(False))), F.concat_ws(".", "class", "field"))


def residue(records: DataFrame, accepted: DataFrame) -> DataFrame:
    """Fields that are open in more rows than ``accepted(class, field, most)`` allows, with the rows beyond."""
    open_ = records.where(~F.col("presence").isin(POPULATED, ABSENT, NONE)).groupBy("class", "field").agg(F.count("*").alias("n"))
    over = open_.join(accepted, ["class", "field"], "left").withColumn("violations", F.col("n") - F.coalesce("most", F.lit(0))).where("violations > 0")
    return over.select(F.lit("residue").alias("gate"), F.concat_ws(".", "class", "field").alias("item"), "violations")


def standing(records: DataFrame) -> DataFrame:
    """``(class, field, applicable, covered)``: rows of each field to which it applies, and that are populated or absent."""
    return records.groupBy("class", "field").agg(F.count_if(F.col("presence") != NONE).alias("applicable"), F.count_if(F.col("presence").isin(POPULATED, ABSENT)).alias("covered"))


def card(records: DataFrame, stated: DataFrame) -> DataFrame:
    """Fields whose applicable or covered rows aren't those of ``stated(class, field, applicable, covered)``."""
    own = standing(records).select("class", "field", F.col("applicable").alias("a"), F.col("covered").alias("c"))
    return _told("card", own.join(stated, ["class", "field"], "full").where("not (a <=> applicable) or not (c <=> covered)"), F.concat_ws(".", "class", "field"))
