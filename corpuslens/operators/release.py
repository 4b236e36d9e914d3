"""Release gates: each is a set of findings, and passes if there are none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import exprs as X


def _codes(*rules: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(test, F.lit(code)) for test, code in rules]))


def is_label_key(key: Column, names: list[str]) -> Column:
    """A label's name, or one shaped like one."""
    low = F.lower(key)
    return low.isin(names) | low.startswith("gt_") | low.startswith("expected") | low.contains("label") | low.contains("specialist")


def invariants(default: DataFrame, truth: DataFrame, label_names: list[str]) -> DataFrame:
    """``(gate, key)`` of every violation of a release's invariants.

    ``default`` has filename, doc_text, metadata (a map), split; ``truth`` has filename,
    document_id, split, content_sha256, gt_fields (JSON). Both sides meet once, by
    filename; repeated names and ids come from counts. A split without rows is a finding
    with the table's name as its key.
    """
    a = default.select("filename", F.lit(True).alias("d"), "doc_text", "metadata", F.col("split").alias("ds"))
    b = truth.select("filename", F.lit(True).alias("t"), "document_id", F.col("split").alias("ts"), "content_sha256", "gt_fields")
    both = a.join(b, "filename", "full")
    rule = X.split_of(F.col("filename"))
    found = both.select("filename", F.explode(_codes(
        (F.col("d").isNull(), "missing_in_default"),
        (F.col("t").isNull(), "missing_in_truth"),
        ((F.col("ds") != rule) | (F.col("ts") != rule), "split_rule"),
        (F.col("ds") != F.col("ts"), "split_disagrees"),
        (F.col("content_sha256") != F.sha2(F.coalesce("doc_text", F.lit("")), 256), "hash_drift"),
        (F.col("t") & (F.coalesce("document_id", F.lit("")) == ""), "empty_document_id"),
        (F.col("t") & F.try_parse_json("gt_fields").isNull(), "gt_fields_unreadable"),
        (F.exists(F.map_keys("metadata"), lambda k: is_label_key(k, label_names)), "label_in_metadata"),
    )).alias("gate")).select("gate", F.col("filename").alias("key"))
    repeats = lambda df, column, gate: df.where(f"{column} <> ''").groupBy(F.col(column).alias("key")).count().where("count > 1").select(F.lit(gate).alias("gate"), "key")
    for more in (repeats(default, "filename", "duplicate_filename"), repeats(truth, "filename", "duplicate_filename"), repeats(truth, "document_id", "duplicate_document_id")):
        found = found.unionByName(more)
    for name, df in (("default", default), ("truth", truth)):
        splits = df.agg(F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test"))
        empty = splits.where("train = 0 or test = 0").select(F.lit("empty_split").alias("gate"), F.lit(name).alias("key"))
        found = found.unionByName(empty)
    return found


def conformance(stage: DataFrame, source: DataFrame, spans: DataFrame, fields: list[str], approved: list[str]) -> DataFrame:
    """``(gate, key)`` of every row of a built stage that departs from what it was built from.

    ``stage`` has document_id, split, kind, doc_text, content_sha256, prompt, presence (a
    map by field), provenance (a map), legacy (JSON); ``source`` has document_id, split,
    kind, doc_text, legacy; ``spans`` has document_id, start, text. Gates: row_set,
    split_moved, kind_moved, text_not_cleaned, hash_drift, id_not_opaque, prompt_not_empty,
    presence_keys, unapproved_label, legacy_changed, span_drift.
    """
    old = source.select("document_id", F.lit(True).alias("o"), F.col("split").alias("os"), F.col("kind").alias("ok"), F.col("doc_text").alias("ot"), F.col("legacy").alias("ol"))
    both = stage.withColumn("n", F.lit(True)).join(old, "document_id", "full")
    models = F.filter(F.map_values("provenance"), lambda v: v.startswith("llm:") & ~F.substring(v, 5, 1000).isin(approved))
    rows = both.select("document_id", F.explode(_codes(
        (F.col("o").isNull() | F.col("n").isNull(), "row_set"),
        (F.col("split") != F.col("os"), "split_moved"),
        (F.col("kind") != F.col("ok"), "kind_moved"),
        (F.col("doc_text") != X.clean_text(F.col("ot")), "text_not_cleaned"),
        (F.col("content_sha256") != F.sha2("doc_text", 256), "hash_drift"),
        (F.col("n") & ~F.col("document_id").rlike("^DOC-[0-9a-f]{16}$"), "id_not_opaque"),
        (F.col("n") & (F.coalesce("prompt", F.lit("")) != ""), "prompt_not_empty"),
        (F.col("n") & (F.array_sort(F.map_keys("presence")) != F.array(*map(F.lit, sorted(fields)))), "presence_keys"),
        (F.size(models) > 0, "unapproved_label"),
        (F.col("n") & (F.col("ol") != "") & ~F.col("legacy").eqNullSafe(F.col("ol")), "legacy_changed"),
    )).alias("gate")).select("gate", F.col("document_id").alias("key"))
    text = spans.join(stage.select("document_id", "doc_text"), "document_id", "left")
    wrong = (F.col("start") < 0) | F.expr("not (substring(doc_text, start + 1, length(text)) <=> text)")
    drift = text.where(wrong).select(F.lit("span_drift").alias("gate"), F.col("document_id").alias("key"))
    return rows.unionByName(drift)


def manifest_findings(entries: DataFrame, files: DataFrame) -> DataFrame:
    """``(path, finding)`` of a manifest's ``entries(path, sha256)`` against ``files`` on disk."""
    both = entries.select("path", F.col("sha256").alias("want")).join(files.select("path", F.col("sha256").alias("got")), "path", "full")
    finding = F.when(F.col("want").isNull(), "not_listed").when(F.col("got").isNull(), "missing").when(F.col("want") != F.col("got"), "sha_mismatch")
    return both.select("path", finding.alias("finding")).where("finding is not null")


def verify_dedup(base: DataFrame, kept: DataFrame) -> DataFrame:
    """``(fact, value)`` of a deduplication: rows, removed rows, and three counts that must be 0.

    ``base`` and ``kept`` have doc_id, digest, split. lost_texts: digests of ``base`` that
    no kept row has; surviving_copies: kept rows beyond one a digest; split_moved: kept
    rows in another split than the rule's.
    """
    count = lambda df, name: df.agg(F.count("*").alias("value")).select(F.lit(name).alias("fact"), "value")
    repeats = kept.groupBy("digest").agg((F.count("*") - 1).alias("more")).agg(F.coalesce(F.sum("more"), F.lit(0)).alias("value"))
    out = count(base, "rows").unionByName(count(kept, "kept")).unionByName(count(base.join(kept, "doc_id", "left_anti"), "removed"))
    out = out.unionByName(count(base.select("digest").distinct().join(kept, "digest", "left_anti"), "lost_texts"))
    out = out.unionByName(repeats.select(F.lit("surviving_copies").alias("fact"), "value"))
    return out.unionByName(count(kept.where(F.col("split") != X.split_of(F.col("doc_id"))), "split_moved"))


def label_audit(rows: DataFrame, most: int) -> DataFrame:
    """``(fact, key, value)`` of label maps: ``rows(labels map, declared long)``.

    Rows with labels, distinct tasks, labels a row (mean, least, most), the ``most``
    frequent tasks, and rows whose declared count is at least their number of labels.
    """
    own = rows.select(F.size("labels").alias("n"), "labels", "declared").where("n > 0")
    sums = own.agg(F.count("*").cast("double").alias("rows_with_labels"), F.avg("n").alias("mean"), F.min("n").cast("double").alias("least"), F.max("n").cast("double").alias("most"), F.count_if(F.col("declared") >= F.col("n")).cast("double").alias("consistent"))
    names = sums.columns
    facts = sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("fact"), F.lit("").alias("key"), F.col(c).alias("value")) for c in names])).alias("x")).select("x.*")
    tasks = own.select(F.explode(F.map_keys("labels")).alias("key")).groupBy("key").agg(F.count("*").cast("double").alias("value"))
    kinds = tasks.agg(F.count("*").cast("double").alias("value")).select(F.lit("distinct_tasks").alias("fact"), F.lit("").alias("key"), "value")
    top = tasks.orderBy(F.desc("value"), "key").limit(most).select(F.lit("task").alias("fact"), "key", "value")
    return facts.unionByName(kinds).unionByName(top)


def config_audit(blind: DataFrame, truth: DataFrame) -> DataFrame:
    """``(fact, value)`` of two tables that are to have the same names, splits and kinds.

    Both have name, split, kind. Facts are rows and distinct names of each, names that one
    side lacks, names whose splits differ, split_rule mismatches of each, names with a kind
    in ``blind``, and how many of these kinds agree when folded. Sides meet once, by name.
    """
    fold = lambda c: F.lower(F.trim(c))
    side = lambda df, tag: df.groupBy("name").agg(F.count("*").alias(f"{tag}_n"), F.min("split").alias(f"{tag}_split"), F.min("kind").alias(f"{tag}_kind"), F.count_if(F.col("split") != X.split_of(F.col("name"))).alias(f"{tag}_moved"))
    both = side(blind, "blind").join(side(truth, "truth"), "name", "full")
    has = X.is_populated(F.col("blind_kind")) & F.col("truth_n").isNotNull()
    facts = {
        "blind_rows": F.sum("blind_n"), "truth_rows": F.sum("truth_n"), "blind_names": F.count("blind_n"), "truth_names": F.count("truth_n"),
        "only_blind": F.count_if(F.col("truth_n").isNull()), "only_truth": F.count_if(F.col("blind_n").isNull()), "splits_differ": F.count_if(F.col("blind_split") != F.col("truth_split")),
        "blind_rule_mismatches": F.sum("blind_moved"), "truth_rule_mismatches": F.sum("truth_moved"), "kinds_filled": F.count_if(has), "kinds_agree": F.count_if(has & (fold(F.col("blind_kind")) == fold(F.col("truth_kind")))),
    }
    one = both.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(k) for k, c in facts.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("fact"), F.col(k).alias("value")) for k in facts])).alias("x")).select("x.*")


def surface_status(labels: Column, declared: Column, told: Column) -> Column:
    """How a declared number of labels fits the row's own labels and ``told``, JSON of counts by category.

    ``not_told`` if that is null, blank or no object of numbers, ``sums_differ`` if its counts don't add
    up to ``declared``, ``below_labels`` if fewer are declared than the row has, else ``agrees``.
    """
    counts = F.map_values(F.from_json(told, "map<string,bigint>"))
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.when(total.isNull() | (F.size(counts) == 0), "not_told").when(~total.eqNullSafe(declared.cast("long")), "sums_differ").when(declared < labels, "below_labels").otherwise("agrees")
