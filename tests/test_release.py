"""Releases and records: what is written, swapped, split and gated."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import records as R
from corpuslens.sources import release


def content(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in sorted(Path(folder).rglob("data-*")) if not p.name.endswith(".crc")}


def tables(spark, n, parts):
    rows = [(k, f"v{k * 7919 % 101}", [k, k + 1]) for k in range(n)]
    random.Random(parts).shuffle(rows)
    return {"main": spark.createDataFrame(rows, "k long, v string, l array<long>").repartition(parts), "none": spark.createDataFrame([], "k long, x string")}


KEYS = {"main": ["k"], "none": ["k"]}


def test_two_runs_give_the_same_bytes_and_a_manifest(spark, tmp_path):
    for name, parts in (("a", 1), ("b", 5)):
        release.write_release(tables(spark, 95, parts), f"{tmp_path}/{name}", KEYS, file_rows=30)
    a = content(tmp_path / "a")
    assert a == content(tmp_path / "b") and sorted(a) == [f"main/data-0000{k}.parquet" for k in range(4)] + ["none/data-00000.parquet"]
    assert [r.k for r in spark.read.parquet(f"{tmp_path}/a/main/data-00001.parquet").collect()] == list(range(30, 60))
    assert release.release_problems(spark, f"{tmp_path}/a").count() == 0 and spark.read.parquet(f"{tmp_path}/a/none").columns == ["k", "x"]
    (tmp_path / "b/main/data-00003.parquet").unlink()
    (tmp_path / "b/main/data-00001.parquet").write_bytes(b"other")
    (tmp_path / "b/main/.data-00001.parquet.crc").unlink(missing_ok=True)
    (tmp_path / "b/main/data-00009.parquet").write_bytes(b"new")
    got = {(r.path, r.problem) for r in release.release_problems(spark, f"{tmp_path}/b").collect()}
    assert got == {("main/data-00003.parquet", "missing"), ("main/data-00001.parquet", "changed"), ("main/data-00009.parquet", "not listed")}


def test_a_broken_write_leaves_the_last_release(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/r"
    release.write_release(tables(spark, 10, 2), path, KEYS)
    before = content(path)
    broken = tables(spark, 20, 2)
    broken["main"] = broken["main"].withColumn("v", F.when(F.col("k") == 7, F.raise_error(F.lit("torn"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="torn"):
        release.write_release(broken, path, KEYS)
    whole = release._write_table
    monkeypatch.setattr(release, "_write_table", lambda df, *a: whole(df.limit(3), *a))  # rows get lost
    with pytest.raises(RuntimeError, match="read back"):
        release.write_release(tables(spark, 20, 2), path, KEYS)
    monkeypatch.undo()
    assert content(path) == before and release.release_problems(spark, path).count() == 0 and sorted(p.name for p in tmp_path.iterdir()) == ["r"]
    release.write_release(tables(spark, 20, 2), path, KEYS)
    assert spark.read.parquet(f"{path}/main").count() == 20 and sorted(p.name for p in tmp_path.iterdir()) == ["r"]


def test_submissions_are_split_by_record(spark, tmp_path):
    rng = random.Random(0)
    want, text = [], "<SEC-HEADER>x\n<TYPE-OF>10-K\n</SEC-HEADER>\n"
    for k in range(300):
        body = "\n".join(rng.choices(["a line", "", "<TYPE>not a tag of mine", "é <b>", "x" * 400], k=rng.randrange(30)))
        text += f"<DOCUMENT>\n<TYPE>ex-10.{k}\n<SEQUENCE>{k}\n<FILENAME>f{k}.htm\n" + (f"<DESCRIPTION> d {k} \n" if k % 2 else "") + f"<TEXT>\n{body}\n</TEXT>\n</DOCUMENT>\n"
        want.append((f"EX-10.{k}", str(k), f"f{k}.htm", f"d {k}" if k % 2 else "", body))
    text += "<DOCUMENT>\n<TYPE>GRAPHIC\nno text\n</DOCUMENT>\n<DOCUMENT>\nnothing\n</DOCUMENT>\n<DOCUMENT>\n<FILENAME>open\n<TEXT>\r\nto the\r\nend"
    want += [("GRAPHIC", "", "", "", ""), ("", "", "open", "", "to the\nend")]
    (tmp_path / "s.txt").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = release.read_submissions(spark, f"{tmp_path}/s.txt")
        assert rows.rdd.getNumPartitions() > 3
        got = [(r.type, r.sequence, r.filename, r.description, r.text) for r in rows.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == sorted(want)
    (tmp_path / "empty.txt").write_text("")
    assert release.read_submissions(spark, f"{tmp_path}/empty.txt").count() == 0


FIELDS = [("c", "amount", "money", "gold", "amt", None), ("c", "day", "date", "gold", None, None), ("c", "kind", "text", "deterministic", None, None), ("c", "names", "list", "label", None, ["s"]), ("e", "kind", "text", "deterministic", None, None)]
MAPS = "document_id long, class string, subclass string, method string, gt map<string,string>, presence map<string,string>, derived map<string,string>"


def made(spark):
    rows = [
        (1, "c", "s", "hand", {"amt": "($1.5k)", "day": "March 1, 2020", "names": '["a"," ","b"]'}, {"amt": "populated", "names": "populated"}, {"kind": "s"}),
        (2, "c", "t", None, {"amt": "n/a", "day": "N/A", "names": "x"}, {"amt": "populated", "day": "schema_documented_absence", "names": "populated"}, {}),
        (3, "c", "s", None, {"amt": "none at all", "day": " "}, {"amt": "populated"}, None),
        (4, "c", "s", None, None, None, {"kind": "s"}),
        (5, "e", None, None, {}, {}, {"kind": "z"}),
        (6, "unknown", "s", None, {}, {}, {}),
    ]
    labels = [(3, "amount", "7.00", "populated", "llm:b", False), (3, "amount", "8.00", "populated", "llm:a", False), (4, "names", '["q"]', "populated", "llm:a", False), (2, "names", '["q"]', "populated", "llm:a", True), (1, "day", "2000-01-01", "populated", "override:reviewer:r", True), (1, "amount", "1.00", "populated", "llm:a", False)]
    registry = spark.createDataFrame(FIELDS, R.REGISTRY)
    return R.class_records(spark.createDataFrame(rows, MAPS), registry, spark.createDataFrame(labels, R.LABELS)), registry


def test_cells_of_class_records(spark):
    got = {(r.document_id, r.field): (r.value, r.presence, r.provenance, r.problem) for r in made(spark)[0].collect()}
    pending, gold = (None, R.PENDING, "", None), "gold:unknown"
    assert got == {
        (1, "amount"): ("-1500.00", R.POPULATED, "gold:hand", None), (1, "day"): ("2000-01-01", R.POPULATED, "override:reviewer:r", None), (1, "kind"): ("s", R.POPULATED, "deterministic", None), (1, "names"): ('["a","b"]', R.POPULATED, "gold:hand", None),
        (2, "amount"): (None, R.ABSENT, gold, None), (2, "day"): (None, R.ABSENT, gold, None), (2, "kind"): pending, (2, "names"): (None, R.NONE, "", None),
        (3, "amount"): ("8.00", R.POPULATED, "llm:a", None), (3, "day"): pending, (3, "kind"): pending, (3, "names"): pending,
        (4, "amount"): pending, (4, "day"): pending, (4, "kind"): ("s", R.POPULATED, "deterministic", None), (4, "names"): ('["q"]', R.POPULATED, "llm:a", None),
        (5, "kind"): ("z", R.POPULATED, "deterministic", None),
    }
    wide = R.class_table(*made(spark), "c")
    assert dict(wide.dtypes)["amount"] == "double" and dict(wide.dtypes)["names"] == "array<string>" and dict(wide.dtypes)["day"] == "date"
    assert {(r.document_id, r.amount, tuple(r.names or ())) for r in wide.collect()} == {(1, -1500.0, ("a", "b")), (2, None, ()), (3, 8.0, ()), (4, None, ("q",))}


def test_no_rows_are_dealt_by_class(spark, capsys):
    records, registry = made(spark)
    for df in (records, R.schema_law(records, registry), R.round_trip(records, R.legacy_maps(records, registry), registry)):
        df.explain()  # a class is a language, so its rows would meet the registry in one task
        assert not re.search(r"Exchange hashpartitioning\(class#\d+[L]?, (field#\d+, )?\d+\)[^\n]*\n[^\n]*(Scan|Filter|Project|Join)", capsys.readouterr().out)


def test_labels_without_a_field_or_document(spark):
    registry, rows = spark.createDataFrame(FIELDS, R.REGISTRY), spark.createDataFrame([(1, "c", "s", None, {}, {}, {}), (None, "c", "s", None, {}, {}, {})], MAPS)
    labels = [(1, None, "x", "populated", "llm:a", False), (1, "foreign", "x", "populated", "llm:a", False), (None, "amount", "9.00", "populated", "llm:a", False), (1, "amount", "7.00", "populated", "llm:a", False)]
    got = {(r.document_id, r.field): r.value for r in R.class_records(rows, registry, spark.createDataFrame(labels, R.LABELS)).collect()}
    assert {k: v for k, v in got.items() if v} == {(1, "amount"): "7.00"} and len(got) == 8


def test_written_values(spark):
    rows = [(" [\"a\", \" \"]", "list", '["a"]'), ("\n[\"a\"]", "list", '["a"]'), ("a [b]", "list", '["a [b]"]'), ("[a", "list", None), ("3/1/2020", "date", "2020-03-01"), ("2020-03-01", "date", "2020-03-01"), ("1 March 2020", "date", "2020-03-01"), ("Mar 1, 2020", "date", "2020-03-01"), ("March-1", "date", None), ("n/a", "date", None)]
    got = spark.createDataFrame(rows, "raw string, kind string, want string").select(R.written_value(F.col("raw"), F.col("kind")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_a_gate_fires_on_its_own_mutation_only(spark):
    records, registry = made(spark)
    records = records.cache()
    legacy = R.legacy_maps(records, registry).cache()
    pinned = registry.select("class", "field", "type")
    manifest = records.groupBy("class").agg(F.count("*").alias("rows"), R.digest("document_id", "field", "value", "presence").alias("digest")).cache()
    accepted = registry.select("class", "field", F.lit(4).alias("most"))
    stated = records.groupBy("class", "field").agg(F.count_if(F.col("presence") != R.NONE).alias("applicable"), F.count_if(F.col("presence").isin(R.POPULATED, R.ABSENT)).alias("covered")).cache()
    only_kind = lambda rows: rows.where("value is not null or field <> 'kind'").where("class <> 'e'")

    def fired(rows=records, pins=pinned, maps=legacy, most=accepted, facts=stated, kinds=records):
        gates = [R.registry_parity(registry, pins), R.schema_law(rows, registry), R.round_trip(rows, maps, registry), R.manifest_law(rows, manifest), R.sourced(only_kind(kinds), "kind"), R.residue(rows, most), R.card(rows, facts)]
        return {(r.gate, r["item"]): r.violations for g in gates for r in g.collect()}

    at = lambda i, f: (F.col("document_id") == i) & (F.col("field") == f)
    put = lambda column, i, f, v: records.withColumn(column, F.when(at(i, f), F.lit(v)).otherwise(F.col(column)))
    assert fired() == {}
    assert fired(pins=pinned.where("field <> 'day'")) == {("registry_parity", "c.day"): 1}
    assert fired(rows=records.where(~at(2, "names"))) == {("fields", "c"): 1, ("round_trip", "names"): 1, ("manifest", "c"): 1} and fired(rows=put("value", 1, "amount", "x")) == {("values", "c.amount"): 1, ("round_trip", "amount"): 1, ("manifest", "c"): 1}
    assert fired(rows=put("presence", 2, "amount", "maybe")) == {("codes", "maybe"): 1, ("round_trip", "amount"): 1, ("manifest", "c"): 1, ("card", "c.amount"): 1}
    assert fired(maps=legacy.withColumn("gt", F.transform_values("gt", lambda k, v: F.when(k == "amt", "3").otherwise(v)))) == {("round_trip", "amount"): 2}
    assert fired(kinds=put("value", 1, "kind", "t")) == {("sourced", "c.kind"): 1} and fired(kinds=put("provenance", 1, "kind", "llm:x")) == {("sourced", "c.kind"): 1}
    assert fired(most=accepted.withColumn("most", F.lit(1))) == {("residue", "c.day"): 1, ("residue", "c.kind"): 1}
    assert fired(facts=stated.withColumn("covered", F.col("covered") + F.when(F.col("class") == "e", 1).otherwise(0))) == {("card", "e.kind"): 1}
