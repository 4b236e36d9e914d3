"""The pipeline's stages, each against brute force on its own input."""

from __future__ import annotations

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpuslens.llm.tokenizing import WORD_BPE
from tests.llm.test_operators import brute_components, untouched, word_sets

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, {"input": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).checkpoint()
        tables[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    assert {r.doc_id for r in tables["language_id"]} == {r.doc_id for r in tables["input"] if any(map(str.isalpha, r.text))}
    best = {}
    for r in tables["language_id"]:
        best[r.text] = max(r.doc_id, best.get(r.text, -1))
    assert sorted(r.doc_id for r in tables["exact_dedup"]) == sorted(best.values())
    found = brute_components(word_sets({r.doc_id: r.text for r in tables["exact_dedup"]}))
    assert sorted(r.doc_id for r in tables["near_dedup"]) == sorted({c for _, c in found.values()})
    assert {r.doc_id for r in tables["source_mixing"]} <= {r.doc_id for r in tables["near_dedup"]}
    library = untouched(WORD_BPE)
    copies = collections.Counter(r.doc_id for r in tables["source_mixing"])
    text = {r.doc_id: r.text for r in tables["near_dedup"]}
    total = sum(n * (len(library.encode(text[i], add_special_tokens=False).ids) + 1) for i, n in copies.items())
    assert sum(r.length for r in tables["packing"]) == total


def odd_docs(spark):
    values = [(1, None, None, "s", 9), (2, "", "en", None, 9), (None, "in a long row the words are of this text", "en", None, 9), (3, "12 34 !!", "en", "s", 9), (3, "12 34 !!", "en", "s", 9)]
    values += [(4, "the words of this text are in a long row " * 3000, "en", "s", 9), (5, "the words of this text are in a long row " * 3000, None, "s", 9), (6, "the words of this text and more words", "en", "s", 9), (6, "another text of the same id in the row", "en", "s", 9)]
    return spark.createDataFrame(values, "doc_id long, text string, lang string, source string, n_chars long").withColumn("rank", F.lit(2)).withColumn("sig", F.lit("x"))


@pytest.mark.parametrize(("name", "kept"), [("language_id", [-1, 4, 5, 6, 6]), ("exact_dedup", [-1, 2, 3, 5, 6, 6]), ("near_dedup", [-1, 1, 2, 3, 4, 6, 6])])
def test_stages_on_odd_rows(spark, name, kept):
    odd = odd_docs(spark)
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd, SF)
    assert out.columns == odd.columns and sorted(r.doc_id or -1 for r in out.collect()) == kept
    assert stage(spark, odd.limit(0), SF).count() == 0


def test_near_dedup_of_repeated_and_null_ids_equals_brute_force(spark):
    words = [f"w{k}" for k in range(60)]
    near = [" ".join(words), " ".join([*words, "more"]), " ".join(reversed(words)), " ".join([*reversed(words), "more"])]
    values = [(7, near[0]), (7, near[2]), (3, near[1]), (None, near[3]), (None, near[3]), (None, "a text of its own without an id"), (7, near[0]), (8, ""), (8, ""), (None, None), (9, " \t "), (2, None)]
    docs = spark.createDataFrame(values, "doc_id long, text string").withColumn("digest", F.lit("x")).withColumn("repeats", F.lit(5)).withColumn("unnamed", F.lit(True))
    found = brute_components(word_sets({k: t or "" for k, (_, t) in enumerate(values)}))
    want = [values[k] for k, (n, _) in found.items() if not n]
    for c in {c for n, c in found.values() if n}:
        members = {values[k] for k, (n, own) in found.items() if n and own == c}
        want.append(min(members, key=lambda v: (v[0] is None, v[0] or 0)))
    out = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_mixing_and_packing_on_odd_rows(spark):
    odd, stages = odd_docs(spark), dict(corpus_pipeline.STAGES)
    mixed = stages["source_mixing"](spark, odd, SF)
    counts = collections.Counter((r.doc_id, r.text) for r in mixed.collect())
    assert mixed.columns == odd.columns and counts[3, "12 34 !!"] % 2 == 0 and stages["source_mixing"](spark, odd.limit(0), SF).count() == 0
    packed = stages["packing"](spark, odd, SF).collect()
    assert sum(r.start == 0 for r in packed) == 9 and stages["packing"](spark, odd.limit(0), SF).count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0
