"""Queries against their SQL on inputs that the given tables lack."""

from __future__ import annotations

import duckdb
import pytest

from corpuslens.plans.queries import ORACLES, QUERIES

from .conftest import plain


def same(spark, folder, name):
    """Rows of ``name`` over the tables in ``folder``, after holding them to its SQL."""
    duck = duckdb.connect()
    for f in folder.glob("*.parquet"):
        duck.sql(f"create view {f.stem} as select * from '{f}/*.parquet'")
    df, want = QUERIES[name](spark, str(folder)), duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == sorted((tuple(map(plain, r)) for r in want.select(", ".join(f'"{c}"' for c in columns)).fetchall()), key=repr)
    return got


#: Words beside letters that aren't ASCII, and texts that are null, empty or end in a line.
TEXTS = ["x ni\u00f1o no\u00e9 \u00e9no token", "x \u00ednot here", "xsin no\u0301 mas", "a not\u00f1", "x without\nlines", "\u00fclicense here", "no tok\u00e9n, not\u00e9 a token", "no\u2003token", "", None, "no\n", "x no"]


@pytest.mark.parametrize("name", ["checklist_findings", "completion_fills", "rule_derivation"])
def test_words_beside_other_letters(spark, tmp_path, name):
    docs = [(i, t, ("en", "es")[i % 2], f"src{i}", len(t or "")) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(10, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert same(spark, tmp_path, name)


def test_fields_without_an_event_are_spread(spark):
    """Their null event ids meet no key of a join, which would bring them all to one task."""
    from pyspark.sql import functions as F

    from corpuslens.operators import review

    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        records = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("f").alias("field"), F.lit("s").alias("target_sha"))
        journal = spark.createDataFrame([(1, "f", 8, "s", "ACCEPT", True, ""), (2, "f", 9, "s", "ACCEPT", True, ""), (3, "f", 7, "old", "REJECT", False, "")], "doc_id long, field string, event_id long, target_sha string, decision string, confirmed boolean, blocker string")
        rows = review.review_states(records, journal, spark.createDataFrame([(8,), (8,)], "event_id long")).withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(rows) == 400 and {r.doc_id: r.status for r in rows if r.decision != "NOT_REVIEWED"} == {1: "checkpointed", 2: "human_confirmed"} and [r.doc_id for r in rows if r.stale] == [3]
    assert max(sum(r.part == p for r in rows) for p in range(4)) < 200
