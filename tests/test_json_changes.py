"""Texts of one row compared in the row, held to leaves that meet in a join."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from corpuslens.operators import json_diff

from .test_odd_inputs import same


def test_changes_are_the_differences_of_leaves(spark):
    rng = random.Random(2)

    def made(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.3:
            return rng.choice([1, -2.5, True, None, "/tmp/x1 y", "/tmp/x2 y", 'q"\n', "", {}, [], "\u00e9", 10**15])
        return {rng.choice(["a", "b", "c:1", "run_at", "elapsed", "quote", "a.b", "[0]", ""]): made(depth - 1) for _ in range(rng.randrange(4))} if kind < 0.7 else [made(depth - 1) for _ in range(rng.randrange(4))]

    deep = lambda x: json.loads("[" * 12 + json.dumps(x) + "]" * 12)
    rows = [(k, json.dumps(made(k % 12)), json.dumps(made(k % 12))) for k in range(80)]
    rows += [(80, json.dumps(deep(1)), json.dumps(deep(2))), (81, None, "[1]"), (82, "{no", None), (83, "3", "4"), (84, '{"a.b":1,"a":{"b":2}}', '{"a":{"b":1}}')]
    df = spark.createDataFrame(rows, "k long, o string, n string")
    side = lambda c: json_diff.steady(json_diff.leaves(df, "k", F.col(c)))
    want = sorted(json_diff.differences(side("o"), side("n"), "k").collect(), key=repr)
    assert sorted(json_diff.changes(df, "k", "o", "n").collect(), key=repr) == want
    assert {80, 81, 83, 84} <= {r.k for r in want}


def test_deep_diff_needs_no_shuffle(spark, tmp_path):
    """Rows of one id are compared each for itself."""
    events = [(i, ("click", "view")[i % 2], json.dumps({"k": i})) for i in range(9)] + [(5, "view", '{"k": 7}')]
    spark.createDataFrame(events, "event_id long, event_type string, props string").write.parquet(str(tmp_path / "events.parquet"))
    assert same(spark, tmp_path, "json_deep_diff")
