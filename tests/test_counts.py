"""Allocation, bootstrap, JSON leaves, references, evidence and moved spans, each against plain Python."""

from __future__ import annotations

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslens.functions import exprs as X
from corpuslens.functions import udfs
from corpuslens.operators import bootstrap, json_diff, ordering, references


def seats(counts, total):
    """One seat at a time, by the rule as it is told."""
    some = {k: v for k, v in counts.items() if v > 0}
    if total < len(some):
        return {k: 1 for k in sorted(some, key=lambda k: (-some[k], k))[:total]}
    exact = {k: total * v / sum(some.values()) for k, v in some.items()}
    out = {k: max(1, math.floor(x)) for k, x in exact.items()}
    while sum(out.values()) > total:
        for k in sorted(out, key=lambda k: (exact[k], k)):
            if sum(out.values()) > total and out[k] > 1:
                out[k] -= 1
    for k in sorted(out, key=lambda k: (round(out[k] - exact[k], 9), k))[: total - sum(out.values())]:
        out[k] += 1
    return out


@pytest.mark.parametrize("total", [0, 1, 5, 9, 10, 13, 40, 1000])
def test_seats_with_floors_and_taken_back(spark, total):
    rng = random.Random(total)
    for counts in ({f"s{k}": v for k, v in enumerate([900, 800, 3, 2, 1, 1, 1, 0, 1])}, {f"s{k:02}": rng.randint(0, 50) for k in range(30)}, {"a": 0}):
        df = spark.createDataFrame(list(counts.items()), "k string, w long")
        got = {r.k: r.seats for r in ordering.largest_remainder(df, "k", "w", total).collect()}
        assert got == {k: seats(counts, total).get(k, 0) for k in counts}
        if any(counts.values()):
            assert sum(got.values()) == total


def test_bootstrap_of_several_metrics_is_direct_weighting(spark):
    rng = np.random.default_rng(2)
    rows = [(int(k), *map(bool, rng.random(3) < (0.6, 0.5, 0.7))) for k in range(1300)]
    df = spark.createDataFrame(rows, "k long, gold boolean, a boolean, b boolean").repartition(3)
    n = 40
    seeds = np.array([r[0] for r in df.select(F.xxhash64("k")).orderBy("k").collect()])
    w = bootstrap.weights(seeds, n)
    direct = [[r.w for r in spark.range(1300).select(F.xxhash64("id", F.lit(j).cast("int")).alias("h"), "id").orderBy("id").selectExpr("shiftrightunsigned(h, 11) * double('1.1102230246251565E-16') as w").collect()] for j in (1, n)]
    cdf = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
    assert [w[:, 0].tolist(), w[:, n - 1].tolist()] == [[float(np.sum(cdf <= u)) for u in d] for d in direct] and 0.9 < w.mean() < 1.1

    def metric(name, side, weight):
        tp, fp, fn, tn = (sum(x for x, r in zip(weight, rows, strict=True) if (r[1], r[side]) == c) for c in ((1, 1), (0, 1), (1, 0), (0, 0)))
        every = tp + fp + fn + tn
        if name == "micro_f1":
            return 2 * tp / (2 * tp + fp + fn)
        chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / every**2
        return ((tp + tn) / every - chance) / (1 - chance)

    gold = F.col("gold")
    counts = {f"{s}_{k}": c.cast("int") for s in "ab" for k, c in (("tp", gold & F.col(s)), ("fp", ~gold & F.col(s)), ("fn", gold & ~F.col(s)), ("tn", ~gold & ~F.col(s)))}
    at = lambda s, k: F.col(f"{s}_{k}")
    cells = lambda s: {("y", "y"): at(s, "tp"), ("n", "y"): at(s, "fp"), ("y", "n"): at(s, "fn"), ("n", "n"): at(s, "tn")}
    metrics = {"micro_f1": tuple(bootstrap.micro_f1(at(s, "tp"), at(s, "fp"), at(s, "fn")) for s in "ab"), "cohen_kappa": tuple(bootstrap.kappa(cells(s)) for s in "ab")}
    got = {r.metric: (r.point, r.low, r.high) for r in bootstrap.paired_intervals(df, "k", counts, metrics, n).collect()}
    for name in metrics:
        diffs = sorted(metric(name, 3, w[:, j]) - metric(name, 2, w[:, j]) for j in range(n))
        one = np.ones(1300)
        assert got[name] == pytest.approx((metric(name, 3, one) - metric(name, 2, one), diffs[1], diffs[38]), abs=6e-5)
    assert {(r.point, r.low, r.high) for r in bootstrap.paired_intervals(df.limit(0), "k", counts, metrics, n).collect()} == {(0.0, 0.0, 0.0)}


def test_kappa_at_its_edges(spark):
    for a, b, want in ((0.0, 0.0, 0.0), (5.0, 0.0, 1.0), (0.0, 5.0, 0.0)):
        cells = {("x", "x"): F.lit(a), ("x", "y"): F.lit(b)}
        assert spark.range(1).select(bootstrap.kappa(cells).alias("k")).first().k == want


def flat(value, path=""):
    pairs = [(f"{path}.{k}" if path else k, v) for k, v in value.items()] if isinstance(value, dict) else [(f"{path}[{k}]", v) for k, v in enumerate(value)] if isinstance(value, list) else []
    out = {} if pairs else {path: value}
    for p, v in pairs:
        out |= flat(v, p)
    return out


def test_leaves_of_any_depth(spark):
    rng = random.Random(1)

    def made(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.3:
            return rng.choice([1, -2.5, True, None, "x y", 'q"\n', "", {}, [], "é", 10**15])
        return {rng.choice("abcdef"): made(depth - 1) for _ in range(rng.randrange(4))} if kind < 0.7 else [made(depth - 1) for _ in range(rng.randrange(4))]

    values = [made(k % 9) for k in range(120)]
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in enumerate(values)] + [(900, None), (901, "{no json")], "k long, t string")
    got = {}
    found = json_diff.leaves(df, "k", F.col("t"))
    for r in found.collect():
        got.setdefault(r.k, {})[r.path] = json.loads(r.leaf)
    assert got == {k: flat(v) for k, v in enumerate(values)}
    assert "Python" not in found._jdf.queryExecution().toString() and json_diff.leaves(df.limit(0), "k", F.col("t")).count() == 0


def test_steady_values_and_differences(spark):
    one = {"t_utc": 1, "x": {"run_at": "2020", "elapsed": 1.5, "path": "in /tmp/ab/c.txt!", "quote": "/tmp/ab", "list_ts": [3, {"k": 1}]}, "at": 1, "flag_at": True}
    two = {"t_utc": 2, "x": {"run_at": "2021", "elapsed": 9, "path": "in /tmp/zz!", "quote": "/tmp/zz", "list_ts": [4, {"k": 2}]}, "at": 2, "flag_at": False, "new": {}}
    rows = lambda v: json_diff.steady(json_diff.leaves(spark.createDataFrame([(1, json.dumps(v))], "k long, t string"), "k", F.col("t")))
    got = {(r.path, r.old, r.new) for r in json_diff.differences(rows(one), rows(two), "k").collect()}
    assert got == {("x.quote", '"/tmp/ab"', '"/tmp/zz"'), ("at", "1", "2"), ("flag_at", "true", "false"), ("new", None, "{}"), ("x.list_ts[1].k", "1", "2")}


def test_dangling_references(spark):
    rows = spark.createDataFrame([(1, [2, 3, 3, None, 9], 1), (2, [], None), (3, None, 7), (None, [1, 8], 8)], "k long, many array<long>, one long")
    removed = spark.createDataFrame([(9,), (9,), (1,)], "k long")
    got = sorted([tuple(r) for r in references.dangling(rows, "k", ["many", "one"], removed).collect()], key=str)
    assert got == sorted([(1, "many", 9, "removed"), (3, "one", 7, "missing"), (None, "many", 8, "missing"), (None, "one", 8, "missing")], key=str)
    assert {r.reason for r in references.dangling(rows, "k", ["one"]).collect()} == {"missing"} and references.dangling(rows.limit(0), "k", ["many"]).count() == 0


def test_evidence_is_all_or_nothing(spark):
    cases = [("a b a b", ["b", "a b"], "id", [(2, 3, "b"), (0, 3, "a b")]), ("a b", ["b", "z"], "id", []), ("a b", ["b"], "money", []), ("a b", [" "], "id", []), ("a b", [None], "id", []), ("a b", None, "id", []), (None, ["a"], "id", []), ("😀x" * 200, ["x"], "id", [(1, 2, "x")]), ("y" * 300, ["y" * 241], "id", []), ("y" * 300, ["y" * 240], "id", [(0, 240, "y" * 240)]), ("a", [], "id", [])]
    df = spark.createDataFrame([(k, *c[:3]) for k, c in enumerate(cases)], "k long, t string, v array<string>, kind string")
    got = [[tuple(x) for x in r.e] for r in df.select("k", references.evidence(F.col("t"), F.col("v"), F.col("kind")).alias("e")).orderBy("k").collect()]
    assert got == [c[3] for c in cases]


def test_spans_move_with_the_cleanup(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices(["a", "é", "😀", "\r", "\n", "\r\n", " ", "\x07", "\t", " "], k=rng.randrange(40))) for _ in range(150)] + ["", None, "\r\n" * 3000]
    spans = [[(rng.randint(-1, 30), rng.randint(0, 30)) for _ in range(rng.randrange(5))] for _ in texts]
    df = spark.createDataFrame([(k, t, s) for k, (t, s) in enumerate(zip(texts, spans, strict=True))], "k long, t string, s array<struct<start:int,stop:int>>")
    got = {r.k: r for r in df.select("k", X.clean_text(F.col("t")).alias("clean"), X.remap_spans(F.col("t"), F.col("s")).alias("s")).collect()}
    for k, (t, own) in enumerate(zip(texts, spans, strict=True)):
        place, kept = [], []
        for i, c in enumerate(t or ""):
            place.append(len(kept))
            if c == "\r" and t[i + 1 : i + 2] == "\n" or (c < " " and c not in "\r\n\t"):
                continue
            kept.append({"\r": "\n", " ": " "}.get(c, c))
        place.append(len(kept))
        assert t is None or got[k].clean == "".join(kept)
        for (a, b), s in zip(own, got[k].s, strict=True):
            if t is None or not 0 <= a <= b <= len(t):
                assert tuple(s) == (None, None, None, "out of text")
            else:
                quote = "".join(kept[place[a] : place[b]])
                assert tuple(s) == (place[a], place[b], quote, None if quote else "lost")
    assert udfs.removed_places("a\r\nb\x00").tolist() == [1, 4]
