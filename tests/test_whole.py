"""Queries on small tables of their own, made so that a part of the work left out shows."""

from __future__ import annotations

import collections
import math

import numpy as np
from pyspark.sql import functions as F

from corpuslens.plans import labels
from corpuslens.plans.queries import QUERIES


def write(spark, folder, **tables):
    for name, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_reply_components_of_all_events(spark, tmp_path):
    events = [(k, "ab"[k // 7 % 2 if k % 5 else 0]) for k in [*range(40), *range(1990, 2020), *range(10**6, 10**6 + 30)]]
    root = {(p, k): (p, k) for k, p in events} | {(p, k - k % 7): (p, k - k % 7) for k, p in events}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = set()
    for k, p in events:
        if k % 7:
            x, y = find((p, k)), find((p, k - k % 7))
            root[max(x, y)] = min(x, y)
            nodes |= {(p, k), (p, k - k % 7)}
    got = {(r.p, r.a): r.root for r in QUERIES["reply_components"](spark, write(spark, tmp_path, events=(events, "event_id long, event_type string"))).collect()}
    assert got == {x: find(x)[1] for x in nodes} and max(k for _, k in got) > 10**6


def test_paired_bootstrap_equals_direct_weights(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(k, int(rng.random() < 0.6), "x" * int(rng.choice([900, 1100]))) for k in range(60)]
    folder = write(spark, tmp_path, labels=([(k, q, 0) for k, q, _ in rows], "doc_id long, quality int, toxic int"), documents=([(k, "en", t) for k, _, t in rows], "doc_id long, lang string, text string"))
    hashes = spark.range(60).select(F.col("id").alias("k"), F.explode(F.sequence(F.lit(1), F.lit(2000))).alias("r")).select("k", "r", F.xxhash64("k", "r").alias("h")).collect()
    top, total = collections.defaultdict(int), collections.defaultdict(int)
    for x in hashes:
        u, w, chance, below = (x.h % 2**64 >> 11) / 2**53, 0, math.exp(-1), math.exp(-1)
        while u >= below and w < 40:
            w += 1
            chance /= w
            below += chance
        gold, pred = rows[x.k][1] == 1, len(rows[x.k][2]) > 1000
        top[x.r] += w * ((gold == pred) - gold)
        total[x.r] += w
    assert len(total) == 2000
    want = np.quantile([top[r] / total[r] for r in total], [0.025, 0.975])
    assert np.allclose(QUERIES["paired_bootstrap"](spark, folder).first(), want)


def test_poisson_weights_go_on(spark):
    row = spark.range(1).select(*[labels.poisson_weight(F.lit(u)).alias(f"w{k}") for k, u in enumerate((0.0, 0.3678, 0.3679, 0.9995, 0.99999, 1 - 2**-53))]).first()
    assert list(row)[:5] == [0, 0, 1, 6, 8] and 14 < row.w5 < 20


def test_evidence_of_few_words(spark, tmp_path):
    han = "".join(chr(0x4E00 + 37 * k % 5000) for k in range(260))
    url = "https://example.org/" + "a/bc" * 60
    texts = ["一" + han + "完", han[:199], "see " + url + " now", url[1:], "x" * 15 + " " + "y" * 15 + " " + "z" * 40, "ab" + "x" * 15 + "  " + "Y" * 15 + " " + "z" * 9 + "tail of it", "🙂" * 50 + " 🙂", "", None, "many words that have at least forty letters in a row"]
    items = [han, url, "x" * 15 + " " + "y" * 15 + " " + "z" * 9, "X" * 14 + " " + "y" * 15 + " " + "z" * 9, "🙂" * 41, "x" * 40, "words that have at least forty letters in a row", "short"]
    fold = lambda s: " ".join((s or "").lower().split())
    want = {(i, d) for i, x in enumerate(items) for d, t in enumerate(texts) if len(fold(x)[:200].strip()) >= 40 and fold(x)[:200].strip() in fold(t)}
    folder = write(spark, tmp_path, benchmark=(list(enumerate(items)), "item_id long, text string"), documents=(list(enumerate(texts)), "doc_id long, text string"))
    got = [(r.item_id, r.doc_id) for r in QUERIES["evidence_containment"](spark, folder).collect()]
    assert sorted(got) == sorted(want) and {i for i, _ in want} == {0, 1, 2, 3, 4, 6}
