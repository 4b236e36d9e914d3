"""Lexical search, toxicity and the filter audit against brute force, and on odd inputs."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuslens.llm import filter_audit, lexical_search, toxicity
from corpuslens.llm.store import Workspace

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    values = [(1, None, "s"), (2, "", None), (None, "the quick brown fox", ""), (None, "the quick brown fox", ""), (3, "12 34 !!", "s"), (3, "12 34 !!", "s"), (4, "ab " * 70_000, "s"), (5, "AB " * 9000, None), (6, "x" * 200_000, "s"), (4, "other Text é", "s"), (7, "the quick brown fox", "t")]
    out = spark.createDataFrame(values, "doc_id long, text string, source string")
    for name in ("rank", "score", "mask", "part", "own", "digest", "t", "at", "first", "n", "query", "toxic", "id"):
        out = out.withColumn(name, F.lit(1))
    return out


def brute_search(docs, queries, k=50):
    """Every score of every document, by the formula."""
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in queries:
        found = []
        for (doc, counts), size in zip(held, sizes, strict=True):
            score = 0
            for t in set(terms_of(text)) & set(counts):
                m = 100 - 50 + (50 * size * n) // total
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def test_op11_is_brute_force_on_many_ties_and_small_shards(spark, monkeypatch):
    """Shards of 2 KB, trees of four levels, equal texts and equal bounds."""
    monkeypatch.setattr(lexical_search, "FAN", 3)
    monkeypatch.setattr(lexical_search, "SHARD_BYTES", 2000)
    monkeypatch.setattr(lexical_search, "BLOCK_QUERIES", 4)
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(40)] + ["Äpfel", "naïve", "X9"]
    docs = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 3, 12])))) for k in range(400)] + [(1000 + k, "w1 w2 w3") for k in range(90)]
    queries = [(k, " ".join(rng.choices(vocabulary, k=6))) for k in range(9)] + [(9, None), (10, ""), (11, "w1, W2. w3"), (12, "nowhere"), (11, "x9")]
    work = Workspace(spark, "test-search")
    rows = work.write(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), "docs")
    asked = spark.createDataFrame(queries, "item_id long, text string")
    got = sorted([tuple(r) for r in lexical_search.search(rows, asked).collect()], key=str)
    assert got == brute_search(docs, queries)
    monkeypatch.setattr(lexical_search, "MOST_TERMS", 1)  # then the index holds all terms
    assert sorted([tuple(r) for r in lexical_search.search(rows, asked, 5).collect()], key=str) == brute_search(docs, queries, 5)


def test_op11_prunes_but_opens_equal_bounds():
    rng = np.random.default_rng(1)
    n, fan = 5000, lexical_search.FAN
    doc = np.concatenate([np.sort(rng.choice(n, 900, False)), np.array([4321])])
    term, value = np.repeat([0, 1], [900, 1]), np.concatenate([rng.integers(1, 50, 900), [900]])
    levels = lexical_search.tree_levels(term, doc, value, n)
    assert len(levels[-1][0]) == 2 and [len(x[0]) >= len(y[0]) for x, y in itertools.pairwise(levels)] == [True] * (len(levels) - 1)
    best = lexical_search.Best(1)
    opened = lexical_search.descend(levels, np.array([0, 1]), np.array([1, 100]), list(range(n)), best)
    assert best.heap[0][2] == -4321 and opened < 12 < n / fan
    flat = lexical_search.tree_levels(np.zeros(n, int), np.arange(n), np.full(n, 7), n)
    best = lexical_search.Best(2)
    ids = list(reversed(range(n)))  # the smallest ids are in the last documents
    assert lexical_search.descend(flat, np.array([0]), np.array([3]), ids, best) == sum(-(-n // fan**k) for k in range(1, len(flat)))
    assert sorted(-x[2] for x in best.heap) == [0, 1]


def test_op11_on_odd_inputs(spark, odd):
    queries = [(None, "the fox"), (1, "ab x other"), (1, "ab"), (2, "é text"), (3, "text é"), (4, "12")]
    asked = spark.createDataFrame(queries, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("score", F.lit(1))
    got = sorted([tuple(r) for r in lexical_search.search(odd, asked).collect()], key=str)
    assert got == brute_search([(r.doc_id, r.text) for r in odd.collect()], queries)
    assert lexical_search.search(odd.limit(0), asked).count() == 0 and lexical_search.search(odd, asked.limit(0)).count() == 0
    assert lexical_search.search(odd.where("doc_id = 1"), asked).count() == 0


def brute_audit(masks, names):
    """Every order applied from left to right; ``masks``: (part, failing letters, good, toxic)."""
    out = {}
    for part in {m[0] for m in masks}:
        rows = [m for m in masks if m[0] == part]
        removed_by = Counter()
        for order in itertools.permutations(names):
            left = list(rows)
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                fails = [m for m in rows if f in m[1]]
                left = [m for m in left if f not in m[1]]
                removed_by[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(fails) - len(gone), sum(m[1] == {f} for m in rows), sum(m[2] for m in gone), sum(m[3] for m in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audit_rows(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


@pytest.mark.parametrize("names", ["A", "XY", "ABC", "ABCDEF"])
def test_op13_polynomial_is_every_order(spark, names):
    rng = random.Random(len(names))
    masks = [(rng.choice(["p", "q", ""]), {f for f in names if rng.random() < 0.4}, rng.random() < 0.3, rng.random() < 0.2) for _ in range(120)] + [("clean", set(), True, False)] * 3
    rows = spark.createDataFrame([(p, sum(1 << names.index(f) for f in m), g, t) for p, m, g, t in masks], "part string, mask int, good_lost boolean, toxic_lost boolean")
    got = audit_rows(filter_audit.interactions(filter_audit.mask_counts(rows, ["good_lost", "toxic_lost"]), names, ["good_lost", "toxic_lost"]))
    assert got == brute_audit(masks, names)
    # the value of a filter is the sum of its rows' shares among the filters that they fail
    for part in {m[0] for m in masks}:
        for f in names:
            share = sum(Fraction(1, len(m[1])) for m in masks if m[0] == part and f in m[1]) * math.factorial(len(names))
            assert {v[6] for (p, order, step), v in got.items() if p == part and order[step - 1] == f} == {share}


def test_op13_on_odd_inputs(spark, odd):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (5, None, 1), (None, 1, 1), (3, 1, None), (99, 1, 1)], "doc_id long, quality int, toxic int").withColumn("part", F.lit("z"))
    good, toxic = {4, 3}, {4, 5}
    held = [(r.doc_id, r.text or "", r.source or "") for r in odd.collect()]
    masks = []
    for i, t, s in held:
        words = WORD.findall(t)
        fails = {f for f, bad in {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}.items() if bad}
        smaller = [j for j, u, _ in held if u == t and j is not None and (i is None or j < i)]
        masks.append((s, fails | ({"E"} if smaller else set()), i in good, i in toxic))
    assert audit_rows(filter_audit.audit_filters(odd, labels)) == brute_audit(masks, "ABCDE")
    assert filter_audit.audit_filters(odd.limit(0), labels).count() == 0
    assert filter_audit.audit_filters(odd, labels.limit(0)).count() == 120 * 5 * len({m[0] for m in masks})


def test_op12_gradients_are_slopes():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in toxicity.fresh(rng).items()}
    x = toxicity.encode(pa.array(["you idiot, über die Straße und so weiter " * 2, "a b", "", None, "x y z " * 20 + "ñandú chllaes"]))
    windows, labels = np.append(x.first[:-2], x.first[-2] + 2), np.array([1.0, 0, 0, 0, 1])
    _, g = toxicity.gradients(w, x, windows, labels)
    for name in w:
        for i in rng.permutation(np.argwhere(np.abs(g[name]) > 1e-9))[:5].tolist():
            at, own = tuple(i), w[name][tuple(i)]
            sides = []
            for e in (1e-5, -1e-5):
                w[name][at] = own + e
                sides.append(toxicity.gradients(w, x, windows, labels)[0])
            w[name][at] = own
            assert abs((sides[0] - sides[1]) / 2e-5 - g[name][at]) < 1e-6 + 1e-4 * abs(g[name][at]), name


def plain_logit(w, words, chars):
    """The network on one window, one term at a time."""
    vectors = [np.concatenate([w["word"][i], np.tanh(w["char"][c].mean(0))]) for i, c in zip(words, chars, strict=True)]
    sig = lambda v: 1 / (1 + np.exp(-v))
    states = {}
    for d, order in (("f", range(len(vectors))), ("b", reversed(range(len(vectors))))):
        h = np.zeros(toxicity.HIDDEN)
        for t in order:
            a, u = w[f"in_{d}"] @ vectors[t] + w[f"bias_{d}"][:, 0], w[f"rec_{d}"] @ h
            r, z = sig(a[:8] + u[:8]), sig(a[8:16] + u[8:16])
            h = (1 - z) * np.tanh(a[16:] + r * u[16:]) + z * h
            states[d, t] = h
    both = np.array([np.concatenate([states["f", t], states["b", t]]) for t in range(len(vectors))]).reshape(-1, 16)
    share = np.exp(both @ w["focus"])
    return float((share * (both @ w["out"])).sum() / (share.sum() + 1e-6) + w["base"][0])


def test_op12_scores_all_windows_of_whole_texts():
    """Vectorised windows against one term at a time; the texts' neighbours make no difference."""
    w = toxicity.fresh(np.random.default_rng(3))
    texts = ["one", None, "a " * 8, "A b, c! d" * 31, "Ärger über alles " * 200, "", "x" * 5000]
    x = toxicity.encode(pa.array(texts, pa.string()))
    logits = toxicity.window_logits(w, x)
    for k, text in enumerate(texts):
        alone = toxicity.encode(pa.array([text], pa.string()))
        chars = np.split(alone.chars, alone.starts[1:])
        n = len(terms_of(text))
        assert len(alone.words) == n
        windows = range(max(1, math.ceil(n / 8) - 1))
        assert [plain_logit(w, alone.words[8 * i : 8 * i + 16], chars[8 * i : 8 * i + 16] if n else []) for i in windows] == pytest.approx(logits[x.first[k] : x.first[k + 1] - 1].tolist(), abs=1e-4)
        assert max(windows) * 8 + 16 >= n


def toxic_rows(n=600):
    """Invented prose; toxic texts have a word from a few, or one that begins like these."""
    rng = random.Random(2)
    plain = ["".join(rng.choices("abdegiklmnorstu", k=rng.randint(2, 7))) for _ in range(300)]
    rows = []
    for k in range(n):
        words = rng.choices(plain, k=rng.choice([20, 60, 300]))
        toxic = k % 3 == 0
        if toxic:
            for _ in range(2 + len(words) // 60):
                words[rng.randrange(len(words))] = rng.choice(["vlexo", "quarzt", "zyffe" + rng.choice(plain), "Zyffe" + rng.choice(plain) + ","])
        rows.append((k, " ".join(words), int(toxic)))
    return rows


def test_op12_learns_words_and_beginnings_of_words(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if got[r[0]].held_out]
    assert sum(got[i].predicted == t for i, _, t in held) >= 0.95 * len(held)
    worst = max((r for r in rows if r[2] and got[r[0]].predicted), key=lambda r: len(r[1]))
    part = terms_of(worst[1])[got[worst[0]].top_term :][:16]
    assert any(re.match("vlexo|quarzt|zyffe", t) for t in part)


def test_op12_labels_of_held_out_rows_and_other_columns_change_nothing(spark):
    rows = toxic_rows(200)
    docs = spark.createDataFrame([(*r[:2], "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    labels = lambda flip: spark.createDataFrame([(i, 1 - t if flip and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, _, t in rows], "doc_id long, toxic int")
    one = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels(False)).collect()}
    two = {r.doc_id: r.score for r in toxicity.score_toxicity(docs.withColumn("lang", F.lit(None)).withColumn("source", F.lit("t")), labels(True)).collect()}
    assert one == pytest.approx(two, abs=1e-5)


def test_op12_on_odd_inputs(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.score_toxicity(odd, none).collect()} == {(0.0, 0)}
    one_label = spark.createDataFrame([(4, 1), (3, None), (None, 0)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(odd, one_label).collect()} == {0.0}
    both = spark.createDataFrame([(3, 0), (4, 1), (4, 0), (6, 0), (7, 0), (2, 0)], "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    rows = toxicity.score_toxicity(odd, both).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_toxicity(odd.limit(0), both).count() == 0
