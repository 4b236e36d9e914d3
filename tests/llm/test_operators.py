"""Each operator against brute force or an exact round trip, and on odd inputs."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import struct
import time
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from corpuslens.llm import exact_dedup, graph, langid, license_scan, mixing, ngram_join, packing, quality_mcd, registry, rows, secret_scan, shingles, sstable, token_rollup, tokenizing
from corpuslens.llm.store import Workspace
from corpuslens.llm.tokenizing import BYTE_BPE, WORD_BPE, TextEncoder, vocabulary_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with clashing names."""
    values = [(1, None, None, "s", 9), (2, "", "en", None, 9), (None, "the quick brown fox jumps", "en", None, 9), (3, "12 34 !!", "en", "s", 9), (3, "12 34 !!", "en", "s", 9)]
    values += [(4, "ab " * 9000, "en", "s", 9), (5, "AB " * 9000, None, "s", 9), (6, "x" * 50_000, "en", "s", 9), (4, "other text", "en", "s", 9)]
    return spark.createDataFrame(values, "doc_id long, text string, lang string, source string, n int").withColumn("kept", F.lit(1)).withColumn("rank", F.lit(2)).withColumn("score", F.lit(3))


def word_sets(texts, width=5):
    out = {}
    for i, t in texts.items():
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
        out[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    return out


def brute_components(sets, threshold=75):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed=1, n=120):
    """Families of texts with growing edits: chains of links and pairs near the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    out = {}
    for family in range(6):
        base = rng.choices(vocabulary, k=90)
        for k in range(n // 6):
            words = list(base)
            for _ in range(rng.randrange(5)):
                words[rng.randrange(90)] = rng.choice(vocabulary)
            out[family * 1000 + k] = " ".join(words)
            base = words if rng.random() < 0.3 else base
    return out


def test_op1_equals_brute_force(spark, docs, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in registry.QUERIES["op1_ngram_jaccard_join"](spark, SF).collect()}
    assert got == brute_components(word_sets(texts))
    made = near_copies()
    df = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(df, range_shingles=500).collect()}
    want = brute_components(word_sets(made))
    assert got == want and len({c for _, c in want.values()}) > 6


def test_op1_filters_lose_nothing():
    rng = np.random.default_rng(5)
    for _ in range(300):
        x, y = (np.sort(rng.choice(200, rng.integers(1, 120), replace=False)).astype(np.uint64) for _ in range(2))
        away = len(np.setxor1d(x, y))
        assert ngram_join.apart(x, y, 10**6) <= away
        assert np.bitwise_count((ngram_join.parity_sketch(x) ^ ngram_join.parity_sketch(y)).view(np.uint64)).sum() <= away


def test_op1_odd_rows(odd):
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in ngram_join.ngram_components(odd).collect())
    assert got == [(-1, 1, -1), (1, 0, 1), (2, 0, 2), (3, 1, 3), (3, 1, 3), (4, 1, 4), (4, 1, 4), (5, 1, 4), (6, 1, 6)]
    kept = ngram_join.drop_near_copies(odd)
    # each of the two texts with doc_id 4 is in a component of its own
    assert kept.columns == odd.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 4, 6]
    assert ngram_join.ngram_components(odd.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 150)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in graph.components(df, Workspace(spark, "t"), "c").collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 150), 100)}


def test_shingles_of_unicode_and_ends():
    import pyarrow as pa

    values = ["É b\x0bc", None, "", "a", "A b c d e f", " lead and trail \n", "x" * 100 + " y"]
    ends, hashes = shingles.shingle_sets(pa.array(values))
    sizes = np.diff(ends, prepend=0).tolist()
    assert sizes == [len(s) for s in word_sets(dict(enumerate(v or "" for v in values))).values()]
    assert len(set(hashes.tolist())) == len(hashes)


def brute_secrets(text):
    spans = [("assign", *m.span()) for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return spans + [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]


def test_op2_base_equals_the_patterns(spark, texts):
    got = {r.doc_id: r for r in registry.QUERIES["op2_secret_scan"](spark, SF).collect()}
    extra = {10**6: "TOKEN='abcdef' ſecret=abcdefg api_key : x1 AKIA" + "A" * 16 + " secret=token:abcdefgh", 10**6 + 1: "é" * 5 + "0123456789abcdef" * 2}
    df = spark.createDataFrame(list(extra.items()), "doc_id long, text string")
    got |= {r.doc_id: r for r in secret_scan.scan_secrets(df).collect()}
    for i, t in {**texts, **extra}.items():
        spans = brute_secrets(t)
        assert [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")] == [got[i].n_assign, got[i].n_access, got[i].n_hex]
        assert got[i].base_sha256 == hashlib.sha256(secret_scan.joined(spans).encode()).hexdigest()


def test_op2_windows_equal_direct_entropy():
    rng = random.Random(3)
    for size in (8, 20):
        text = "".join(rng.choice("aab0123xyzQ") for _ in range(120))
        hot = {k for k in range(len(text) - size + 1) if secret_scan.window_entropy(collections.Counter(text[k : k + size]), size) >= 2.7}
        covered = {p for a, b in secret_scan.entropy_runs(text, size, 2.7) for p in range(a, b)}
        assert covered == {p for k in hot for p in range(k, k + size)}


def test_op2_allow_list_and_odd_rows(odd):
    assert secret_scan.scan("id 123e4567-e89b-12d3-a456-426614174000")[1] == []
    assert secret_scan.scan("key Zk3vQ9xT7bLm2Wc8RfY5 end")[1] == [("ent_alnum", 4, 24)]
    assert [r.spans for r in secret_scan.scan_secrets(odd).collect()] == [""] * 9


def duck(sql):
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    q = c.sql(sql)
    return sorted(map(repr, q.select(", ".join(sorted(q.columns))).fetchall()))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_native_operators_equal_their_sql(spark, name):
    df = registry.QUERIES[name](spark, SF)
    assert sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect()) == duck(registry.ORACLES[name])


def test_op3_anchors_lose_nothing():
    words = sorted({w for t in license_scan.TEMPLATES.values() for w in license_scan.normal_words(t)})
    rng = random.Random(2)
    for _, text in sorted(license_scan.TEMPLATES.items()):
        own = license_scan.normal_words(text)
        found = license_scan.anchors(text, 0.8)
        for _ in range(200):
            unit = [w if rng.random() > 0.12 else rng.choice(words) for w in own]
            a, b = set(license_scan.bigrams(unit)), set(license_scan.bigrams(own))
            if 2 * len(a & b) >= 0.8 * (len(a) + len(b)):
                assert any(x in " ".join(unit) for x in found)


def test_op3_runs_cross_lines_and_lie_inside_lines(spark):
    T = license_scan.TEMPLATES
    code = "\n".join(f"let v{k} = f({k}) + {k * 7};" for k in range(200))
    wrapped = lambda t, n: "\n".join(" * " + " ".join(t.split()[k : k + n]) for k in range(0, len(t.split()), n))
    rest = " ".join(f"further{k} term{k % 7} holds" for k in range(3000))
    texts_ = {
        "gpl-3.0": wrapped(T["gpl-3.0/header"], 9) + "\n" + code,
        "bsd-3-clause": code + "\n" + wrapped(T["bsd-3-clause"], 7) + "\n" + code,
        "apache-2.0": "This tool was written last year. " + T["apache-2.0"] + " Its authors may be reached by mail at any time.",
        "mit": "Copyright (c) 2020 A. Author\n\n" + wrapped(T["mit/full"], 12).replace(" * ", ""),
        "agpl-3.0": wrapped(T["agpl-3.0/opening"], 10) + "\n" + rest,
        "lgpl-2.1": "// " + T["lgpl-2.1/header"].replace("the terms", "these terms") + " " + rest,
    }
    df = spark.createDataFrame(list(enumerate(texts_.values())), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
    for k, name in enumerate(texts_):
        assert got[k].license == name and name in got[k].licenses.split(","), (name, got[k])
    assert "gpl-2.0" not in got[0].licenses and got[2].score == 1.0
    plain = spark.createDataFrame([(1, rest + code)], "doc_id long, text string")
    assert license_scan.scan_licenses(plain).first().license is None
    c = duckdb.connect()
    c.register("documents", df.unionByName(plain.selectExpr("doc_id + 100 as doc_id", "text")).toPandas())
    q = c.sql(license_scan.oracle())
    want = sorted(map(repr, q.select("doc_id, license, score, n_units, licenses").fetchall()))
    both = license_scan.scan_licenses(df.unionByName(plain.selectExpr("doc_id + 100 as doc_id", "text")))
    assert sorted(repr(tuple(r)) for r in both.select("doc_id", "license", "score", "n_units", "licenses").collect()) == want


def brute_licenses(text, templates, threshold=0.8):
    """The best score of each licence over all windows of all templates' lengths, and over lines."""
    words, out = license_scan.normal_words(text), {}
    units = [license_scan.normal_words(x) for x in [*text.split("\n"), text]]
    for name, t in templates.items():
        own = license_scan.normal_words(t)
        b = set(license_scan.bigrams(own))
        for unit in [*units, *(words[k : k + len(own)] for k in range(max(1, len(words) - len(own) + 1)))]:
            a = set(license_scan.bigrams(unit))
            if b and a and 2 * len(a & b) / (len(a) + len(b)) >= threshold:
                out[name] = max(out.get(name, 0), 2 * len(a & b) / (len(a) + len(b)))
    return out


def test_op3_loses_no_window_and_names_what_is_best(spark):
    """Noisy notices in other text against every window: what scores there is found, and nothing else is."""
    rng, T = random.Random(2), license_scan.TEMPLATES
    texts = []
    for k in range(40):
        words = " ".join(rng.choice(sorted(T.values())) for _ in range(2)).split()
        for _ in range(rng.randrange(1, 12)):
            words[rng.randrange(len(words))] = rng.choice(["other", "word", "the", "licence"])
        texts.append(" ".join(rng.choices(["some", "text", "of"], k=k)) + " " + "".join(w + rng.choice([" ", " ", "\n# "]) for w in words))
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    reached = missed = 0
    for k, t in enumerate(texts):
        want = brute_licenses(t, T)
        assert set(filter(None, got[k].licenses.split(","))) <= {n.split("/")[0] for n in want}
        reached += bool(want)
        missed += bool(want) and got[k].license is None
    assert reached > 25 and missed <= 0.05 * reached  # a run is only where an anchor's first place fits


@pytest.mark.parametrize("name", ["gpl-3.0", "gpl-2.0", "agpl-3.0", "lgpl-2.1", "lgpl-3.0", "bsd-2-clause", "bsd-3-clause", "apache-2.0", "mit", "artistic-2.0", "mpl-1.1", "mpl-2.0", "isc", "zlib"])
def test_op3_a_licence_has_its_own_name_alone(spark, name):
    whole = max((t for n, t in license_scan.TEMPLATES.items() if n.split("/")[0] == name), key=len)
    wrapped = "".join(w + ("\n" if k % 9 == 8 else " ") for k, w in enumerate(whole.split()))
    first = whole.replace(": 1.", ":\n1.").replace(" 2. Red", "\n2. Red").replace(" 3. Neither", "\n3. Neither")
    rows = [(1, wrapped), (2, "some text before\n\n" + wrapped + "\n\nand after it"), (3, first)]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.license, r.licenses) for r in got} == {(name, name)}


def test_op3_very_many_notices_in_one_text(spark):
    text = "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.\n" * 8_000
    began = time.time()
    r = license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.license, r.licenses, r.n_units) == ("apache-2.0", "apache-2.0,mit", 16_000) and time.time() - began < 60
    assert license_scan.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_op4_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(k, "text " * 9, f"s{k % 2}", 1, 2, 3, 4, 5) for k in range(30)], "doc_id long, text string, source string, __mix_source int, __mix_count int, __mix__key int, __place int, copy int")
    got = mixing.mix_documents(df)
    assert got.columns == df.columns and {tuple(r)[3:] for r in got.collect()} == {(1, 2, 3, 4, 5)}
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in mixing.mix(df).collect())


def test_op3_odd_rows(spark, odd):
    assert [r.license for r in license_scan.scan_licenses(odd).collect()] == [None] * 9
    df = spark.createDataFrame([(1, "some other words\nReleased under the MIT license\nand more words")], "doc_id long, text string")
    assert tuple(license_scan.scan_licenses(df).first()) == (1, "mit", 1.0, 1, "mit")


def test_op4_means_follow_the_weights_and_rows_repeat_alike(spark, docs, odd):
    one = docs.withColumn("source", F.lit("a"))
    rows_ = mixing.mix(one, {"a": 2.0}, epochs=30.0).groupBy("doc_id").count().collect()
    counts = [r["count"] for r in rows_]
    assert abs(np.mean(counts) - 30) < 1.5 and 20 < np.var(counts) < 45
    a, b = (mixing.mix(docs, seed="z").collect() for _ in range(2))
    assert a == b and [r.shuffle_key for r in a] == sorted(r.shuffle_key for r in a)
    assert set(mixing.mix_documents(odd).columns) == set(odd.columns)
    per = collections.Counter(r.doc_id for r in mixing.mix(odd).collect())
    assert per[3] % 2 == 0 and mixing.mix(odd.limit(0)).count() == 0


def test_op5_held_out_accuracy_and_fold(spark, docs):
    got = {r.doc_id: r for r in registry.QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out]
    assert len(held) > 100 and np.mean([got[i].lang_pred == lang[i] for i in held]) > 0.98


def test_op5_ngrams_equal_brute_force():
    texts = ["Ab c-d é!", "", "1 2", "zz"]
    grams = langid._grams(texts)
    for k, t in enumerate(texts):
        words = re.findall(r"[^\W\d_]+", t.lower())
        want = collections.Counter()
        for w in words:
            p = "\0" + w + "\0"
            want.update(w)
            want.update(p[i : i + n] for n in (2, 3) for i in range(len(p) - n + 1))
        got = sum(bounds[k + 1] - bounds[k] for _, bounds in grams)
        own = np.concatenate([g[b[k] : b[k + 1]] for g, b in grams])
        assert got == sum(want.values()) and sorted(np.unique(own, return_counts=True)[1].tolist()) == sorted(want.values())


def test_op5_odd_rows(odd):
    got = [(r.doc_id, r.lang_pred) for r in langid.identify(odd).collect()]
    assert [p for _, p in got] == ["und", "und", "en", "und", "und", "en", "en", "en", "en"]
    kept = langid.keep_identified(odd, least=0.0)
    assert kept.columns == odd.columns and kept.count() == 5
    assert langid.identify(odd.limit(0)).count() == 0 and langid.keep_identified(odd.limit(0)).count() == 0


def brute_profiles(pairs, size):
    counts = collections.defaultdict(collections.Counter)
    for text, lang in pairs:
        counts[lang].update(brute_grams(text))
    return {lang: {g: k for k, g in enumerate(ranked(c)[:size])} for lang, c in counts.items()}


def brute_grams(text):
    out = collections.Counter()
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        padded = "\0" + w + "\0"
        out.update(w)
        out.update(padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1))
    return out


def ranked(counts):
    """Most frequent first; ties in the operator's order: three characters, two, one, then by code points."""
    return sorted(counts, key=lambda g: (-counts[g], {3: 0, 2: 1, 1: 2}[len(g)], g))


def test_op5_predictions_equal_brute_force_distances(spark, docs):
    rows_ = [r for r in docs.collect()]
    rows_ = [(r.doc_id, r.text[:400], r.lang) for r in rows_[:120]] + [(9000, "Ñandú été Ωmega", None), (9001, "ab", "en")]
    df = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    size = 60
    profiles = brute_profiles([(t, lang) for i, t, lang in rows_ if lang and zlib.crc32(str(i).encode()) % 5], size)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(df, size).collect()}
    for i, text, _ in rows_:
        own = ranked(brute_grams(text))[:size]
        away = {lang: sum(abs(p[g] - k) if g in p else size for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(away), key=away.get)
        assert got[i][0] == best and abs(got[i][1] - (1 - away[best] / (size * len(own)))) < 1e-12


def test_op5_stage_drops_texts_of_no_learnt_language(spark, docs):
    rng = random.Random(1)
    other = ["我们今天去公园散步", "Καλημέρα κόσμε πώς είσαι σήμερα", "xqzj wvkq zzxj qqkw jxvz kqjx " * 20, "".join(rng.choices("bcdfghjkqvwxz ", k=3000)), "12 34", "", None]
    more = spark.createDataFrame([(10**6 + k, t, None, "s", 0) for k, t in enumerate(other)], docs.schema)
    got = [r.doc_id for r in langid.keep_identified(docs.unionByName(more)).collect()]
    assert sorted(got) == sorted(r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text)))
    some = {r.doc_id for r in langid.keep_identified(docs, langs=["de"]).collect()}
    pred = {r.doc_id: r.lang_pred for r in langid.identify(docs).collect()}
    assert some == {i for i in got if i in pred and pred[i] == "de"}


def test_op6_totals_equal_brute_force_and_replays_change_nothing(spark, docs, odd, tmp_path):
    whole = untouched(BYTE_BPE)
    want = collections.Counter()
    for r in docs.collect():
        for version, n in (("words", len(WORD.findall(r.text))), ("pieces", len(whole.encode(r.text, add_special_tokens=False).ids))):
            for key, value in (("n_docs", 1), ("n_tokens", n), ("n_chars", len(r.text))):
                want[r.source, r.lang, version, key] += value
    got = {(r.source, r.lang, r.tokenizer, k): r[k] for r in token_rollup.rollup_documents(docs).collect() for k in token_rollup.SUMS}
    assert got == dict(want)
    rollup = token_rollup.TokenRollup(spark, f"file://{tmp_path}/r")
    changes = token_rollup.signed(token_rollup.counted(docs), 1, "v", "n_words")
    assert rollup.totals().count() == 0 and rollup.commit("a", changes) and not rollup.commit("a", changes)
    assert rollup.totals().agg(F.sum("n_docs")).first()[0] == docs.count()
    assert rollup.commit("b", token_rollup.signed(token_rollup.counted(docs), -1, "v", "n_words")) and rollup.totals().count() == 0
    assert token_rollup.rollup_documents(odd).agg(F.sum("n_docs")).first()[0] == 18


def brute_quality(t):
    w, seen, repeated = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {p for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), repeated, len(covered)


def test_op7_counts_and_verdicts(spark, texts, odd):
    got = registry.QUERIES["op7_quality_rules"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute_quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.kept and r.base_failed)
    assert sorted(r.kept for r in quality_mcd.judge(odd).collect())[-1] is False
    assert quality_mcd.judge(odd.limit(0)).count() == 0


def test_quality_salted(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {(r.doc_id, r.kept, round(r.distance2 or 0, 6)) for r in quality_mcd.judge(docs).collect()}
    monkeypatch.setattr(quality_mcd, "BROADCAST_ROWS", 0)
    assert {(r.doc_id, r.kept, round(r.distance2 or 0, 6)) for r in quality_mcd.judge(docs).collect()} == want


def test_op7_rejects_junk_and_keeps_labelled_good_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = registry.QUERIES["op7_quality_rules"](spark, folder).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    passed = [r for r in got if not r.base_failed]
    marked = [r.kept for r in passed if 100 * r.n_symbols > 5 * r.word_chars]
    assert len(marked) > 50 and not any(marked)
    assert np.mean([r.kept for r in passed if label.get(r.doc_id) == 1]) > 0.95


def brute_mcd(x):
    """Squared distances by concentration steps on the exact h nearest rows, from the same three starts."""
    n, d = x.shape
    h, floors = int(np.ceil(0.75 * n)), np.array(quality_mcd.FLOORS)
    med, q1, q3 = (np.quantile(x, q, axis=0, method="inverted_cdf") for q in (0.5, 0.25, 0.75))
    sd = np.sqrt(((q3 - q1) / 1.349) ** 2 + floors**2)
    z = (x - med) / sd
    best = None
    for y in (None, np.tanh(z), z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)):
        r = np.eye(d)
        if y is not None:
            c = y.T @ y
            r = c / np.sqrt(np.maximum(np.outer(np.diag(c), np.diag(c)), 1e-18))
            np.fill_diagonal(r, 1)
        m, s, last = med, r * np.outer(sd, sd) + np.diag(floors**2), np.inf
        for _ in range(60):
            near = np.argsort(np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m), kind="stable")[:h]
            m, s = x[near].mean(axis=0), np.cov(x[near].T, bias=True) + np.diag(floors**2)
            det = np.linalg.slogdet(s)[1]
            if det > last - 1e-9:
                break
            last = det
        if best is None or det < best[0] - 1e-9:
            best = (det, m, s)
    _, m, s = best
    d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
    return d2 / max(1.0, np.sort(d2)[int(np.ceil(n / 2)) - 1] / quality_mcd.chi2_quantile(0.5))


def test_op7_verdicts_equal_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 2))
    got = {r.doc_id: r for r in quality_mcd.judge(docs).collect()}
    groups, x = collections.defaultdict(list), {}
    for r in docs.select("doc_id", "text", "lang", "source").collect():
        n, chars, symbols, lines, repeats = brute_quality(r.text)
        x[r.doc_id] = [np.log1p(n), np.log1p(chars / max(n, 1)), np.log1p(100 * symbols / max(chars, 1)), np.log1p(lines), repeats / max(n, 1)]
        if not (n < 10 or 100 * repeats > 20 * n):
            groups[r.lang, r.source].append(r.doc_id)
    large = {g: ids for g, ids in groups.items() if len(ids) >= quality_mcd.LEAST_ROWS}
    assert len(large) >= 4
    cut, close, apart_ = quality_mcd.chi2_quantile(1 - quality_mcd.TAIL), 0, 0
    for ids in large.values():
        for i, d2 in zip(ids, brute_mcd(np.array([x[i] for i in ids])), strict=True):
            apart_ += got[i].kept != (d2 <= cut)
            close += abs(d2 / cut - 1) < 0.15
            assert abs(d2 / cut - 1) < 0.15 or got[i].kept == (d2 <= cut), (d2, got[i])
    assert apart_ <= close and close < 0.05 * len(x)


def test_op7_estimates_resist_outliers(spark):
    rng = np.random.default_rng(7)
    good = rng.normal([5, 2, 0.5, 0.2, 0.1], [0.8, 0.3, 0.9, 0.8, 0.1], (3000, 5))
    bad = rng.normal([12, 4, 4, 4, 1], 0.1, (600, 5))
    rows_ = [("g", *map(float, r)) for r in np.concatenate([good, bad])]
    df = spark.createDataFrame(rows_, "grp string, " + ", ".join(f"{s} double" for s in quality_mcd.STATS))
    e = quality_mcd.estimates(df, Workspace(spark, "t")).first()
    assert np.allclose([e[f"m{i}"] for i in range(5)], good.mean(axis=0), atol=0.12)
    d2 = [r.d2 for r in quality_mcd._with_distance(df.join(quality_mcd.estimates(df, Workspace(spark, "u")), "grp")).collect()]
    cut = quality_mcd.chi2_quantile(1 - quality_mcd.TAIL)
    assert sum(d > cut for d in d2[:3000]) < 30 and sum(d > cut for d in d2) >= 600


def test_op8_odd_rows_and_small_blocks(odd, spark):
    got = sorted(((r.doc_id or -1), r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(odd, 16).collect())
    assert got == [(-1, None, 1, True), (1, 2, 2, False), (2, 2, 2, True), (3, 3, 2, False), (3, 3, 2, True), (4, 4, 1, True), (4, 4, 1, True), (5, 5, 1, True), (6, 6, 1, True)]
    kept = exact_dedup.drop_copies(odd, 16)
    assert kept.columns == odd.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 2, 3, 4, 4, 5, 6]
    assert exact_dedup.exact_dedup(odd.limit(0)).count() == 0
    with pytest.raises(RuntimeError):
        exact_dedup.name_documents(odd, Workspace(spark, "t"), 16, "substring(b, 1, 1)")


def untouched(name):
    """The library's own tokenizer, as the contracts give it."""
    return Tokenizer.from_file(vocabulary_path(name))


def library_ids(name, values):
    return [list(x.ids) for x in untouched(name).encode_batch(list(values), add_special_tokens=False)]


@pytest.mark.parametrize("slots", [64, tokenizing.SLOTS])
@pytest.mark.parametrize("name", [BYTE_BPE, WORD_BPE])
def test_splits_encode_as_the_library_does(name, slots, texts, monkeypatch):
    e = TextEncoder(name, slots)
    assert e.known
    odd_ = ["", "  a  b\n\n c", " x", "x ", "\n", "a\n b \nc\t\td", "it's we'll 12 ３", " \n ", "ſİŉ µ²", "a\x1cb\x85c\xa0d", "<|endoftext|> <|startoftext|>x<|ENDOFTEXT|>", "\r\nA\r\n", "a\x00b", "x" * 300 + " y", "***'s 's"]
    parts = ["a", "é", "Z", "ß", " ", "  ", "\n", "\t", "'s", "'", "1", "23", "²", "·", "_", "<|endoftext|>", "→", "'LL", " 's", "\r", "\xa0", "中", "'re", "'v", "x" * 9, "y" * 30, "'ve", "`"]
    rng = random.Random(8)
    values = [*texts.values(), *odd_, *("".join(rng.choices(parts, k=rng.randrange(10))) for _ in range(3000))]
    want = library_ids(name, values)
    assert [x.tolist() for x in e.encode(values)] == want and [x.tolist() for x in e.encode(values[::-1])] == want[::-1]
    monkeypatch.setattr(tokenizing, "PIECE_CHARS", 50)
    monkeypatch.setattr(tokenizing, "BATCH_CHARS", 400)
    assert [x.tolist() for x in e.encode(values[:150])] == want[:150]


def test_unknown_vocabularies_go_to_the_library_whole(tmp_path):
    other = untouched(BYTE_BPE)
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    other.save(str(tmp_path / "other.json"))
    e = TextEncoder(str(tmp_path / "other.json"))
    assert not e.known and e.encode(["a b's", ""])[0].tolist() == other.encode("a b's", add_special_tokens=False).ids


def test_op9_reads_back_what_the_library_encodes(spark, texts):
    library, start, want = untouched(BYTE_BPE), 0, []
    for i, t in sorted(texts.items()):
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, registry.QUERIES["op9_token_shards"](spark, SF).collect())) == want


def test_op9_shard_lookup(odd):
    w = sstable.ShardWriter(7)
    rng = np.random.default_rng(1)
    held = {k: rng.integers(0, 70_000 if k % 5 else 60_000, 400).astype("<u4") for k in range(-500, 4000, 3)}
    for k, ids in held.items():
        w.add(k, ids)
    shard = sstable.Shard(w.finish() + b"\n")
    assert len(shard.where) > 3 and all(np.array_equal(shard.get(k)[0], ids) for k, ids in held.items())
    assert not any(shard.get(k) for k in range(-499, 4000, 3)) and [k for k, _ in shard.scan()] == list(held)
    with pytest.raises(ValueError):
        sstable.Shard(b"x" * 100)
    whole = w.finish() + b"\n"
    for at in [*range(0, len(whole) - 5, 99_991), *range(len(whole) - 77, len(whole) - 5, 5)]:  # the last four bytes are spare, and the pad
        bad = bytearray(whole)
        bad[at] ^= 4
        with pytest.raises((ValueError, struct.error)):
            list(sstable.Shard(bytes(bad)).scan())
    assert sstable.token_shards(odd).count() == 9 and sstable.token_shards(odd.limit(0)).count() == 0


def check_packing(rows_, ids):
    seqs, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows_:
        own = ids[r.doc_id]
        assert r.length > 0 and r.doc_tokens == len(own) and zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        seqs[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length))
    for group in (seqs, pieces):
        for own in group.values():
            at = 0
            for a, n in sorted(own):
                assert a == at
                at += n
    sizes = [sum(n for _, n in s) for s in seqs.values()]
    assert max(sizes) <= 4096 and {k: sum(n for _, n in v) for k, v in pieces.items()} == {k: len(v) for k, v in ids.items()}
    return sum(0 if n & (n - 1) == 0 else 4096 - n for n in sizes) / sum(sizes)


def test_op10_is_whole_and_tight(spark, odd):
    folder = "/root/testdata/sf0.01"
    library = untouched(WORD_BPE)
    ids = {r.doc_id: np.array(library.encode(r.text, add_special_tokens=False).ids + [2], "<u4") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert check_packing(registry.QUERIES["op10_sequence_packing"](spark, folder).collect(), ids) < 0.02
    assert packing.pack(odd).groupBy("doc_id").count().count() == 7 and packing.pack(odd.limit(0)).count() == 0


def test_op10_cuts_are_the_cheapest():
    rng = random.Random(4)
    for _ in range(40):
        places = [0, *sorted(rng.sample(range(64, 25_600, 64), 40))]
        window = max(4096, max(b - a for a, b in zip(places, places[1:], strict=False)))
        penalties = [0] + [rng.choice((0, 4, 32)) for _ in places[1:]]
        cost = [0.0] + [float("inf")] * 40
        for j in range(1, 41):
            for i in range(j):
                n = places[j] - places[i]
                if n <= window:
                    cost[j] = min(cost[j], cost[i] + penalties[j] + (0 if n in packing._SHORT and n < window else window - n))
        cuts = packing.best_cuts(places, penalties, window)
        price = sum(penalties[places.index(b)] + (0 if b - a in packing._SHORT and b - a < window else window - (b - a)) for a, b in zip(cuts, cuts[1:], strict=False))
        assert price == cost[-1]


def test_op10_offers_every_sentence_end_and_power_of_two():
    rng = random.Random(9)
    for window in (100, 4096):
        for _ in range(20):
            total = 16 * window
            stops = np.array(sorted(rng.sample(range(1, total), total // 12)))
            ends = np.array([*sorted(rng.sample(range(1, total), 6)), total])
            places, penalties = packing.cut_places(ends, stops, total, window)
            assert {0, *stops.tolist(), *ends.tolist()} <= set(places)
            places = [0, *sorted(rng.sample(range(1, 4 * window), 60))]
            places += [p for p in range(window, places[-1], window // 2) if p not in places]
            places.sort()
            penalties = [0] + [rng.choice((0, 4, 32)) for _ in places[1:]]
            price = lambda n: 0 if n & (n - 1) == 0 else window - n
            cost = [0.0] + [float("inf")] * (len(places) - 1)
            for j in range(1, len(places)):
                cost[j] = penalties[j] + min(cost[i] + price(places[j] - places[i]) for i in range(j) if places[j] - places[i] <= window)
            cuts = packing.best_cuts(places, penalties, window)
            assert sum(penalties[places.index(b)] + price(b - a) for a, b in zip(cuts, cuts[1:], strict=False)) == cost[-1]


def test_stay_keeps_one_row_of_a_repeated_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    keep = spark.createDataFrame([(1, 2), (None, 1)], "k long, repeats long")
    assert sorted((r.k or -1) for r in rows.stay(df, keep, {"k": F.col("k")}).collect()) == [-1, 1]


def test_op1_hot_shingles_are_dealt_by_class(spark, monkeypatch):
    made = near_copies(seed=3, n=90)
    page = " ".join(f"common{k}" for k in range(30))
    made = {i: t + " " + page if i % 3 else page + " " + t for i, t in made.items()}
    df = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    want = brute_components(word_sets(made))
    work = Workspace(spark, "t")
    classes = ngram_join.shingle_classes(df, work, range_shingles=80)
    dealt, ranges, hot, counts = ngram_join.dealt_shingles(df, classes, range_shingles=80)
    assert len(hot) >= 26 and counts.max() == len({frozenset(x) for x in word_sets(made).values()})  # each class once
    assert most_classes(dealt, hot) <= 12  # of about 90: the hot ones are spread over `ranges` parts
    for size, counted, heavy in ((500, 16, 2), (10**6, 1024, 256)):
        monkeypatch.setattr(ngram_join, "HOT_COUNTED", counted)
        monkeypatch.setattr(ngram_join, "HEAVY_LEAST", heavy)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(df, range_shingles=size).collect()} == want


def most_classes(dealt, hot):
    """The most classes of one of the shingles of ``hot`` that meet in one part."""
    met = {}
    for r in dealt.collect():
        sigs, counts = np.frombuffer(r.sigs, "<u8").reshape(-1, 2)[:, 0], np.frombuffer(r.counts, "<i4")
        tokens = np.frombuffer(r.tokens, "<u8")
        for sig, token in zip(np.repeat(sigs, counts).tolist(), tokens.tolist(), strict=True):
            met.setdefault((r.part, token), set()).add(sig)
    wanted = set(hot.tolist())
    return max((len(v) for (_, token), v in met.items() if token in wanted), default=0)


def test_op1_hot_shingles_are_found_in_long_texts(spark, monkeypatch):
    rng = np.random.default_rng(8)
    page = " ".join(f"page{k}" for k in range(20))
    made = [(k, " ".join(f"w{v}" for v in rng.integers(0, 10**9, 1800)) + (" " + page if k % 50 == 0 else "")) for k in range(600)]
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(16)
    assert min(len(t) for _, t in made) > 17_000  # about a hundred of these are a slice, so two of the 2 % are in it
    monkeypatch.setattr(ngram_join, "HOT_SHARE", 12 / 30_000)
    classes = ngram_join.shingle_classes(df, Workspace(spark, "t"), range_shingles=30_000)
    dealt, _, hot, counts = ngram_join.dealt_shingles(df, classes, range_shingles=30_000)
    assert len(hot) == 16 and set(counts.tolist()) == {12}
    assert most_classes(dealt, hot) <= 3


def test_op1_heavy_classes_are_dealt_once(spark, monkeypatch):
    text, other = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    made = [(k, text) for k in range(5, 60)] + [(None, text), (5, text), (3, text + " tail"), (None, other), (None, other), (80, other + " end")]
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(12)
    monkeypatch.setattr(ngram_join, "HEAVY_LEAST", 2)
    classes = ngram_join.shingle_classes(df, Workspace(spark, "t"))
    sigs, least = ngram_join.heavy_classes(classes, len(made))
    assert len(sigs) == 1 and least.tolist() == [5]  # the other has no doc_id to be dealt by
    dealt, *_ = ngram_join.dealt_shingles(df, classes)
    sent = sum(np.frombuffer(r.sigs, "<u8").reshape(-1, 2)[:, 0].tolist().count(int(sigs[0, 0])) for r in dealt.collect())
    assert sent <= 2 * 36  # its 36 shingles, by the two rows of doc_id 5 at most
    got = sorted((r.doc_id or -1, r.component_id) for r in ngram_join.ngram_components(df).collect())
    assert got == sorted([(k, 3) for k in range(5, 60)] + [(-1, 3), (5, 3), (3, 3), (-1, 80), (-1, 80), (80, 80)])


def test_op8_names_are_places_in_sorted_order(spark):
    texts_ = ["b" * 16 + "a" * 16, "a" * 16, "", "b" * 16 + "a" * 16, "a" * 40, "c"]
    df = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
    runs = []
    for n in (1, 5):
        named = exact_dedup.name_documents(df.repartition(n), Workspace(spark, "t"), 16)
        runs.append({r.doc_id: (r.level, r.name) for r in named.collect()})
    blocks = sorted({t[k : k + 16] for t in texts_ for k in range(0, max(1, len(t)), 16)})  # all differ in their first 32 bytes
    assert runs[0] == runs[1] and runs[0][1] == (0, blocks.index("a" * 16)) and runs[0][5] == (0, blocks.index("c"))
    assert runs[0][0] == runs[0][3] and len(set(runs[0].values())) == 5


def test_op4_a_source_with_little_text(spark, monkeypatch):
    df = spark.createDataFrame([(1, "x", "small"), (2, "y" * 3000, "large"), (3, "z" * 3000, "large")], "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "CHUNK", 64)
    got = sorted((r.doc_id, r.copy) for r in mixing.mix(df).collect())
    monkeypatch.setattr(mixing, "CHUNK", 1 << 20)
    assert got == sorted((r.doc_id, r.copy) for r in mixing.mix(df).collect())
    n = sum(i == 1 for i, _ in got)
    assert 2600 < n < 3400 and [c for i, c in got if i == 1] == list(range(1, n + 1))


def brute_entropy(text):
    """Spans of the entropy classes by Shannon's formula on each window, each place of the text in its zone."""
    zone = [("text", 0)] * len(text)
    for n, u in enumerate(re.finditer(r"[A-Za-z][A-Za-z0-9+.-]*://([^\x00-\x20/?#\"'<>]*)[^\x00-\x20?#=&\"'<>]*", text)):
        host = u.start(1) + u[1].rfind("@") + 1
        for k in range(u.start(), u.end()):
            zone[k] = ("host", n) if host <= k < u.end(1) else ("cut", n) if text[k] == "/" else ("url", n, k < host)
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}={0,2}", text):
        for place, group in itertools.groupby(range(*m.span()), key=lambda k: zone[k]):
            own = list(group)
            a, word = own[0], text[own[0] : own[-1] + 1]
            kind = secret_scan.string_class(word) if len(word) >= 20 else None
            if place[0] in ("host", "cut") or not kind or secret_scan.allowed(word):
                continue
            pieces = re.split("[_+-]", word)
            if place[0] == "url" and all(re.fullmatch("[A-Za-z]*|[0-9]*", x) for x in pieces) and pieces[0]:
                continue
            if place[0] == "text" and "@" in (text[a - 1 : a], text[own[-1] + 1 : own[-1] + 2]):
                continue
            size, least = secret_scan.WINDOWS[kind]
            holes = [p.span() for p in re.finditer(r"(?i)example|placeholder|changeme|x{6,}|0{8,}|12345678", word)]
            spans = []
            for k in range(len(word) - size + 1):
                counts = collections.Counter(word[k : k + size])
                bits = -sum(c / size * np.log2(c / size) for c in counts.values())
                if bits >= least - 1e-9 and not any(x < k + size and k < y for x, y in holes):
                    if spans and k <= spans[-1][1]:
                        spans[-1][1] = k + size
                    else:
                        spans.append([k, k + size])
            out += [(kind, a + x, a + y) for x, y in spans]
    return out


def test_op2_finds_keys_in_urls_and_connection_strings():
    key = "Zk3vQ9xT7bLm2Wc8RfY5aQ"
    found = lambda t: [t[a:b] for _, a, b in secret_scan.scan(t)[1]]
    for t in (f"https://user:{key}@github.com/a", f"postgres://svc:{key}@db.host/x", f"https://hooks.site.org/services/T0/B1/{key}", f"git+https://{key}@host/r.git", f"{key} https://a.b/{key}/x?y={key}"):
        assert set(found(t)) == {key} and len(found(t)) == t.count(key), t
    for t in ("https://site.org/articles/2024/climate7report/section12/page34b", "https://site.org/how-to-build-a-garden-in-2023-and-later", f"https://{key}.example.org/a", f"{key}@mail.org", "see https://a.b/123e4567-e89b-12d3-a456-426614174000"):
        assert found(t) == [], t


def test_op2_entropy_spans_equal_brute_force_and_the_allow_list(spark, texts):
    rng = random.Random(6)
    made = ["".join(rng.choices("abcdefABCDEF0123456789+/_-=@ .:?x", k=400)) for _ in range(60)]
    key = "Zk3vQ9xT7bLm2Wc8RfY5aQ"
    url = "https://site.org/articles/2024/climate7report/section12/page34b"
    made += ["".join(rng.choices(["https://", "s3://", "@", "/", key, key[:11], "a-b-", "site.org", " ", "?", ":", "2024-report-of-the-year"], k=12)) for _ in range(300)]
    made += [url, f"https://site.org/a?k={key}", f"{key}@mail.org", f"me@{key}", f"example/{key}", f"{key}0000{key}", "Ab1" * 20_000 + key, f"key={key}12345678{key}"]
    for t in [*made, *texts.values()]:
        assert sorted(secret_scan.scan(t)[1]) == sorted(brute_entropy(t))
    assert secret_scan.scan(url)[1] == [] and len(secret_scan.scan(f"https://site.org/a?k={key}")[1]) == 1
    assert secret_scan.scan(f"{key}@mail.org")[1] == [] and secret_scan.scan(f"example/{key}")[1] and secret_scan.scan(f"{key}0000{key}")[1]
    assert secret_scan.scan_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0
