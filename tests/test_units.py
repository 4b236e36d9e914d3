"""Single operators on tiny inputs with known answers."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from corpuslens.functions import exprs as X
from corpuslens.functions import udfs
from corpuslens.operators import agreement, dedup, grouping, ordering, stats
from corpuslens.sources import files


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "v string").select(make(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(("value", "want"), [(None, False), ("", False), (" [] ", False), ("{}", False), ("0", True)])
def test_populated(spark, value, want):
    assert one(spark, value, X.is_populated) is want


def test_split_is_md5_mod_ten(spark):
    rows = spark.range(200).select("id", X.split_of(F.col("id")).alias("s")).collect()
    assert all((r.s == "test") == (int(hashlib.md5(str(r.id).encode()).hexdigest(), 16) % 10 == 0) for r in rows)


@pytest.mark.parametrize(("value", "want"), [("$1,234.50", 1234.5), ("(12k)", -12000.0), ("2.5bn", 2.5e9), ("EUR 3 m", 3e6), ("none", None), ("1.5 million", 1.5e6), ("2 Billion", 2e9), ("USD 40 thousand", 4e4), ("3b", 3e9), ("1,000 - 2,000", 1000.0), ("- USD 75", -75.0), ("-$75", -75.0), ("$-75", -75.0), ("(see 7) 8", -7.0), ("12 kilos", 12.0), ("", None), ("5\n)", 5.0)])
def test_money(spark, value, want):
    assert one(spark, value, X.parse_money) == want


@pytest.mark.parametrize(("value", "want"), [("Re: [EXT] Fwd:  Hello  World", "hello world"), ("RE:", ""), ("report", "report")])
def test_subject(spark, value, want):
    assert one(spark, value, X.normalize_subject) == want


@pytest.mark.parametrize("value", ["2020-03-01", "3/1/2020", "March 1, 2020", "Mar 1, 2020", "1 March 2020"])
def test_dates(spark, value):
    assert str(one(spark, value, X.parse_date)) == "2020-03-01"


def test_cleanup_and_offsets(spark):
    text = "a\r\nb c\x07d\re"
    df = spark.createDataFrame([(text, k) for k in range(len(text) + 1)], "v string, k int")
    rows = df.select("k", X.clean_text(F.col("v")).alias("c"), X.clean_offset(F.col("v"), F.col("k")).alias("o")).collect()
    assert rows[0].c == "a\nb cd\ne"
    assert [r.o for r in sorted(rows, key=lambda r: r.k)] == [0, 1, 1, 2, 3, 4, 5, 5, 6, 7, 8]


def test_quote_is_found_through_marks_and_case():
    text = "The **Quick**\n brown  fox"
    a, b = udfs.locate_quote(text, "quick brown")
    assert text[a:b] == "Quick**\n brown"
    assert udfs.locate_quote(text, "slow") is None and udfs.locate_quote("", "x") is None


def test_html_text():
    assert udfs.html_text("<head><title>t</title></head><p>a&amp;b <b>c</b></p><script>x</script><li>d") == "t\na&b c\nd"
    assert udfs.html_text("<html><head><meta name=a><p>open head<div>more") == "open head\nmore"


def test_nfc(spark):
    assert spark.createDataFrame([("é",)], "v string").select(udfs.nfc("v").alias("r")).first().r == "é"


def test_journal_fold_keeps_accepted_then_largest(spark):
    rows = [("a", 1, False, 9), ("a", 2, True, 1), ("a", 3, True, 2), ("a", 4, False, 99), ("b", 1, False, 5), ("b", 2, False, 5), ("b", 3, False, 4)]
    df = spark.createDataFrame(rows, "k string, i int, ok boolean, n int")
    assert {r.k: r.i for r in ordering.fold_journal(df, ["k"], "ok", "n", "i").collect()} == {"a": 3, "b": 1}


def test_interleave_leaves_a_place(spark):
    df = spark.createDataFrame([(g, k) for g in "ab" for k in range(3)], "g string, k int")
    got = [(r.g, r.k, r.position) for r in ordering.interleave(df, "g", "k", 2).orderBy("position").collect()]
    assert got == [("a", 0, 1), ("b", 0, 2), ("a", 1, 4), ("b", 1, 5), ("a", 2, 7), ("b", 2, 8)]


def test_kappa_edges(spark):
    make = lambda rows: agreement.kappa(spark.createDataFrame(rows, "a int, b int"), "a", "b").first()
    assert make([]).kappa == 0.0
    assert make([(1, 1), (1, 1)]).kappa == 1.0
    assert make([(1, 1), (0, 0), (1, 0), (0, 1)]).kappa == 0.0


def test_prf1_counts_missing_as_none(spark):
    df = spark.createDataFrame([(True, True), (True, None), (False, True)], "g boolean, p boolean")
    row = agreement.prf1(df, [], F.col("g"), F.col("p")).first()
    assert (row.tp, row.fp, row.fn, row.precision, row.recall) == (1, 1, 1, 0.5, 0.5)


def test_drift_of_one_fault(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (3, None)], "k int, v string")
    assert [tuple(r) for r in dedup.drift(a, b, "k", ["v"]).collect()] == [(2, "v", "y", "z")]


def test_components(spark):
    e = spark.createDataFrame([("p", a, b) for a, b in [(1, 2), (2, 3), (3, 4), (10, 11)]] + [("q", 4, 5)], "p string, a long, b long")
    got = {(r.p, r.a): r.root for r in grouping.reply_components(e, ["p"]).collect()}
    assert got == {("p", 1): 1, ("p", 2): 1, ("p", 3): 1, ("p", 4): 1, ("p", 10): 10, ("p", 11): 10, ("q", 4): 4, ("q", 5): 4}


def test_ecdf_ties(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "a", 9)], "k int, g string, v int")
    assert sorted((r.k, round(r.y, 3)) for r in stats.ecdf(df, "v", "k", "g").collect()) == [(1, 0.333), (2, 0.667), (3, 1.0)]


def test_csv_round_trip(spark, tmp_path):
    rows = [("=1+1", "a\nb"), ("\\n", "'x"), ("plain", "-3")]
    df = spark.createDataFrame(rows, "a string, b string")
    files.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "c"), ["a", "b"]).collect())) == sorted(rows)
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "c"), ["a"])


def test_jsonl_and_journal(spark, tmp_path):
    files.write_jsonl(spark.createDataFrame([(2, "x y")], "b int, a string"), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first().value == '{"a":"x\\u2028y","b":2}'
    (tmp_path / "journal.jsonl").write_text('{"k": 1}\n\n{"k": 2}\n{"k": ')
    assert sorted(r.k for r in files.read_journal(spark, str(tmp_path / "journal.jsonl"), "k int").collect()) == [1, 2]


def test_manifest(spark, tmp_path):
    (tmp_path / "m").write_text("rows : 3\n# no\nname: a: b\n")
    assert {r.key: r.val for r in files.read_manifest(spark, str(tmp_path / "m")).collect()} == {"rows": "3", "name": "a: b"}


def brute_locate(text, quote):
    """Character by character: the plain text and each character's place."""
    def plain(s):
        out, gap = [], None
        for k, c in enumerate(s):
            if c in "*_#":
                continue
            if c.isspace():
                gap = k if gap is None else gap
                continue
            if gap is not None and out:
                out.append((" ", gap))
            gap = None
            out += [(x, k) for x in c.lower()]
        return out

    if quote and quote in text:
        return text.find(quote), text.find(quote) + len(quote)
    t, q = plain(text), "".join(c for c, _ in plain(quote))
    k = "".join(c for c, _ in t).find(q) if q else -1
    return None if k < 0 else (t[k][1], t[k + len(q) - 1][1] + 1)


def test_quotes_are_found_where_brute_force_finds_them():
    import random

    rng = random.Random(2)
    parts = ["a", "B", " ", "\n", "*", "_", "#", "İ", "c d", ">", "|", " ", "ab"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randrange(25)))
        quote = "".join(rng.choices(parts, k=rng.randrange(5)))
        assert udfs.locate_quote(text, quote) == brute_locate(text, quote), (text, quote)
    assert udfs.locate_quote("a | b > c", "a b c") is None


def test_sections_skip_contents_and_short_entries():
    body = "of this agreement " * 8
    text = f"ARTICLE I Definitions\nSection 1.1 Terms 3\nSection 1.2 Fees .... 4\n{body}\nSection 1.1 Terms. {body}\n1.2 Fees\n{body} Section 1.3 Costs. short\nARTICLE II Rest\n{body}"
    found = udfs.find_sections(text)
    assert [(n, t, o) for n, t, _, _, o in found] == [("ARTICLE I", "Definitions", True), ("1.1", "Terms", True), ("1.2", "Fees", True), ("1.3", "Costs", False), ("ARTICLE II", "Rest", True)]
    assert all(text[a:b].strip().startswith(("ARTICLE", "Section", "1.2")) for _, _, a, b, _ in found)


def test_sources_pin_rewrite_and_list(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", [1, 2]), (2, "=b", [])], "k long, v string, l array<int>")
    files.write_csv(df, f"{tmp_path}/csv")
    assert sorted((r.v, r.l) for r in files.read_csv(spark, f"{tmp_path}/csv", df.columns).collect()) == [("=b", "[]"), ("a", "[1,2]")]
    files.write_pinned(df, f"{tmp_path}/p", "k long, v string, l array<int>", "default", "train")
    with pytest.raises(ValueError):
        files.write_pinned(df, f"{tmp_path}/p", "k int, v string, l array<int>", "default", "train")
    back = files.rewrite_column(df, f"{tmp_path}/r", "v", F.upper("v"))
    assert sorted(r.v for r in back.collect()) == ["=B", "A"]
    (tmp_path / "m.txt").write_text("name : x\nnote: first\n   and second\n" + "a" * 64 + "  data/f 1.bin\n")
    assert {(r.key, r.val) for r in files.read_manifest(spark, f"file://{tmp_path}/m.txt").collect()} == {("name", "x"), ("note", "first and second")}
    assert [tuple(r) for r in files.manifest_hashes(spark, f"file://{tmp_path}/m.txt").collect()] == [("data/f 1.bin", "a" * 64)]
    (tmp_path / "d").mkdir()
    for n, t in (("a", "x"), ("b", "x"), ("c", "y")):
        (tmp_path / "d" / n).write_text(t)
    assert [(r.files, r.bytes) for r in files.identical_files(files.file_hashes(spark, f"file://{tmp_path}/d")).collect()] == [(2, 1)]
    (tmp_path / "j.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    assert files.preview(files.read_jsonl(spark, f"file://{tmp_path}/j.jsonl", "a int"), 1).count() == 1


def test_sorted_files_do_not_depend_on_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "FILE_ROWS", 30)
    df = spark.range(100).select("id", (F.col("id") % 7).alias("m"))
    hashes = []
    for n in (1, 5):
        files.write_sorted(df.repartition(n), f"{tmp_path}/s{n}", ["id"])
        found = files.file_hashes(spark, f"file://{tmp_path}/s{n}").where("path like '%.parquet'").collect()
        hashes.append(sorted((r.path.split("__file=")[1].split("/")[0], r.sha256) for r in found))
    assert len(hashes[0]) == 4 and hashes[0] == hashes[1]


def test_numbers_and_ranks_of_a_hot_group(spark):
    df = spark.createDataFrame([("a" if k % 10 else "b", k * 37 % 1000) for k in range(1000)], "g string, k long").repartition(7)
    got = {(r.g, r.k): r.at for r in ordering.ranked(df, ["g"], ["k"], "at").collect()}
    for g in "ab":
        own = sorted(k for x, k in got if x == g)
        assert [got[g, k] for k in own] == list(range(len(own)))
    assert sorted(r.slice for r in ordering.parts(df, "k", 3).collect()) == [0] * 334 + [1] * 334 + [2] * 332


def test_percentiles_equal_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    rows = [("a", float(v)) for v in rng.integers(0, 9, 500)] + [("b", float(v)) for v in rng.lognormal(3, 2, 400)] + [("c", 5.0), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.x, r.y) for r in stats.percentiles(df, "v", ["g"], {"x": 0.5, "y": 0.97}).collect()}
    for g in "abc":
        assert np.allclose(got[g], np.quantile([v for x, v in rows if x == g], [0.5, 0.97]))
    assert "d" not in got


@pytest.mark.parametrize("right", [[(1,), (2,), (2,)], [(1,)], [(1,), (2,), (3,)], [(1,), (None,)]])
def test_alignment_raises(spark, right):
    left = spark.createDataFrame([(1,), (2,)], "k long")
    with pytest.raises(Exception, match="key"):
        dedup.aligned(left, spark.createDataFrame(right, "k long"), "k").collect()
    assert dedup.aligned(left, left.select("k", F.lit(1).alias("x")), "k").count() == 2
