"""Repaired records, families of spellings and spans by category, on odd rows and by brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import relabel as L
from corpuslens.operators import release, spans
from corpuslens.plans.repair import CORE, KINDS

ROW = "id long, subclass string, subject string, entity_name string, record_type string, intent string, intent_source string, keywords array<string>, fields map<string,string>, presence map<string,string>"


def one(spark, c, values):
    return [r.x for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", c.alias("x")).orderBy("i").collect()]


def stripped(name):
    """A piece at a time, from the end."""
    name = " ".join(name.split())
    while True:
        if name.endswith("/") and len(name) > 3 and name[-4] == "/" and name[-3:-1].isupper():
            name = name[:-4].rstrip()
            continue
        at = name.rfind("(")
        words = [w.strip() for w in name[at + 1 : -1].split(",")] if name.endswith(")") and at >= 0 else []
        fits = lambda w: 0 < len(w) <= 6 and w[0].isalpha() and all(ch.isupper() or ch in "0123456789.-" for ch in w)
        if not words or not all(map(fits, words)) or set(words) & set(L.LEGAL_WORDS):
            return name
        name = name[:at].rstrip()


def test_legal_names_equal_brute_force(spark):
    rng = random.Random(5)
    ends = ["/DE/", "/NY/", "(ABC)", "(AB, AB-PA)", "(UK)", "(AG)", "(LLC, ABC)", "(ABC,UK-A)", "(Abc)", "(TOOLONGX)", "/de/", "Inc.", "(X.A)", "(1AB)"]
    names = ["Acme " + rng.choice([" ", ""]).join(rng.choices(ends, k=rng.randint(0, 4))) for _ in range(300)]
    assert one(spark, L.legal_name(F.col("v")), names) == [stripped(n) for n in names]


def test_company_of_the_template_only(spark):
    got = one(spark, L.template_company(F.col("v")), [
        "Bylaws of Acme  Corp /DE/ (ACM) (CIK 0001) (SEC EDGAR exhibit 3.1)", "Minutes of First (AG) (CIK 5)  (SEC EDGAR exhibit)", "Bylaws of Acme (SEC EDGAR exhibit 3.1)",
        "Bylaws of Acme (CIK 5) (SEC EDGAR exhibit", "Bylaws of Acme (CIK 5)", "Deed of Bank\nof X (CIK 1) (SEC EDGAR exhibit 9) and more", "Bylaws of (ABC) (CIK 5) (SEC EDGAR exhibit)", "", None,
    ])
    assert got == ["Acme Corp", "First (AG)", None, None, None, "Bank of X", None, None, None]


def test_repair_of_odd_rows(spark):
    rows = [
        (1, None, None, None, None, None, None, None, None, None),
        (2, "charter", "Minutes, by-laws", "x", "founding", "own", "expert", [None, "EX-1", "a"], {"date": "2020", "address": None}, {"state": "gap", "address": "populated"}),
        (3, "By-Laws", "the MINUTES of a board", "x", "rules", None, "heuristic", [], {"address": " [] ", "state": "N/A"}, {}),
        (4, "minutes", "Deed of A. (CIK 1) (SEC EDGAR exhibit 1)", None, "meeting", "decide", "", ["A.", "Board minutes", "minutes"], {}, {"entity_name": "gap"}),
    ]
    df = spark.createDataFrame(rows, ROW).withColumn("_own", F.lit(1)).withColumn("__kind", F.lit("k"))
    out = L.relabel_records(df, KINDS, CORE)
    assert out.columns == [*df.columns, "changes"]
    got = {r.id: r for r in out.collect()}
    assert all(r["_own"] == 1 and r["__kind"] == "k" for r in got.values())
    assert (got[1].subclass, got[1].record_type, got[1].intent, got[1].keywords) == (None, "record", "file", None)
    assert got[1].presence == {"record_type": "populated", "address": "not_applicable", "date": "not_applicable", "state": "not_applicable"}
    assert got[1].changes == ["record_type", "intent:->file"]
    # two others' cues: stays; a stated date and an address that is populated stay as they are
    assert (got[2].subclass, got[2].intent, got[2].keywords, got[2].changes) == ("charter", "own", ["a"], ["keywords"])
    assert got[2].presence == {"state": "gap", "address": "populated", "record_type": "populated"}
    assert (got[3].subclass, got[3].record_type, got[3].intent) == ("minutes", "meeting", "decide")
    assert got[3].changes == ["subclass:bylaws->minutes", "record_type", "intent:->decide"]
    assert got[3].presence == {"record_type": "populated", "address": "not_applicable"}  # "N/A" is a value, "[]" none
    assert (got[4].entity_name, got[4].subject, got[4].keywords) == ("A.", "Board minutes of A.", ["Board minutes", "A.", "Board minutes"])
    assert got[4].presence["entity_name"] == "populated"


def test_repair_settles_and_takes_an_empty_table(spark):
    rows = [(i, s, f"Deed of Acme{i} (CIK 1) (SEC EDGAR exhibit 1)" if i % 2 else "the minutes", None, None, None, None, ["EX-1", s], {}, None) for i, s in enumerate(["bylaws", "charter", "minutes", "odd"] * 3)]
    first = L.relabel_records(spark.createDataFrame(rows, ROW), KINDS, CORE).drop("changes")
    again = L.relabel_records(first, KINDS, CORE)
    assert {tuple(r.changes) for r in again.collect()} == {()}
    assert L.relabel_records(spark.createDataFrame([], ROW), KINDS, CORE).count() == 0
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_families_by_place_and_odd_spellings(spark):
    fam = spark.createDataFrame([("b", "Bee", ["shared", "", None], 1), ("a", "Ay", ["SHARED!"], 2), ("c", None, None, 3)], "key string, label string, surfaces array<string>, place int")
    rows = spark.createDataFrame([(i, s, "old") for i, s in enumerate(["Sha-red", "AY", "b.", "", None, "  ", "nobody", "C"])], "id int, s string, family string")
    got = [(r.s, r.family) for r in L.family_of(rows, "s", fam).orderBy("id").collect()]
    assert got == [("Sha-red", "b"), ("AY", "a"), ("b.", "b"), ("", "other"), (None, "other"), ("  ", "other"), ("nobody", "other"), ("C", "c")]
    assert L.family_of(rows.limit(0), "s", fam).count() == 0 and {r.family for r in L.family_of(rows, "s", fam.limit(0)).collect()} == {"other"}


SPAN, DOC, CAT = "doc_id long, name string, start int, text string", "doc_id long, text string", "name string, probe string, latest int"


def test_span_verdicts_equal_brute_force(spark):
    import re

    rng = random.Random(7)
    texts = {d: "".join(rng.choices("ab A\n\U0001f600", k=rng.choice([0, 5, 40]))) for d in range(12)} | {12: None}
    cats = {"ab": (None, None), "x": ("b", 9), "Aa": ("^a", None)}
    rows = []
    for _ in range(600):
        d, name, start = rng.randrange(14), rng.choice([*cats, "no", None]), rng.choice([None, *range(-1, 40)])
        body = texts.get(d) or ""
        text = rng.choice([None, "", " a", body[start or 0 : (start or 0) + rng.randrange(1, 9)] if (start or 0) >= 0 else "q", "ab"])
        rows += [(d, name, start, text)] * rng.choice([1, 1, 4])
    plain = lambda s: re.sub("[^a-z0-9]", "", s.lower())

    def verdict(d, name, start, text):
        if name not in cats:
            return "unknown_category"
        if text is None or start is None or len(text.strip()) < 2:
            return "malformed"
        if d not in texts:
            return "no_document"
        body, (probe, latest) = texts[d] or "", cats[name]
        if start < 0 or start + len(text) > len(body):
            return "outside"
        if body[start : start + len(text)] != text:
            return "not_verbatim"
        if len(text) > 6:
            return "too_long"
        if plain(text) == plain(name):
            return "heading_only"
        if probe and not re.search(probe, text, re.I | re.S):
            return "failed_probe"
        return "too_late" if latest is not None and start > latest else "ok"

    want = {r: (rows.count(r), verdict(*r)) for r in rows}
    docs = spark.createDataFrame(list(texts.items()), DOC).withColumn("name", F.lit("clash"))
    out = spans.span_verdicts(spark.createDataFrame(rows, SPAN), docs, spark.createDataFrame([(n, *v) for n, v in cats.items()], CAT), 6)
    got = {(r.doc_id, r.name, r.start, r.text): (r.copies, r.verdict) for r in out.collect()}
    assert got == want and len({v for _, v in want.values()}) == 10


def test_span_problems_and_empty_tables(spark):
    none = spark.createDataFrame([], SPAN)
    docs, cats = spark.createDataFrame([(1, "abcdef"), (2, None)], DOC), spark.createDataFrame([("n", None, None)], CAT)
    empty = spans.span_verdicts(none, docs, cats, 9)
    assert empty.count() == 0
    assert {(r.doc_id, r.present, r.problem) for r in spans.span_problems(empty, docs, 1, ["n"]).collect()} == {(d, 0, p) for d in (1, 2) for p in ("few_categories", "none_of_required")}
    some = spans.span_verdicts(spark.createDataFrame([(1, "n", 0, "abc"), (1, "odd", 0, "abc"), (1, None, 0, "a")], SPAN), docs, cats, 9)
    assert {(r.doc_id, r.present, r.problem) for r in spans.span_problems(some, docs, 1, ["n"]).collect()} == {(1, 1, "unknown_categories"), (2, 0, "few_categories"), (2, 0, "none_of_required")}


@pytest.mark.parametrize(("told", "declared", "want"), [('{"a":2,"b":1}', 3, "agrees"), ('{"a":1}', 1, "below_labels"), ('{"a":1}', 3, "sums_differ"), ('{"a":1}', None, "sums_differ"), ("{", 3, "not_told"), ("", 3, "not_told"), (None, 3, "not_told"), ("{}", 0, "not_told")])
def test_surface_status(spark, told, declared, want):
    df = spark.createDataFrame([(2, declared, told)], "labels long, declared long, told string")
    assert df.select(release.surface_status(F.col("labels"), F.col("declared"), F.col("told")).alias("s")).first().s == want
