"""Cell rules on single values, where each answer is known."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpuslens.functions import cells as C


def each(spark, rows, make, schema="a string, b string"):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"k long, {schema}")
    return [r.r for r in df.select("k", make.alias("r")).orderBy("k").collect()]


def test_cell_problems(spark):
    cases = [
        ("keywords", '["a","b","c"]', None), ("keywords", '["a","b"]', "list_length"), ("keywords", "[]", "list_length"), ("keywords", '["a","b","b"]', "duplicate_entry"), ("keywords", '["a","b",null]', "bad_entry"),
        ("keywords", "a, b, c", "not_a_list"), ("list", "[]", None), ("list", '{"a": 1}', "not_a_list"), ("list", "[1]", "bad_entry"), ("list", '["a", " "]', "bad_entry"), ("list", '[["a"]]', "bad_entry"),
        ("date", "2024-02-29", None), ("date", "2023-02-29", "bad_date"), ("date", "N/A", None), ("date", "2/3/2024", "bad_date"), ("amount", "$1,200.50", None), ("amount", "-1", "outside_range"), ("amount", "about 3", "not_a_number"),
        ("amount", "NaN", "placeholder"), ("score", "-1", None), ("score", "1.01", "outside_range"), ("share", "-0.1", "outside_range"), ("vocabulary", "x", None), ("vocabulary", "y", "outside_vocabulary"), ("text", "a", "too_short"), ("text", "ab ", "line_boundary"), ("text", " None ", "placeholder"),
        ("other", "a", None), ("text", None, None),
    ]
    got = each(spark, [c[:2] for c in cases], C.cell_problem(F.col("a"), F.col("b"), ["x"]))
    assert [(c[0], c[1], g) for c, g in zip(cases, got, strict=True)] == cases


def test_typed_cells(spark):
    got = each(spark, [("money", "none given"), ("money", "(2k)"), ("list", "[]"), ("list", '["a",""]'), ("list", "one"), ("date", "n/a"), ("text", " "), ("text", None)], C.typed_cell(F.col("a"), F.col("b")))
    assert [(r.amount, r.items, r.day, r.value, r.bad) for r in got] == [(None, None, None, None, True), (-2000.0, None, None, None, False), (None, None, None, None, False), (None, ["a"], None, None, False), (None, ["one"], None, None, False)] + [(None, None, None, None, False)] * 3


def test_four_answers(spark):
    rows = [("a", None, ["a"] * 4), ("a", None, ["b"] * 4), ("a", "a", ["b"] * 4), ("a", None, ["a", "b", "a", "a"]), ("a", "b", ["a", "b", "a", "a"]), ("c", None, ["a", "b", "a", "a"]), ("a", None, ["a"] * 3), (None, None, [])]
    got = each(spark, rows, C.four_answer_label(F.col("a"), F.col("b"), F.col("c")), "a string, b string, c array<string>")
    assert [(r.decision, r.label) for r in got] == [("confirm", "a"), ("change", "b"), ("adjudicate", ""), ("keep", "a"), ("adjudicate", ""), ("adjudicate", ""), ("keep", "a"), ("adjudicate", "")]


def test_two_passes(spark):
    rows = [("a", "a", "a", None, None), ("a", "b", "b", 0.8, 0.9), ("a", "b", "b", 0.8, None), ("a", "b", "a", 1.0, 1.0), ("a", "z", "z", 1.0, 1.0), (None, None, "a", 1.0, 1.0)]
    got = each(spark, rows, C.two_pass_label(F.col("a"), F.col("b"), F.col("c"), F.col("d"), F.col("e"), ["a", "b"], 0.8), "a string, b string, c string, d double, e double")
    assert [(r.accepted, r.label, r.reason) for r in got] == [(True, "a", "confirms"), (True, "b", "confident change"), (False, "", "unsure change"), (False, "", "passes disagree"), (False, "", "out of vocabulary"), (False, "", "out of vocabulary")]


@pytest.mark.parametrize(("text", "want"), [("an injury", True), ("no injury", False), ("without any bodily injury, later an injury", True), ("Not an injury", False), ("injuryless", False)])
def test_mentioned(spark, text, want):
    assert each(spark, [(text, None)], C.mentioned(F.col("a"), "injury")) == [want]


def test_keywords_keep_first_order(spark):
    got = each(spark, [('The "Base Fee " and Licence: this Agreement, a PARTY, each party; governing law; "ab"', "service_deal")], C.keywords(F.col("a"), F.col("b"), C.AGREEMENT_TERMS))
    assert got == [["service deal", "Base Fee", "agreement", "party", "governing law"]]


def test_token_share_and_fill(spark):
    rows = [("one two two", "two three", None), ("", "x", "q"), ("[]", "a b", "q")]
    assert each(spark, rows, C.token_share(F.col("a"), F.col("b")), "a string, b string, c string") == [2 / 3, 0.0, 0.0]
    assert each(spark, rows, C.fill(F.col("a"), F.col("c"), F.lit("z")), "a string, b string, c string") == ["one two two", "q", "q"]


def test_agreement_by_kind(spark):
    cases = [
        ("list", '["a","b"]', '["B!","A"]', True), ("list", "[]", None, True), ("list", "[]", '["a"]', False), ("list", "a", '["a"]', True), ("money", "1.5 million", "$1,500,000", True), ("money", "5.00", "5.01", False), ("money", "no number", "", True), ("money", "no number", "5", False),
        ("date", "March 1, 2020", "2020-03-01", True), ("date", "in spring", "In  Spring", True), ("label", "A-b", "ab", True), ("id", "x-1", "X 1", True), ("name", "Acme Corp", "Acme", True), ("name", "Acme Corp of Ohio", "Acme", False), ("free_text", "a b c", "a b c d e", True), ("free_text", "a b", "a b c d", False), ("name", None, " ", True),
    ]
    got = each(spark, [c[:3] for c in cases], C.agrees(F.col("a"), F.col("b"), F.col("c")), "a string, b string, c string")
    assert [(*c[:3], g) for c, g in zip(cases, got, strict=True)] == cases


def test_grounding_by_kind(spark):
    from corpuslens.functions import exprs as X

    text = "Paid $1,250.50 and 30.00 on March 1, 2020 by Acme *Corp*, in the  Spring of 2019."
    cases = [("money", "1250.5", True), ("money", "30", True), ("money", "25", False), ("money", "none", False), ("date", "2020-03-01", True), ("date", "2020-03-02", False), ("date", "spring of 2019", True), ("date", "in the spring", False), ("name", "acme corp", True), ("name", "Acme Inc", False), ("free_text", "paid by acme inc", True), ("name", "", False), ("name", None, False)]
    got = each(spark, [(k, v, text) for k, v, _ in cases], C.grounded(F.col("a"), F.col("b"), F.col("c"), X.dates_in("c")), "a string, b string, c string")
    assert [(*c[:2], g) for c, g in zip(cases, got, strict=True)] == cases
