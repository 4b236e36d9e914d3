"""Containment of excerpts of any length, against all pairs."""

from __future__ import annotations

import random

import pytest

from corpuslens.operators import containment
from corpuslens.plans.queries import QUERIES

TEXTS, ITEMS = "doc long, text string", "item long, excerpt string"


def pairs(spark, texts, items, **how):
    got = [(r.item, r.doc) for r in containment.contained(spark.createDataFrame(list(enumerate(texts)), TEXTS), spark.createDataFrame(list(enumerate(items)), ITEMS), **how).collect()]
    assert len(got) == len(set(got))
    return set(got)


def brute(texts, items):
    return {(i, d) for i, x in enumerate(items) if x is not None for d, t in enumerate(texts) if t is not None and x in t}


@pytest.mark.parametrize("hot", [2, 100_000])
def test_excerpts_of_1_to_200_words_with_cut_ends(spark, hot):
    """Few words, so anchors are hot; excerpts begin and end anywhere, also inside words."""
    rng = random.Random(4)
    words = ["of", "the", "a", "", "naïve", "中文词", "long" * 5, "x\ny", "🙂🙂🙂"] + [f"w{k}" for k in range(15)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 260))) for _ in range(60)] + ["", None, " ", "of the"]
    items = []
    for n in [1, 2, 3, 4, 5, 8, 9, 10, 40, 200] * 4:
        t = rng.choice(texts[:60])
        a = rng.randrange(len(t))
        items.append(t[a : a + rng.randint(0, 3) + sum(len(w) + 1 for w in t[a:].split(" ")[:n])])
    items += [x + "q" for x in items[:20]] + ["", None, " ", "  ", "a", "ab", "文", "中文词", "of the", "the of the", "not anywhere at all", "longlonglonglo", "glong"]
    want = brute(texts, items)
    assert pairs(spark, texts, items, hot=hot) == want and len(want) > 500


def test_no_key_of_the_join_is_hot(spark, monkeypatch):
    seen = []
    keep = containment.written
    monkeypatch.setattr(containment, "written", lambda df: seen.append(keep(df)) or seen[-1])
    texts = ["the of a the of " + str(k) for k in range(200)]
    assert pairs(spark, texts, ["he of a the o", "x the of a the of y", "a the of 77"], hot=20) == brute(texts, ["he of a the o", "x the of a the of y", "a the of 77"])
    salted = [t for t in seen if "salts" in t.columns]
    assert all(r.salts >= 10 for r in salted[-1].collect())


def test_repeated_ids_and_empty_tables(spark):
    texts = spark.createDataFrame([(1, "a b c d e"), (1, "f g"), (None, "a b c d"), (2, None)], TEXTS)
    items = spark.createDataFrame([(7, "b c d"), (7, "f"), (7, "zz zz zz"), (None, "b c"), (8, None)], ITEMS)
    assert {(r.item, r.doc) for r in containment.contained(texts, items).collect()} == {(7, 1), (None, 1), (7, None), (None, None)}
    assert containment.contained(texts.limit(0), items).count() == containment.contained(texts, items.limit(0)).count() == containment.contained(texts, items.where("item = 8")).count() == 0


def test_verbatim_check_on_short_and_cut_excerpts(spark, tmp_path):
    texts = ["one two three four five six seven eight nine ten eleven", "alpha beta", "ein Wort", "句子没有空格"]
    items = ["two three", "wo three four five six seven eight nine t", "lpha be", "in W", "子没有", "two four", "句子空格"]
    for name, rows, schema in (("documents", texts, "doc_id long, text string"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(list(enumerate(rows)), schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert tuple(QUERIES["verbatim_check"](spark, str(tmp_path)).first()) == (7, 2)
