"""Sections, definitions, dates, spans and evidence in texts."""

from __future__ import annotations

import datetime
import random

from pyspark.sql import functions as F

from corpuslens.functions import exprs as X
from corpuslens.functions import udfs
from corpuslens.plans.release import library_tokens


def each(spark, values, make, schema="a string"):
    df = spark.createDataFrame([(k, *(v if isinstance(v, tuple) else (v,))) for k, v in enumerate(values)], f"k long, {schema}")
    return [r.r for r in df.select("k", make.alias("r")).orderBy("k").collect()]


def test_dates_of_random_days_in_every_written_form(spark):
    rng = random.Random(3)
    ends = {1: "st", 2: "nd", 3: "rd", 21: "st", 22: "nd", 23: "rd", 31: "st"}
    texts, want = [], []
    for _ in range(150):
        days, parts = [], []
        for _ in range(rng.randrange(4)):
            d = datetime.date(rng.randint(1000, 2999), rng.randint(1, 12), rng.randint(1, 28))
            end, name = ends.get(d.day, "th"), d.strftime("%B")
            parts.append(rng.choice([
                str(d), f"{d.month}/{d.day}/{d.year:04}", f"{d.month:02}/{d.day:02}/{d.year:04}", f"{name} {d.day}, {d.year:04}", f"{name[:3]}. {d.day}{end}, {d.year:04}", f"{d.day} {name.upper()} {d.year:04}", f"{d.day}{end} day of\n{name}, {d.year:04}", f"{d.day}{end} {name[:3].lower()} {d.year:04}",
            ]))
            parts.append(rng.choice(["and", "; on", "(12 of 30)", "x1/2/2020", "2/30/2020", "Feb 30, 2020", "2020-1-2", "2020-13-01", "May 2020", "1/2/20", "a2020-01-02b", "3 maybe 2020"]))
            days.append(str(d))
        texts.append(" ".join(parts))
        want.append(days)
    assert each(spark, [*texts, None, ""], X.dates_in(F.col("a"))) == [*want, [], []]


def test_sections_by_longest_text_and_inside_lines():
    body = "of this agreement " * 9
    text = f"1.1 Terms .... 3\n§ 2.4A Fees 12\n  SECTION 1.1 Terms. {body}\nSec. 2.4A Fees. Short here. Section 2.5 Costs. {body}\nas in Section 2.5 Costs and so on\n1.1 Terms. see above\n2020 Plan of work\n1.10 lower case is no title\nARTICLE IV. Closing\n"
    found = udfs.find_sections(text)
    assert [(n, t, o) for n, t, _, _, o in found] == [("1.1", "Terms", True), ("2.4A", "Fees", False), ("2.5", "Costs", True), ("1.1", "Terms", False), ("ARTICLE IV", "Closing", False)]
    assert [b for _, _, _, b, _ in found] == [a for _, _, a, _, _ in found[1:]] + [len(text)]
    assert [text[a:].split()[0] for _, _, a, _, _ in found] == ["SECTION", "Sec.", "Section", "1.1", "ARTICLE"]
    assert udfs.find_sections("") == [] and udfs.find_sections("no numbers\nat all") == []


def test_definition_is_the_first_line_that_defines(spark):
    text = 'the "Base Fee" of 5\nThe term “Base Fee”  shall\tmean the fee (x+y).\n"Base Fee" means 7\n"Base" means 8'
    assert each(spark, [text, "nothing", None], X.definition(F.col("a"), "base fee", 30)) == ["The term “Base Fee”  shall\tmea", None, None]
    assert each(spark, ['"A (b)+" has the meaning of c', '"A b" means'], X.definition(F.col("a"), "A (b)+", 99)) == ['"A (b)+" has the meaning of c', None]


def test_library_tokens_of_null_and_empty_texts(spark):
    made = spark.createDataFrame([(1, None), (2, ""), (3, "one word and another"), (4, "one word and another")], "k int, text string")
    got = {r.k: r.n for r in made.select("k", library_tokens("text").alias("n")).collect()}
    assert got[1] == got[2] == 0 and got[3] == got[4] > 0
