"""Rules for single cells of a labelled row: formats, vocabularies, types, presence, decisions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslens.functions import exprs as X

#: Characters that end a line for some readers of JSON lines.
LINE_HAZARDS = "[\u2028\u2029\u0085]"
#: How many keywords a cell has.
KEYWORDS_LEAST, KEYWORDS_MOST = 3, 8
#: Terms of agreements that make keywords; each is a whole word or phrase.
AGREEMENT_TERMS = [
    "agreement", "exhibit", "section", "party", "parties", "obligations", "term", "termination", "confidential", "compensation", "liability", "indemnif", "warrant", "represent", "covenant", "consideration", "effective date", "governing law",
    "jurisdiction", "arbitration", "assign", "amend", "breach", "remedy", "force majeure", "intellectual property", "license", "royalt", "deliverable", "milestone", "service", "supply", "purchase", "consulting", "employment", "non-disclosure", "non-compete",
]


def _list_shape(text: Column) -> Column:
    """``ARRAY<STRING>`` for a JSON list of strings only, ``ARRAY<VOID>`` for an empty one."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)), F.lit(""))


def list_problem(text: Column, least: int = 0, most: int | None = None, distinct: bool = False) -> Column:
    """What is wrong with a JSON list of strings, or null."""
    shape, items = _list_shape(text), F.from_json(text, "array<string>")
    n = F.size(items)
    out = F.when(~shape.startswith("ARRAY<"), "not_a_list")
    if least or most is not None:
        out = out.when((n < least) | (n > (most if most is not None else n)), "list_length")
    blank = F.exists(items, lambda x: x.isNull() | (X.squeeze(x) == ""))
    out = out.when((shape != "ARRAY<STRING>") & (n > 0) | blank, "bad_entry")
    return out.when(F.size(F.array_distinct(items)) < n, "duplicate_entry") if distinct else out


def date_problem(text: Column) -> Column:
    shaped = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    valid = shaped & F.try_to_timestamp(F.when(shaped, text), F.lit("yyyy-M-d")).isNotNull()
    return F.when((text != "N/A") & ~valid, "bad_date")


def number_problem(text: Column, low: float | None, high: float | None) -> Column:
    """A number is wanted, without dollar signs and commas, within the bounds."""
    value = F.trim(F.translate(text, "$,", "")).try_cast("double")
    outside = F.isnan(value)
    if low is not None:
        outside = outside | (value < low)
    if high is not None:
        outside = outside | (value > high)
    return F.when(value.isNull(), "not_a_number").when(outside, "outside_range")


def cell_problem(kind: Column, text: Column, vocabulary: list[str]) -> Column:
    """The first problem of a populated cell, or null; its ``kind`` names the rule.

    Kinds are keywords, list, date, amount (0 or more), score (-1 to 1), share (0 to 1),
    vocabulary, and text (two characters or more). Before all of them come characters that
    end a line for some readers, and words that stand for nothing.
    """
    rules = {
        "keywords": list_problem(text, KEYWORDS_LEAST, KEYWORDS_MOST, True),
        "list": list_problem(text),
        "date": date_problem(text),
        "amount": number_problem(text, 0.0, None),
        "score": number_problem(text, -1.0, 1.0),
        "share": number_problem(text, 0.0, 1.0),
        "vocabulary": F.when(~text.isin(vocabulary), "outside_vocabulary"),
        "text": F.when(F.length(text) < 2, "too_short"),
    }
    out = F.when(text.rlike(LINE_HAZARDS), "line_boundary").when(F.lower(F.trim(text)).isin(*X.PLACEHOLDERS), "placeholder")
    for name, problem in rules.items():
        out = out.when(kind == name, problem)
    return out


def typed_cell(kind: Column, text: Column) -> Column:
    """(amount, items, day, value, bad) of a string cell; all null for an empty one.

    An empty list has no items; N/A is no date and no amount. ``bad`` marks an amount
    without a number in it.
    """
    some = X.squeeze(F.coalesce(text, F.lit(""))) != ""
    known = some & ~F.upper(F.trim(text)).isin("N/A", "NA")
    money, day = known & (kind == "money"), known & (kind == "date")
    given = F.filter(F.coalesce(F.from_json(text, "array<string>"), F.array(text)), lambda x: X.squeeze(x) != "")
    items = F.when(some & (kind == "list") & (F.size(given) > 0), given)
    amount = F.when(money, X.parse_money(text))
    value = F.when(some & (kind == "text"), text)
    return F.struct(amount.alias("amount"), items.alias("items"), F.when(day, X.parse_date(text)).alias("day"), value.alias("value"), (money & amount.isNull()).alias("bad"))


def presence_problems(presence: Column, kind: Column, subclass: Column, base: list[str], core: list[str], own: dict[str, list[str]], extended: str, codes: list[str]) -> Column:
    """What breaks the law of presence maps, as sorted ``problem:key`` strings.

    A map has all of the ``base`` keys and none outside the registry. Further keys are for
    rows of kind ``extended`` only: the ``core`` ones, and those that ``own`` gives to the
    row's subclass. Values are ``codes``.
    """
    keys, words = F.map_keys(presence), lambda names: F.array(*map(F.lit, names)).cast("array<string>")
    extra = sorted({k for names in own.values() for k in names})
    more = F.array_except(F.array_intersect(keys, words([*core, *extra])), words(base))
    allowed = words(core)
    for name, names in own.items():
        allowed = F.when(subclass == name, words([*core, *names])).otherwise(allowed)
    tag = lambda mark, found: F.transform(found, lambda k: F.concat(F.lit(f"{mark}:"), k))
    none = F.array().cast("array<string>")
    foreign = F.when(kind == extended, F.array_except(more, allowed)).otherwise(none)
    misplaced = F.when(kind == extended, none).otherwise(more)
    bad = F.array_except(F.array_distinct(F.map_values(presence)), words(codes))
    parts = [tag("unknown", F.array_except(keys, words([*base, *core, *extra]))), tag("missing", F.array_except(words(base), keys)), tag("foreign", foreign), tag("misplaced", misplaced), tag("bad-code", bad)]
    return F.array_sort(F.concat(*parts))


def two_pass_label(original: Column, a: Column, b: Column, sure_a: Column, sure_b: Column, vocabulary: list[str], least: float) -> Column:
    """(accepted, label, reason) of two passes: both known and equal, and either as before or sure."""
    known = F.coalesce(a.isin(vocabulary) & b.isin(vocabulary), F.lit(False))
    sure = F.least(F.coalesce(sure_a, F.lit(0.0)), F.coalesce(sure_b, F.lit(0.0))) >= least
    reason = F.when(~known, "out of vocabulary").when(a != b, "passes disagree").when(a.eqNullSafe(original), "confirms").when(sure, "confident change").otherwise("unsure change")
    accepted = reason.isin("confirms", "confident change")
    return F.struct(accepted.alias("accepted"), F.when(accepted, a).otherwise("").alias("label"), reason.alias("reason"))


def four_answer_label(existing: Column, implied: Column, answers: Column) -> Column:
    """(decision, label) from two models' answers in two passes each.

    All four equal: adjudicated if they contradict what the subtype implies, else it
    confirms or changes the existing label. Split: adjudicated if the existing label
    contradicts the subtype or none of them is it, else it is kept.
    """
    first = F.get(answers, F.lit(0))
    whole = (F.size(answers) == 4) & (F.size(F.array_distinct(answers)) == 1)
    against = lambda c: implied.isNotNull() & ~c.eqNullSafe(implied)
    decision = (
        F.when(whole, F.when(against(first), "adjudicate").when(first.eqNullSafe(existing), "confirm").otherwise("change"))
        .when(against(existing) | ~F.coalesce(F.array_contains(answers, existing), F.lit(False)), "adjudicate")
        .otherwise("keep")
    )
    label = F.when(decision.isin("confirm", "change"), first).when(decision == "keep", existing).otherwise("")
    return F.struct(decision.alias("decision"), label.alias("label"))


def keywords(text: Column, subclass: Column, terms: list[str], most: int = 8, quoted: int = 3) -> Column:
    """The subclass, the first quoted phrases, and the terms of ``text`` as they first occur."""
    phrases = F.transform(F.slice(F.regexp_extract_all(text, F.lit('"([^"]{3,40})"'), F.lit(1)), 1, quoted), lambda x: F.trim(x))
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rf"(?U)\b({'|'.join(terms)})\b"), F.lit(1)))
    return F.slice(F.concat(F.array(F.translate(subclass, "_", " ")), phrases, found), 1, most)


def provenance_kind(c: Column) -> Column:
    """Who made a value: gold, deterministic, llm, reviewer, or none; an override names its labeler."""
    c = F.coalesce(c, F.lit(""))
    out = F.when(c.startswith("override:relabel:"), "llm").when(c.startswith("override:") | c.startswith("reviewer:"), "reviewer")
    for kind in ("gold", "deterministic", "llm"):
        out = out.when(c.startswith(kind), kind)
    return out.otherwise("none")


def token_share(value: Column, gold: Column) -> Column:
    """The share of ``value``'s words, repeats counted, that are among those of ``gold``; 0 without words."""
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))
    known = F.array_distinct(words(gold))
    n = F.size(words(value))
    return F.when(n > 0, F.size(F.filter(words(value), lambda w: F.array_contains(known, w))) / n).otherwise(0.0)


def fill(cell: Column, *sources: Column) -> Column:
    """``cell`` if it is populated, else the first populated one of ``sources``, else empty."""
    return F.coalesce(*[F.when(X.is_populated(c), c) for c in (cell, *sources)], F.lit(""))


def mentioned(text: Column, word: str) -> Column:
    """Whether ``word`` is in ``text`` without a no, not or without up to two words before it."""
    low = F.lower(text)
    every = F.size(F.regexp_extract_all(low, F.lit(X.ascii_word(word)), F.lit(0)))
    negated = F.size(F.regexp_extract_all(low, F.lit(X.ascii_word(rf"(?:no|not|without)[\t\n\f\r ]+(?:[a-z]+[\t\n\f\r ]+){{0,2}}{word}")), F.lit(0)))
    return every > negated


def _words(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))


def _comparable(kind: Column, c: Column) -> Column:
    """A scalar cell in a form that is equal for equal values of its kind; null for none."""
    name = F.array_join(_words(c), " ")
    out = F.when(kind == "label", F.regexp_replace(F.lower(c), "[^a-z0-9]", "")).when(kind == "id", F.upper(F.regexp_replace(c, "[^A-Za-z0-9]", "")))
    out = out.when(kind == "money", X.parse_money(c).cast("string")).when(kind == "date", F.coalesce(X.parse_date(c).cast("string"), name)).otherwise(name)
    return F.when(X.is_populated(c), out)


def agrees(kind: Column, a: Column, b: Column) -> Column:
    """Whether two cells of one kind agree: both missing, or the same by the kind's measure.

    Lists (JSON) by Jaccard of their folded entries from 0.8, free text by Jaccard of its
    words from 0.6, names if equal or if one's words hold the other's with Jaccard from
    0.5, money within 0.005, dates, labels and ids if equal once folded.
    """
    x, y = _comparable(kind, a), _comparable(kind, b)
    entries = lambda c: F.array_distinct(F.filter(F.transform(F.coalesce(F.from_json(c, "array<string>"), F.array(c)), lambda e: F.array_join(_words(e), " ")), lambda e: e != ""))
    p, q = F.array_distinct(_words(a)), F.array_distinct(_words(b))
    held = (F.size(F.array_intersect(p, q)) == F.least(F.size(p), F.size(q))) & (F.least(F.size(p), F.size(q)) > 0)
    same = (
        F.when(kind == "list", X.jaccard(entries(a), entries(b)) >= 0.8).when(kind == "free_text", X.jaccard(p, q) >= 0.6)
        .when(kind == "name", (x == y) | held & (X.jaccard(p, q) >= 0.5)).when(kind == "money", F.abs(X.parse_money(a) - X.parse_money(b)) < 0.005).otherwise(x == y)
    )
    return F.when(x.isNull() | y.isNull(), x.isNull() & y.isNull()).otherwise(same)


def numbers(c: Column) -> Column:
    """Distinct numbers as written, without separators and without zeros that end decimals."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"\d[\d,]*(?:\.\d+)?"), F.lit(0)), lambda n: F.translate(n, ",", ""))
    return F.array_distinct(F.transform(found, lambda n: F.regexp_replace(F.regexp_replace(n, r"(\.\d*?)0+$", "$1"), r"\.$", "")))


def grounded(kind: Column, value: Column, text: Column, dates: Column) -> Column:
    """Whether ``text`` supports a value: its number, its date (of ``dates``), or its words.

    Of free text 60 % of the words are enough, of other kinds all are needed. A date that
    isn't a full one must be printed in the text as it is, but for case, marks and spaces.
    """
    plain = lambda c: X.squeeze(F.lower(F.translate(c, "*_#", "")))
    day = X.parse_date(value)
    printed = value.rlike(r"\d") & F.contains(plain(text), plain(value))
    own = numbers(value)
    in_text = (F.size(own) > 0) & (F.size(F.array_except(own, numbers(text))) == 0)
    share = token_share(value, text)
    out = F.when(kind == "date", F.when(day.isNotNull(), F.array_contains(dates, day.cast("string"))).otherwise(printed))
    out = out.when(kind == "money", in_text).when(kind == "free_text", share >= 0.6).otherwise(share >= 1.0)
    return F.coalesce(X.is_populated(value) & out, F.lit(False))
