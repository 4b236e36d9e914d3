"""Repair of labelled records from a registry of their kinds, and names of kinds made canonical."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import exprs as X

#: Fixed value: what follows the company in a subject made by the acquisition's template.
TEMPLATE_MARK = "(SEC EDGAR exhibit"
#: Upper-case words in parentheses that belong to a legal name.
LEGAL_WORDS = ("UK", "US", "USA", "EU", "LLC", "LP", "LLP", "LTD", "INC", "CORP", "CO", "NV", "AG", "SA", "PLC")
#: Form names that are no keywords; exhibit and accession numbers have patterns.
FORM_NAMES = ("8-K", "S-1", "S-1/A", "10-K", "10-K/A", "10-Q", "10-Q/A")
EXHIBIT_NUMBER = r"(?i)^EX-[\w.()-]+$"
ACCESSION_NUMBER = r"^\d{10}-\d{2}-\d{6}$"


@dataclass(frozen=True)
class Kind:
    """One kind of record: what it is called, what it implies, and the fields that can apply to it."""

    name: str
    phrase: str
    record_type: str
    intent: str
    cue: str = ""
    applicable: tuple[str, ...] = ()


def compact(c: Column) -> Column:
    """``c`` without anything but letters a-z and digits, in lower case; empty for null."""
    return F.coalesce(F.regexp_replace(F.lower(c), "[^a-z0-9]", ""), F.lit(""))


def canonical(c: Column, names: list[str], rest: str) -> Column:
    """The one of ``names`` that is compactly the same as ``c``, else ``rest``."""
    known = F.create_map(*[F.lit(x) for n in names for x in ("".join(ch for ch in n.lower() if ch in "abcdefghijklmnopqrstuvwxyz0123456789"), n)])
    return F.coalesce(F.try_element_at(known, compact(c)), F.lit(rest))


def legal_name(c: Column) -> Column:
    """``c`` without the state codes (``/DE/``) and tickers (``(ABC, ABC-A)``) at its end.

    A list in parentheses that has one of ``LEGAL_WORDS`` stays, with all before it.
    """
    ticker = r"[A-Z][A-Z0-9.-]{0,5}"
    legal = rf"(?![^)]*(?<![A-Z0-9.-])(?:{'|'.join(LEGAL_WORDS)})(?![A-Z0-9.-]))"
    tail = rf"(?:\s*/[A-Z]{{2}}/|\s*\({legal}{ticker}(?:\s*,\s*{ticker})*\))+$"
    return F.trim(F.regexp_replace(X.squeeze(c), tail, ""))


def template_company(subject: Column) -> Column:
    """The company of a subject ``<word> of <company> (CIK <n>) (SEC EDGAR exhibit ...)``; null for others."""
    whole = F.contains(subject, F.lit(TEMPLATE_MARK)) & F.contains(F.substring_index(subject, TEMPLATE_MARK, -1), F.lit(")"))
    head = F.rtrim(F.substring_index(subject, TEMPLATE_MARK, 1))
    number = r"\s*\(CIK\s*\d+\)$"
    company = legal_name(F.regexp_extract(F.regexp_replace(head, number, ""), r"(?s)^\s*\S+ of (.*)$", 1))
    return F.when(whole & head.rlike(number) & (company != ""), company)


def relabel_records(rows: DataFrame, kinds: list[Kind], core: list[str], rest: str = "other") -> DataFrame:
    """``rows`` with labels repaired from what the rows themselves say, and ``changes`` made.

    ``rows`` has subclass, subject, entity_name, record_type, intent, intent_source (strings),
    keywords (array of strings) and fields, presence (maps of strings); other columns pass
    through, one named ``changes`` is replaced. Nulls count as empty, null keywords stay null.
    ``kinds`` is the registry, which names ``rest`` too, the kind of unknown subclasses.

    * A subject that isn't the template's and has the cue of exactly one other kind, and not
      its own's, moves the row to that kind.
    * The template's company becomes the entity's name and, with the kind's phrase, the subject.
    * Keywords lose identifiers; with a company the phrase takes the place of the kind's bare
      name, and the company is added.
    * A record type that no kind has, or that of a moved row, is the kind's. An intent that
      nobody decided (source empty or ``heuristic``) is the kind's.
    * A ``core`` field that can't apply to the kind and has no value is ``not_applicable``.

    All of it is expressions on one row: no shuffle, and nothing leaves the JVM.
    """
    names = [k.name for k in kinds]
    h = "_"
    while any(c.lower().startswith(h) for c in rows.columns):
        h += "_"

    def of(attribute: str) -> Column:
        table = F.create_map(*[F.lit(x) for k in kinds for x in (k.name, getattr(k, attribute))])
        return F.element_at(table, F.col(f"{h}kind"))

    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    own = canonical(F.col("subclass"), names, rest)
    prose = ~F.contains(text("subject"), F.lit(TEMPLATE_MARK))
    cued = F.array_compact(F.array(*[F.when(prose & text("subject").rlike("(?i)" + k.cue), k.name) for k in kinds if k.cue]))
    df = rows.withColumns({f"{h}own": own, f"{h}cued": cued, f"{h}company": template_company(text("subject"))})
    cued, company = F.col(f"{h}cued"), F.col(f"{h}company")
    moved = (F.size(cued) == 1) & ~F.array_contains(cued, F.col(f"{h}own"))
    df = df.withColumn(f"{h}moved", moved).withColumn(f"{h}kind", F.when(F.col(f"{h}moved"), F.get(cued, F.lit(0))).otherwise(F.col(f"{h}own")))
    moved, named = F.col(f"{h}moved"), company.isNotNull()

    phrase, bare = of("phrase"), F.replace(F.col(f"{h}kind"), F.lit("_"), F.lit(" "))
    word = lambda k: F.trim(k)
    number = lambda k: word(k).rlike(EXHIBIT_NUMBER) | word(k).rlike(ACCESSION_NUMBER) | F.upper(word(k)).isin(*FORM_NAMES) | k.rlike(r"\(CIK \d+\)")
    kept = F.filter("keywords", lambda k: k.isNotNull() & ~number(k))
    others = F.filter(kept, lambda k: F.lower(F.replace(word(k), F.lit("_"), F.lit(" "))) != F.lower(bare))
    led = F.concat(F.array(phrase), others)
    keywords = F.when(~named, kept).when(F.array_contains(led, company), led).otherwise(F.concat(led, F.array(company)))

    fill = moved | ~text("record_type").isin([k.record_type for k in kinds])
    record_type = F.when(fill, of("record_type")).otherwise(F.col("record_type"))
    free = text("intent_source").isin("", "heuristic")
    intent = F.when(free, of("intent")).otherwise(F.col("intent"))

    presence, fields = F.coalesce("presence", F.create_map().cast("map<string,string>")), F.coalesce("fields", F.create_map().cast("map<string,string>"))
    stated = F.array_compact(F.array(F.when(named, F.lit("entity_name")), F.lit("record_type")))
    applies = F.element_at(F.create_map(*[x for k in kinds for x in (F.lit(k.name), F.array(*map(F.lit, k.applicable)).cast("array<string>"))]), F.col(f"{h}kind"))
    settled = lambda f: F.coalesce(F.try_element_at(presence, f) == "populated", F.lit(False)) | X.is_populated(F.try_element_at(fields, f))
    barred = F.array_except(F.filter(F.array(*map(F.lit, core)).cast("array<string>"), lambda f: ~F.array_contains(applies, f) & ~settled(f)), stated)
    same = lambda ks, code: F.map_from_arrays(ks, F.transform(ks, lambda _: F.lit(code)))
    left = F.map_filter(presence, lambda k, _: ~F.array_contains(stated, k) & ~F.array_contains(barred, k))

    new = {
        "subclass": F.when(moved, F.col(f"{h}kind")).otherwise(F.col("subclass")),
        "entity_name": F.coalesce(company, F.col("entity_name")),
        "subject": F.when(named, F.concat(phrase, F.lit(" of "), company, F.when(F.endswith(company, F.lit(".")), "").otherwise("."))).otherwise(F.col("subject")),
        "keywords": keywords,
        "record_type": record_type,
        "intent": intent,
        "presence": F.map_concat(left, same(stated, "populated"), same(barred, "not_applicable")),
    }
    changes = [
        F.when(moved, F.concat(F.lit("subclass:"), f"{h}own", F.lit("->"), f"{h}kind")),
        F.when(named, "entity_name"),
        F.when(named, "subject"),
        F.when(~keywords.eqNullSafe(F.col("keywords")), "keywords"),
        F.when(~record_type.eqNullSafe(F.col("record_type")), "record_type"),
        F.when(~intent.eqNullSafe(F.col("intent")), F.concat(F.lit("intent:"), text("intent"), F.lit("->"), intent)),
    ]
    helpers = [f"{h}{x}" for x in ("own", "cued", "company", "moved", "kind")]
    return df.withColumns({**new, "changes": F.array_compact(F.array(*changes))}).drop(*helpers)


def family_of(rows: DataFrame, surface: str, families: DataFrame, rest: str = "other") -> DataFrame:
    """``rows`` with ``family``: the key of the family that has ``surface`` as key, label or other spelling.

    ``families`` has key, label (strings), surfaces (array) and place, which says which of two
    families with one spelling has it. Spellings are compared compactly; null and empty ones,
    and those of no family, are ``rest``. The spellings are one row each before the join, which
    therefore adds no rows; the planner broadcasts them if their size allows, and else splits hot ones.
    """
    spelt = F.concat(F.array("key", "label"), F.coalesce("surfaces", F.array().cast("array<string>")))
    aliases = families.select("key", "place", F.explode(F.transform(spelt, compact)).alias("spelling")).where("spelling <> ''")
    one = aliases.groupBy("spelling").agg(F.min(F.struct("place", "key"))["key"].alias("found"))
    at = compact(rows[surface])
    joined = rows.join(one, at == one["spelling"], "left")
    return joined.select(*[rows[c] for c in rows.columns if c.lower() != "family"], F.coalesce(one["found"], F.lit(rest)).alias("family"))
