"""Column functions of the scalar derivations: all built-in expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslens.functions import udfs

#: Strings that mean "no value".
EMPTY = ("", "[]", "{}")
PLACEHOLDERS = ("nan", "none", "null")
SPACE = r"(?U)[\s\x1c-\x1f]+"


def is_populated(c: Column) -> Column:
    return ~F.coalesce(F.trim(c.cast("string")), F.lit("")).isin(*EMPTY)


def scrub(c: Column) -> Column:
    return F.when(F.lower(F.trim(c)).isin(*PLACEHOLDERS), "").otherwise(c)


def md5_mod(c: Column, n: int) -> Column:
    """md5 as a 128-bit number modulo ``n``, from its two halves."""
    high = F.conv(F.substring(F.md5(c), 1, 16), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring(F.md5(c), 17, 16), 16, 10).cast("decimal(20,0)")
    return (((high % n) * (2**64 % n) + low % n) % n).cast("int")


def split_of(key: Column) -> Column:
    return F.when(md5_mod(key.cast("string"), 10) == 0, "test").otherwise("train")


def squeeze(c: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def ascii_word(pattern: str) -> str:
    """``pattern`` where no ASCII letter, digit or ``_`` stands beside it; Java's own word ends take other letters in too."""
    return rf"(?<![0-9A-Za-z_])(?:{pattern})(?![0-9A-Za-z_])"


def document_id(corpus: Column, key: Column) -> Column:
    return F.concat(F.lit("DOC-"), F.substring(F.sha2(F.concat_ws("\n", corpus, key), 256), 1, 16))


def tokens(chars: Column) -> Column:
    return chars / 4


def context_band(n_tokens: Column) -> Column:
    return F.when(n_tokens <= 4096, "<=4k").when(n_tokens <= 16384, "<=16k").when(n_tokens <= 32768, "<=32k").otherwise(">32k")


def text_window(c: Column, head: int, tail: int, mark: str) -> Column:
    cut = F.concat(F.substring(c, 1, head), F.lit(mark), F.right(c, F.lit(tail)))
    return F.when(F.length(c) <= head + tail, c).otherwise(cut)


def clean_text(c: Column) -> Column:
    """Line ends to LF, no-break spaces to spaces, control characters dropped."""
    c = F.regexp_replace(c, "\r\n?", "\n")
    return F.regexp_replace(F.translate(c, "\u00a0", " "), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def clean_offset(text: Column, start: Column) -> Column:
    """Where the character at ``start`` (from 0) of ``text`` is after ``clean_text``."""
    split_pair = (F.substring(text, start, F.lit(1)) == "\r") & (F.substring(text, start + 1, F.lit(1)) == "\n")
    return F.length(clean_text(F.substring(text, F.lit(1), start))) - F.when((start > 0) & split_pair, 1).otherwise(0)


def remap_spans(text: Column, spans: Column) -> Column:
    """``spans`` (arrays of start and stop, from 0, exclusive) of ``text`` moved on to ``clean_text(text)``.

    Each becomes (start, stop, quote, problem): ``out of text`` if it isn't a span of the
    text, ``lost`` if nothing of it is left, else null and the quote is its cleaned text.
    """
    whole = F.coalesce(spans, F.array().cast("array<struct<start:int,stop:int>>"))
    moved = udfs.moved_offsets(text, F.flatten(F.transform(whole, lambda s: F.array(s["start"], s["stop"]))))

    def one(s: Column, i: Column, clean: Column, to: Column) -> Column:
        a, b = F.get(to, 2 * i), F.get(to, 2 * i + 1)
        bad = a.isNull() | b.isNull() | (s["start"] > s["stop"])
        problem = F.when(bad, "out of text").when(a == b, "lost")
        return F.struct(F.when(~bad, a).alias("start"), F.when(~bad, b).alias("stop"), F.when(~bad, F.substring(clean, a + 1, b - a)).alias("quote"), problem.alias("problem"))

    # an array of one, so that text is cleaned and offsets are moved once
    both = F.array(F.struct(clean_text(text).alias("clean"), moved.alias("to")))
    return F.get(F.transform(both, lambda x: F.transform(whole, lambda s, i: one(s, i, x["clean"], x["to"]))), F.lit(0))


def normalize_subject(c: Column) -> Column:
    bare = F.regexp_replace(c, r"(?i)^(\s*(re|fw|fwd|aw)\s*:|\s*\[[^\]]*\])+", "")
    return F.lower(squeeze(bare))


def parse_money(c: Column) -> Column:
    """The first number with its unit (k, m, bn, or a word), negative after a minus or in parentheses."""
    part = lambda k: F.regexp_extract(F.lower(F.translate(c, ",", "")), r"(?s)^(\D*)(\d+(?:\.\d+)?)\s*(thousand|million|billion|(?:k|m|b|bn)\b)?(.*)$", k)
    before, unit = F.trim(part(1)), part(3)
    scale = F.when(unit.isin("k", "thousand"), 1e3).when(unit.isin("m", "million"), 1e6).when(unit != "", 1e9).otherwise(1.0)
    negative = before.startswith("-") | before.endswith("-") | (before.startswith("(") & part(4).contains(")"))
    return part(2).try_cast("double") * scale * F.when(negative, -1.0).otherwise(1.0)


def strip_headers(c: Column) -> Column:
    """An e-mail's text without its header lines."""
    lines = F.filter(F.split(c, "\n"), lambda x: ~x.rlike(r"(?i)^(from|to|cc|bcc|date|subject|sent):"))
    return F.trim(F.array_join(lines, "\n"))


def word_set(c: Column) -> Column:
    """Distinct lower-case words of letters and digits."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0)))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def crosswalk(c: Column, table: dict[str, str], rest: str) -> Column:
    """The table's entry for ``c``, else for what is before " / ", else ``rest``."""
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(known, c), F.try_element_at(known, F.split(c, " / ")[0]), F.lit(rest))


def parse_date(c: Column) -> Column:
    """The day written in one of five forms. A form is only tried on texts with its mark, as a failed try costs an exception."""
    forms = (("-", "yyyy-MM-dd"), ("/", "M/d/yyyy"), (",", "MMMM d, yyyy"), (",", "MMM d, yyyy"), (" ", "d MMMM yyyy"))
    return F.coalesce(*[F.to_date(F.try_to_timestamp(F.when(c.contains(mark), c), F.lit(f))) for mark, f in forms])


#: What follows a quoted term where it is defined.
DEFINES = ("means", "shall mean", "shall be", "shall equal", "has the meaning", "shall have the meaning")


def definition(text: Column, term: str, most: int) -> Column:
    """The first line that defines the quoted ``term``, at most ``most`` characters; null if none does."""
    quote = "[\"\u201c\u201d\u2019']"

    def defines(line: Column) -> Column:
        after = F.lower(squeeze(F.get(F.split(line, f"(?i){quote}{re.escape(term)}{quote}", 2), F.lit(1))))
        found = F.lit(False)
        for phrase in DEFINES:
            found = found | after.startswith(phrase)
        return F.coalesce(found, F.lit(False))

    return F.substring(F.get(F.filter(F.split(text, "\n"), defines), F.lit(0)), 1, most)


#: The months by name; their first three letters are names too, and "sept".
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def dates_in(text: Column) -> Column:
    """Every full date written in ``text``, as ISO dates in order; impossible ones are left out.

    Words and marks are taken as tokens, without what may stand between a day and its
    month (ordinal endings, "day", "of", commas, full stops). A date is then a year, month
    and day with hyphens, a month, day and year with slashes, or a named month with a day
    beside it and a year after them.
    """
    names = {short: k for k, name in enumerate(MONTHS, 1) for short in (name[:3], name)} | {"sept": 9}
    month = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    tokens = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}0-9_]+|[^\s\p{L}0-9_]"), F.lit(0))
    tokens = F.transform(tokens, lambda w: F.regexp_replace(w, "^([0-9]{1,2})(st|nd|rd|th)$", "$1"))
    tokens = F.filter(tokens, lambda w: ~w.isin(".", ",", "day", "of"))

    def at(w: Column, i: Column) -> Column:
        a, b, c, d, e = (F.get(w, i + k) for k in range(5))
        year = lambda x: x.rlike("^[0-9]{4}$")
        short = lambda x: x.rlike("^[0-9]{1,2}$")
        named = lambda x: F.try_element_at(month, x).cast("string")
        parts = F.when((b == "-") & (d == "-") & year(a) & c.rlike("^[0-9]{2}$") & e.rlike("^[0-9]{2}$"), F.concat_ws("-", a, c, e))
        parts = parts.when((b == "/") & (d == "/") & short(a) & short(c) & year(e), F.concat_ws("-", e, a, c))
        parts = parts.when(year(c) & short(b) & named(a).isNotNull(), F.concat_ws("-", c, named(a), b))
        free = ~F.coalesce(F.get(w, i - 1) == "-", F.lit(False))  # else the day is of the date before
        return parts.when(year(c) & short(a) & named(b).isNotNull() & free, F.concat_ws("-", c, named(b), a))

    # an array of one, so that the tokens are made once
    found = F.get(F.transform(F.array(tokens), lambda w: F.transform(F.sequence(F.lit(0), F.size(w)), lambda i: at(w, i))), F.lit(0))
    days = F.transform(F.array_compact(found), lambda x: F.to_date(F.try_to_timestamp(x, F.lit("y-M-d"))).cast("string"))
    return F.coalesce(F.array_compact(days), F.array().cast("array<string>"))


def clean_filer(c: Column, states: list[str], countries: list[str]) -> Column:
    """A filer's name without its registry number, and without state codes and tickers at its end.

    An upper-case word in parentheses is a ticker unless it is one of ``countries``.
    """
    bare = squeeze(F.regexp_replace(c, r"\s*\(CIK\s*\d+\)", ""))
    tail = rf"(?:\s*/(?:{'|'.join(states)})/|\s*\((?!(?:{'|'.join(countries)})\))[A-Z][A-Z0-9.\-]{{0,9}}\))+$"
    return F.coalesce(F.trim(F.regexp_replace(bare, tail, "")), F.lit(""))


def relabel(own: Column, subject: Column, record_type: Column, cues: dict[str, str], types: dict[str, str]) -> Column:
    """(subclass, record_type, changes): another subclass if its cue alone is in ``subject``.

    If the row's own cue is there, or two others' are, it stays. The record type is filled
    when it isn't a known one or the subclass has changed.
    """
    present = F.array_compact(F.array(*[F.when(subject.rlike("(?i)" + rx), F.lit(name)) for name, rx in sorted(cues.items())]))
    moved = ~F.array_contains(present, own) & (F.size(present) == 1)
    new = F.when(moved, F.get(present, F.lit(0))).otherwise(own)
    known = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    fill = moved | ~F.coalesce(record_type.isin(list(types.values())), F.lit(False))
    kind = F.when(fill, F.try_element_at(known, new)).otherwise(record_type)
    changes = F.array_compact(F.array(F.when(moved, F.lit("subclass")), F.when(fill & ~kind.eqNullSafe(record_type), F.lit("record_type"))))
    return F.struct(new.alias("subclass"), kind.alias("record_type"), changes.alias("changes"))


def pseudonym(c: Column, names: list[str]) -> Column:
    number = F.conv(F.substring(F.sha2(c, 256), 1, 8), 16, 10).cast("long")
    return F.element_at(F.array(*map(F.lit, names)), (number % len(names) + 1).cast("int"))
