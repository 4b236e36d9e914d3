"""Language identification by rank-order profiles of character n-grams.

A language's profile is the ranking of its most frequent n-grams (one to three characters,
words padded with a boundary) over all labelled training texts. A text is given the
language whose profile is nearest to the text's own ranking by the out-of-place distance:
the sum of the differences of ranks, with the profile's length for n-grams it lacks.

Counting is vectorised over slices of a few MB. Each task merges its counts before they
are shuffled, and adding them up has map-side partials, so a language that most rows have
is not gathered anywhere. The profiles (``size`` n-grams for each label value) are the
whole model; they go to the tasks in the closure.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.shingles import slices

PROFILE_SIZE, LONGEST = 300, 3
UNKNOWN = "und"
#: Tells an n-gram's order, by codes in front that no character has.
_ORDER = {1: 0x1FFFFF << 42, 2: 0x1FFFFE << 42, 3: 0}
#: Held-out rows: crc32 of the doc_id as text, modulo this, is 0.
FOLDS = 5
#: A model of more labels than this isn't one of languages; fitting it raises an error.
MOST_LABELS = 10_000
#: A text with a lower score is in none of the learnt languages.
LEAST_SCORE = 0.3
#: Bytes of text that are counted at once; counting takes some forty times as much memory.
SLICE_BYTES = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Whether a row is left out of training; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, the n-grams of all texts as numbers, and the bounds of each text.

    Characters that are not letters are boundaries; a run of them is one boundary. An
    n-gram has a boundary at its ends only. Characters take 21 bits each.
    """
    low = [t.lower() + " " for t in texts]
    codes = np.frombuffer(" ".encode("utf-32-le") + "".join(low).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    ends = 1 + np.cumsum([len(t) for t in low]) if low else np.zeros(0, int)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    codes = np.where(letter, codes, 0)[keep]
    bounds = np.concatenate(([0], np.cumsum(keep)[ends - 1] - 1)) if low else np.zeros(1, int)
    word = codes > 0
    out = []
    for n in range(1, LONGEST + 1):
        m = max(0, len(codes) - n + 1)
        gram = np.zeros(m, np.int64)
        for k in range(n):
            gram = gram << 21 | codes[k : k + m]
        good = word[:m].copy() if n == 1 else np.ones(m, bool)
        for k in range(1, n - 1):
            good &= word[k : k + m]
        if n == 2:
            good &= word[:m] | word[1 : 1 + m]
        out.append((gram[good] | _ORDER[n], np.concatenate(([0], np.cumsum(good)))[np.minimum(bounds, m)]))
    return out


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        return [(grams, np.bincount(at, np.concatenate([c for _, c in parts]), len(grams)).astype(np.int64))]

    for batch in batches:
        for part in slices(batch, 0, SLICE_BYTES):
            texts, langs = part.column(0).to_pylist(), part.column(1).to_pylist()
            by: dict[str, list[str]] = {}
            for text, lang in zip(texts, langs, strict=True):
                by.setdefault(lang, []).append(text)
            for lang, own in by.items():
                parts = held.setdefault(lang, [])
                parts += [np.unique(grams, return_counts=True) for grams, _ in _grams(own)]
                if len(parts) > 30:
                    held[lang] = merged(parts)
    for lang, parts in held.items():
        grams, counts = merged(parts)[0]
        for k in range(0, len(grams), 50_000):
            g, c = grams[k : k + 50_000], counts[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(c)], ["lang", "gram", "n"])


class Profiles:
    """Ranks of n-grams by language: for each n-gram, the languages that have it and its ranks.

    16 bytes an entry, so ``MOST_LABELS`` profiles of 300 n-grams take 48 MB at most.
    """

    def __init__(self, ranked: dict[str, list[int]], size: int):
        self.size, self.langs = size, sorted(ranked)
        every = np.concatenate([np.array(ranked[k], np.int64) for k in self.langs]) if ranked else np.zeros(0, np.int64)
        sizes = [len(ranked[k]) for k in self.langs]
        order = np.argsort(every, kind="stable")
        self.lang = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
        self.rank = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes] or [np.zeros(0, np.int32)])[order]
        self.grams, starts = np.unique(every[order], return_index=True)
        self.bounds = np.append(starts, len(every))

    def nearest(self, ordered: np.ndarray) -> tuple[str, float]:
        """The nearest language to a text's n-grams, most frequent first, and a score."""
        if not len(ordered) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, ordered), len(self.grams) - 1)
        own = np.flatnonzero(self.grams[at] == ordered)
        starts, counts = self.bounds[at[own]], self.bounds[at[own] + 1] - self.bounds[at[own]]
        ends = np.cumsum(counts)
        found = np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)
        nearer = self.size - np.abs(self.rank[found] - np.repeat(own, counts))
        away = self.size * len(ordered) - np.bincount(self.lang[found], nearer, len(self.langs)).astype(np.int64)
        best = int(np.argmin(away))
        return self.langs[best], 1.0 - float(away[best]) / (self.size * len(ordered))


def fit(labelled: DataFrame, size: int = PROFILE_SIZE) -> Profiles:
    """Profiles from ``labelled(text, lang)``; rows without a text or label are ignored."""
    rows = labelled.where("text is not null and lang is not null").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = rows.mapInArrow(_count_rows, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= size)
    found = top.select("lang", "gram", "rank").limit(size * MOST_LABELS + 1).collect()
    if len(found) > size * MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} languages")
    ranked: dict[str, list[int]] = {}
    for row in sorted(found, key=lambda r: (r["lang"], r["rank"])):
        ranked.setdefault(row["lang"], []).append(row["gram"])
    return Profiles(ranked, size)


def _predicted_rows(profiles: Profiles):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                texts = [t or "" for t in part.column(2).to_pylist()]
                orders, langs, scores = _grams(texts), [], []
                for k in range(len(texts)):
                    own = np.concatenate([grams[bounds[k] : bounds[k + 1]] for grams, bounds in orders])
                    grams, counts = np.unique(own, return_counts=True)
                    first = np.argsort(-counts, kind="stable")[: profiles.size]
                    lang, score = profiles.nearest(grams[first])
                    langs.append(lang)
                    scores.append(score)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return rows


def identify(docs: DataFrame, size: int = PROFILE_SIZE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs(doc_id, text, lang)``.

    Profiles are learnt from the rows that are not held out and have a label. A prediction
    is made from the text alone. A text that is null or has no letter is ``und`` with
    score 0, as is every text if there are no labelled rows. The score is 1 less the
    distance over the greatest possible one. Of equally near languages the first by name
    is given. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    profiles = fit(rows.where("not held_out"), size)
    return rows.select("doc_id", "held_out", "text").mapInArrow(_predicted_rows(profiles), "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, size: int = PROFILE_SIZE, least: float = LEAST_SCORE, langs: list[str] | None = None) -> DataFrame:
    """``docs`` without the rows whose text is in none of the learnt languages.

    A row goes if its text is ``und``, if its nearest profile is not of ``langs`` (None:
    any learnt one) or if the score is under ``least``: a text in another alphabet has
    score 0, random letters about 0.2. Texts of a learnt language have 0.36 or more on the
    labelled data, one-word texts and junk of repeated words included, so they stay.

    Null and empty texts go, of any length; repeated rows and rows with a null doc_id are
    judged by their text like all others. Without labelled rows there are no profiles, and
    only texts without a letter go. An empty table stays empty. All columns are kept as
    they are, whatever their names. The verdict is on the text alone, so it is made where
    the text is and no rows are joined back.
    """
    profiles = fit(docs.select(F.col("text"), F.col("lang"), held_out(F.col("doc_id")).alias("held_out")).where("not held_out"), size)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = docs_columns.index("text")
        predict = _predicted_rows(profiles)
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                none = pa.nulls(part.num_rows, pa.int64())
                judged = predict(iter([pa.RecordBatch.from_arrays([none, none, part.column(text)], ["doc_id", "held_out", "text"])]))
                if not profiles.langs:
                    marks = [any(map(str.isalpha, t or "")) for t in part.column(text).to_pylist()]
                    yield part.filter(pa.array(marks, pa.bool_()))
                    continue
                marks = [lang != UNKNOWN and score >= least and (langs is None or lang in langs) for j in judged for lang, score in zip(j.column(2).to_pylist(), j.column(3).to_pylist(), strict=True)]
                yield part.filter(pa.array(marks, pa.bool_()))

    docs_columns = [c.lower() for c in docs.columns]
    return docs.mapInArrow(rows, docs.schema)
