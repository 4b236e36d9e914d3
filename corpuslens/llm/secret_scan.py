"""Secret scanning: patterns of known shape, and Shannon entropy over sliding windows.

Candidate strings are runs of the characters that keys and tokens are made of. Each is put
in a class by its characters; a window slides over it and its entropy is kept up by the
counts of the one character that leaves and the one that enters. Windows at or above the
class's threshold make spans, unless the allow-list suppresses them: whole candidates that
are UUIDs, numbers or plain words, or beside the @ of an e-mail address; the host of a URL
or connection string and those parts of its path that are words and numbers; and windows
that overlap a placeholder. The user-info of a URL, its query, and parts of its path that
mix letters and digits are scanned like other text, each part by itself.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.shingles import slices

KINDS = ("assign", "access", "hex", "ent_hex", "ent_alnum", "ent_base64")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: (characters of a window, bits) at which a window counts, by class.
WINDOWS = {"ent_hex": (24, 3.0), "ent_alnum": (20, 3.6), "ent_base64": (20, 3.9)}
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_LONG_RUN = re.compile(r"[^\x00-\x20]{20}")
_ALLOWED = [
    re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"),
    re.compile(r"[0-9_/+-]+"),
    re.compile(r"[A-Za-z]+([_/-][A-Za-z]*)*"),
]
#: Windows that overlap one of these are suppressed; the rest of the candidate isn't.
_PLACEHOLDER = re.compile(r"example|placeholder|changeme|x{6,}|0{8,}|12345678", re.IGNORECASE)
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://([^\x00-\x20/?#\"'<>]*)[^\x00-\x20?#=&\"'<>]*")
_WORDY = re.compile(r"(?:[A-Za-z]+|[0-9]+)(?:[_+-](?:[A-Za-z]+|[0-9]+)?)*")


def window_entropy(counts: dict[str, int], size: int) -> float:
    return math.log2(size) - sum(c * math.log2(c) for c in counts.values()) / size


def entropy_runs(text: str, size: int, least: float) -> list[tuple[int, int]]:
    """Merged spans of the windows of ``text`` whose entropy in bits is ``least`` or more.

    ``sum(c log2 c)`` is carried along: a step changes two counts only. A text shorter
    than ``size`` has no window.
    """
    if len(text) < size:
        return []
    table = [0.0, *(c * math.log2(c) for c in range(1, size + 1))]
    counts: dict[str, int] = {}
    total = 0.0
    found: list[list[int]] = []
    most = size * (math.log2(size) - least) + 1e-9  # what the carried sum may be
    for k, c in enumerate(text):
        n = counts.get(c, 0)
        total += table[n + 1] - table[n]
        counts[c] = n + 1
        if k >= size:
            out = text[k - size]
            n = counts[out]
            total += table[n - 1] - table[n]
            counts[out] = n - 1
        if k >= size - 1 and total <= most:
            if found and found[-1][1] >= k + 1 - size:
                found[-1][1] = k + 1
            else:
                found.append([k + 1 - size, k + 1])
    return [(a, b) for a, b in found]


def string_class(text: str) -> str | None:
    """The class of a candidate; None if it is no mix of letters and digits."""
    digit, letter = any(c.isdigit() for c in text), any(c.isalpha() for c in text)
    if not (digit and letter):
        return None
    body = text.rstrip("=")
    if all(c in "0123456789abcdef" for c in body) or all(c in "0123456789ABCDEF" for c in body):
        return "ent_hex"
    return "ent_alnum" if body.isalnum() else "ent_base64"


def allowed(text: str) -> bool:
    return any(p.fullmatch(text) for p in _ALLOWED)


def _pieces(a: int, b: int, urls: list[tuple[int, int, int, int]], text: str) -> Iterator[tuple[int, int, bool]]:
    """The parts of the candidate from ``a`` to ``b`` that are scanned, and whether each lies in a URL.

    ``urls`` are the begin, host, end of the host, and end of those that it overlaps.
    """
    for begin, host, path, end in urls:
        if a < begin:
            yield a, min(b, begin), False
        for low, high in ((max(a, begin), min(b, host)), (max(a, path), min(b, end))):
            while low < high:
                cut = text.find("/", low, high)
                cut = high if cut < 0 else cut
                yield low, cut, True
                low = cut + 1
        a = max(a, end)
    if a < b:
        yield a, b, False


def _entropy_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the entropy classes, from the candidates that are not on the allow-list."""
    out: list[tuple[str, int, int]] = []
    urls = []
    for m in _URL.finditer(text) if "://" in text else []:
        info = text.rfind("@", *m.span(1))
        urls.append((m.start(), m.start(1) if info < 0 else info + 1, m.end(1), m.end()))
    k = 0
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        while k < len(urls) and urls[k][3] <= a:
            k += 1
        own = k
        while own < len(urls) and urls[own][0] < b:
            own += 1
        for a, b, inside in _pieces(*m.span(), urls[k:own], text):
            word = text[a:b]
            kind = string_class(word) if b - a >= 20 else None
            if not kind or allowed(word) or (_WORDY.fullmatch(word) if inside else text[a - 1 : a] == "@" or text[b : b + 1] == "@"):
                continue
            size, least = WINDOWS[kind]
            at = 0
            for start, end in [*(p.span() for p in _PLACEHOLDER.finditer(word)), (len(word), len(word))]:
                out += [(kind, a + at + i, a + at + j) for i, j in entropy_runs(word[at:start], size, least)]
                at = end
    return out


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and entropy spans, each (kind, start, end) in code points."""
    base = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        base += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        base += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    more: list[tuple[str, int, int]] = []
    if _LONG_RUN.search(text):
        base += [("hex", *m.span()) for m in _HEX.finditer(text)]
        more = _entropy_spans(text)
    return base, more


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


def _scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            out: list[list] = [[], [], [], [], []]
            for text in part.column(1).to_pylist():
                base, more = scan(text or "")
                for k, kind in enumerate(KINDS[:3]):
                    out[k].append(sum(s[0] == kind for s in base))
                out[3].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out[4].append(joined(base + more))
            columns = [part.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), *(pa.array(c, pa.string()) for c in out[3:])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Spans of secrets in every text of ``docs(doc_id, text)``, one row per row.

    n_assign, n_access and n_hex count the base patterns, base_sha256 digests their spans,
    and spans has all spans, those of the entropy classes too, as kind:start:end by start
    and kind. A null or empty text has no spans: counts 0, empty spans. Repeated rows give
    repeated results; a null doc_id stays null. An empty table gives no rows; other
    columns are not read.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(_scan_rows, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
