"""Order-preserving packing of documents into fixed windows by dynamic programming.

Documents are taken in ascending doc_id order as one stream of ids. Cuts are chosen among
document ends, sentence ends and, where sentences are long, a grid of places, so that the
padding plus penalties for cut documents is least. With positions p and a window W, the
cost up to a cut j is

    cost[j] = penalty[j] + min over i, p[j] - p[i] <= W, of cost[i] + W - (p[j] - p[i])

whose minimum over a sliding window of cost[i] + p[i] a monotone queue gives in constant
time. A sequence whose length is a power of two is not padded, so a cut may also continue
one that lies exactly such a length before it, at no cost for padding.

Range partitions keep the order; each task packs its own part, run by run, and carries a
run's last sequence over into the next. A task's last sequence is split at powers of two
where this costs less than padding.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.shingles import slices
from corpuslens.llm.tokenizing import WORD_BPE, encoder

WINDOW, END_ID = 4096, 2
#: In tokens of padding: what a cut at a sentence end or inside a sentence costs.
SENTENCE_PENALTY, HARD_PENALTY = 4, 32
#: Ids in a run, and the grid inside long sentences.
RUN_IDS, GRID = 1 << 19, 256
#: Bytes of text that a task encodes at once.
SLICE_BYTES = 1 << 20
#: Lengths that need no padding; those below the window are tried.
_SHORT = [1 << k for k in range(31)]


def cut_places(ends: np.ndarray, stops: np.ndarray, total: int, window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Places where the stream may be cut, from 0 on, with their penalties.

    ``ends`` are the document ends and ``stops`` the sentence ends, both ascending.
    """
    grid = min(GRID, window)
    places = np.union1d(ends, stops)
    places = places[(places > 0) & (places <= total)]
    soft = np.where(np.isin(places, ends), 0, SENTENCE_PENALTY)
    edges = np.concatenate(([0], places, [total]))
    wide = np.flatnonzero(np.diff(edges) > grid)
    hard = np.concatenate([np.arange(edges[k] + grid, edges[k + 1], grid) for k in wide]) if len(wide) else places[:0]
    places, soft = np.concatenate((places, hard)), np.concatenate((soft, np.full(len(hard), HARD_PENALTY)))
    order = np.argsort(places, kind="stable")
    return [0, *places[order].tolist()], [0, *soft[order].tolist()]


def _short_pairs(places: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """Indices ``j``, rising, and ``i`` of places that lie a length of ``_SHORT`` apart; a -1 ends ``j``."""
    js, starts = [], []
    for s in _SHORT:
        if s < window:
            i = np.searchsorted(places, places - s)
            j = np.flatnonzero(places[i] == places - s)
            js.append(j)
            starts.append(i[j])
    if not js:
        return [-1], []
    j, i = np.concatenate(js), np.concatenate(starts)
    order = np.argsort(j, kind="stable")
    return [*j[order].tolist(), -1], i[order].tolist()


def best_cuts(places: list[int], penalties: list[int], window: int = WINDOW) -> list[int]:
    """The cheapest cuts from the first to the last place; neighbours are within ``window``."""
    n = len(places)
    cost, back = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque([(places[0], 0)])  # (cost + place, index), rising
    js, starts, k = *_short_pairs(np.asarray(places), window), 0
    for j in range(1, n):
        p = places[j]
        while places[queue[0][1]] < p - window:
            queue.popleft()
        value, from_ = queue[0]
        least = value + window - p
        while js[k] == j:
            i = starts[k]
            if cost[i] < least:
                least, from_ = cost[i], i
            k += 1
        cost[j], back[j] = least + penalties[j], from_
        value = cost[j] + p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [places[-1]], n - 1
    while j:
        j = back[j]
        cuts.append(places[j])
    return cuts[::-1]


def tail_lengths(length: int, window: int = WINDOW) -> list[int]:
    """Lengths of the sequences that end a task: powers of two if that beats padding."""
    parts = [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]
    return parts if (len(parts) - 1) * HARD_PENALTY < window - length else [length]


class _Packer:
    def __init__(self, stops: np.ndarray, window: int):
        self.stops, self.window, self.seq = stops, window, 0
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []  # doc_id, ids of it that went before, its count, ids of it in the stream
        self.size = 0
        self.out: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append((doc_id, 0, len(ids), len(ids)))
        self.size += len(ids)

    def flush(self, last: bool) -> None:
        if not self.size:
            return
        stream = np.concatenate(self.ids)
        ends = np.cumsum([d[3] for d in self.docs])
        places, penalties = cut_places(ends, np.flatnonzero(self.stops[stream]) + 1, len(stream), self.window)
        cuts = best_cuts(places, penalties, self.window)
        if last:
            length = cuts[-1] - cuts[-2]
            cuts[-1:] = (cuts[-2] + np.cumsum(tail_lengths(length, self.window))).tolist()
        elif len(cuts) > 2:
            cuts.pop()
        self._emit(stream, ends, cuts)
        keep = cuts[-1]
        first = int(np.searchsorted(ends, keep, "right"))
        rest = self.docs[first:]
        if rest:
            doc_id, before, count, here = rest[0]
            gone = keep - (int(ends[first]) - here)
            rest[0] = (doc_id, before + gone, count, here - gone)
        self.docs, self.ids, self.size = rest, [stream[keep:]], len(stream) - keep

    def _emit(self, stream: np.ndarray, ends: np.ndarray, cuts: list[int]) -> None:
        edges = np.union1d(np.asarray(cuts), np.concatenate(([0], ends[ends < cuts[-1]])))
        doc_of = np.searchsorted(ends, edges[:-1], "right")
        seq_of = np.searchsorted(cuts, edges[:-1], "right") - 1
        raw = stream.astype("<u4").tobytes()
        for a, b, d, s in zip(edges[:-1].tolist(), edges[1:].tolist(), doc_of.tolist(), seq_of.tolist(), strict=True):
            doc_id, before, count, here = self.docs[d]
            start = before + a - (int(ends[d]) - here)
            self.out.append((doc_id, start, b - a, zlib.crc32(raw[4 * a : 4 * b]), count, self.seq + s, a - cuts[s]))
        self.seq += len(cuts) - 1


def _packed_rows(vocabulary: str, window: int, run_ids: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def made(packer: _Packer, base: int) -> pa.RecordBatch:
        columns = list(zip(*packer.out, strict=True)) or [()] * 7
        packer.out = []
        columns[5] = [base + s for s in columns[5]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        stops = np.zeros(max(END_ID + 1, tokens.library.get_vocab_size()), bool)
        for mark in (".", "!", "?", "...", ".\"", "。"):
            if len(ids := tokens.library.encode(mark, add_special_tokens=False).ids) == 1:
                stops[ids[0]] = True
        packer, base = _Packer(stops, window), TaskContext.get().partitionId() << 40
        for batch in batches:
            for piece in slices(batch, 1, SLICE_BYTES):
                texts = tokens.encode(piece.column(1).to_pylist())
                for doc_id, ids in zip(piece.column(0).to_pylist(), texts, strict=True):
                    packer.add(doc_id, np.append(ids, np.uint32(END_ID)))
                    if packer.size >= run_ids:
                        packer.flush(False)
                        yield made(packer, base)
        packer.flush(True)
        yield made(packer, base)

    return rows


def pack(docs: DataFrame, vocabulary: str = WORD_BPE, window: int = WINDOW, run_ids: int = RUN_IDS) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)`` in sequences of at most ``window`` ids.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or
    empty text is a document of its end id alone. Rows with a null doc_id come first; rows
    that share a doc_id are documents of their own. A document longer than a window is cut;
    a task holds the ids of one run, of one slice of texts (``SLICE_BYTES``, or one text
    that is longer) and what an Arrow batch has. An empty table gives no rows.
    Other columns are not read.
    """
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = text.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ordered.mapInArrow(_packed_rows(vocabulary, window, run_ids), kinds)
