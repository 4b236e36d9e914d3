"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text's terms are its positions. The input at a term joins a word vector (terms hashed to
buckets) and a character vector: tanh of the mean of vectors of its characters, each taken
with the one before and after it (UTF-8 bytes, hashed to buckets). A forward and a backward
gated recurrent layer run over each window of ``2 * BLOCK`` terms; windows overlap by half,
so together they cover the whole text. Attention weighs the states of a window into one
vector and that gives the window's logit. A text is as toxic as its most toxic window.

The network is trained here in NumPy, by back-propagation through time with Adam: in each
document of a batch the window with the highest logit learns the document's label. Training
rows are a bounded sample, ``MOST_DOCS`` a label by a hash of the id, of at most
``MOST_CHARS`` characters, whole; scoring is over all rows and whole texts. Labels are
joined by a broadcast of the sample's ids, so no text is shuffled. The weights (under 1 MB)
go to the tasks in the closure, which score slices of a bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.langid import held_out
from corpuslens.llm.shingles import _LOWER, slices, text_buffers, word_hashes
from corpuslens.llm.terms import term_spans

#: Terms in half a window.
BLOCK = 8
HIDDEN, WORD_SIZE, CHAR_SIZE = 8, 6, 12
WORD_BUCKETS, CHAR_BUCKETS = 1 << 12, 1 << 13
#: Labelled rows that are learnt from: so many of each label, of texts of so many characters at most.
MOST_DOCS, MOST_CHARS = 1500, 6000
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.01, 13
#: Bytes of text that are scored at once; it takes some fifty times as much memory.
SLICE_BYTES = 512 << 10
#: Texts with this score or more are predicted as toxic.
LEAST_SCORE = 0.5


@dataclass
class Inputs:
    """Texts as blocks of ``BLOCK`` terms; each text has two blocks at least.

    ``place`` is where each term is in the blocks. Windows are pairs of adjacent blocks of
    a text: ``first[k]`` to ``first[k + 1] - 2`` are those of text k.
    """

    words: np.ndarray
    chars: np.ndarray
    starts: np.ndarray
    place: np.ndarray
    first: np.ndarray

    @property
    def blocks(self) -> int:
        return int(self.first[-1])


def encode(column: pa.Array) -> Inputs:
    """The inputs of the texts of ``column``."""
    data, offsets = text_buffers(column)
    starts, ends = term_spans(data, offsets)
    words = (word_hashes(data, starts, ends) >> np.uint64(20)).astype(np.int64) % WORD_BUCKETS
    low = np.concatenate([[0], _LOWER[data], [0]]).astype(np.uint32)
    inside = np.zeros(len(data) + 2, bool)
    edges = np.zeros(len(data) + 2, np.int32)
    edges[starts + 1] += 1
    edges[ends + 1] -= 1
    inside = np.cumsum(edges) > 0
    low[~inside] = 0
    at = np.flatnonzero(inside)
    before, after = low[at - 1].copy(), low[at + 1].copy()
    own = np.cumsum(ends - starts)
    heads = own - (ends - starts)
    if len(at):  # a term that ends a text may touch the next text's first
        before[heads], after[own - 1] = 0, 0
    grams = (before << np.uint32(16)) | (low[at] << np.uint32(8)) | after
    chars = ((grams * np.uint32(0x9E3779B1)) >> np.uint32(8)).astype(np.int64) % CHAR_BUCKETS
    bounds = np.searchsorted(starts, offsets)
    counts = np.diff(bounds)
    blocks = np.maximum(2, -(-counts // BLOCK))
    first = np.concatenate([[0], np.cumsum(blocks)])
    place = np.arange(len(starts)) - np.repeat(bounds[:-1], counts) + BLOCK * np.repeat(first[:-1], counts)
    return Inputs(words, chars, heads, place, first)


Weights = dict[str, np.ndarray]


def fresh(rng: np.random.Generator) -> Weights:
    """Weights before training; ``f`` and ``b`` are the two directions."""
    size = WORD_SIZE + CHAR_SIZE
    draw = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
    out = {"word": draw(0.1, WORD_BUCKETS, WORD_SIZE), "char": draw(0.5, CHAR_BUCKETS, CHAR_SIZE)}
    for d in "fb":
        out |= {f"in_{d}": draw(size**-0.5, 3 * HIDDEN, size), f"rec_{d}": draw(HIDDEN**-0.5, 3 * HIDDEN, HIDDEN), f"bias_{d}": np.zeros((3 * HIDDEN, 1), np.float32)}
    return out | {"focus": draw(0.3, 2 * HIDDEN), "out": draw(0.3, 2 * HIDDEN), "base": np.array([-1.0], np.float32)}


def _vectors(w: Weights, x: Inputs) -> tuple[np.ndarray, np.ndarray]:
    """Each term's input vector, and the means of its characters' vectors before tanh."""
    if not len(x.words):
        return np.zeros((0, WORD_SIZE + CHAR_SIZE), np.float32), np.zeros((0, CHAR_SIZE), np.float32)
    sums = np.add.reduceat(w["char"][x.chars], x.starts, axis=0)
    sizes = np.diff(np.append(x.starts, len(x.chars))).astype(np.float32)
    chars = np.tanh(sums / sizes[:, None])
    return np.concatenate([w["word"][x.words], chars], axis=1), sizes


def _step(w: Weights, d: str, drive: np.ndarray, h: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, tuple]:
    """One gated step over all windows: states are ``HIDDEN`` rows of one column a window; a window without a term here keeps its state."""
    rec = w[f"rec_{d}"] @ h
    gates = 0.5 + 0.5 * np.tanh(0.5 * (drive[: 2 * HIDDEN] + rec[: 2 * HIDDEN]))
    r, z = gates[:HIDDEN], gates[HIDDEN:]
    new = np.tanh(drive[2 * HIDDEN :] + r * rec[2 * HIDDEN :])
    keep = np.where(live, z, np.float32(1))
    return new + keep * (h - new), (rec, r, z, new, keep)


def _drives(w: Weights, d: str, vectors: np.ndarray, x: Inputs, blocks: int) -> np.ndarray:
    """What the inputs add to the gates: by place in a block, gate and block."""
    out = np.zeros((blocks * BLOCK, 3 * HIDDEN), np.float32)
    out[x.place] = vectors @ w[f"in_{d}"].T
    return np.ascontiguousarray(out.reshape(blocks, BLOCK, 3 * HIDDEN).transpose(1, 2, 0)) + w[f"bias_{d}"]


def window_logits(w: Weights, x: Inputs) -> np.ndarray:
    """The logit of each pair of adjacent blocks; pairs across texts have one too, which means nothing."""
    blocks = x.blocks
    live = np.zeros(blocks * BLOCK, bool)
    live[x.place] = True
    live = np.ascontiguousarray(live.reshape(blocks, BLOCK).T)
    vectors, _ = _vectors(w, x)
    n = blocks - 1
    here = lambda table, t: table[t % BLOCK][..., t // BLOCK : t // BLOCK + n]
    drive = _drives(w, "f", vectors, x, blocks)
    h, ahead = np.zeros((HIDDEN, n), np.float32), []
    for t in range(2 * BLOCK):
        h, _ = _step(w, "f", here(drive, t), h, here(live, t))
        ahead.append(h)
    drive = _drives(w, "b", vectors, x, blocks)
    h, total, pooled = np.zeros((HIDDEN, n), np.float32), np.full(n, 1e-6, np.float32), np.zeros(n, np.float32)
    for t in reversed(range(2 * BLOCK)):
        h, _ = _step(w, "b", here(drive, t), h, here(live, t))
        # states are between -1 and 1, so exp needs no shift
        share = np.exp(w["focus"][:HIDDEN] @ ahead[t] + w["focus"][HIDDEN:] @ h) * here(live, t)
        total += share
        pooled += share * (w["out"][:HIDDEN] @ ahead[t] + w["out"][HIDDEN:] @ h)
    return pooled / total + w["base"][0]


def highest(logits: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text, which of its windows has the highest logit, the first of equal ones."""
    out = np.zeros(len(first) - 1, np.int64)
    for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        out[k] = a + int(np.argmax(logits[a : b - 1]))
    return out


def gradients(w: Weights, x: Inputs, windows: np.ndarray, labels: np.ndarray) -> tuple[float, Weights]:
    """The log loss of ``windows`` (first blocks) with ``labels``, and its gradient, through time."""
    n, steps, hid = len(windows), 2 * BLOCK, HIDDEN
    vectors, sizes = _vectors(w, x)
    term_at = np.full(x.blocks * BLOCK, -1, np.int64)
    term_at[x.place] = np.arange(len(x.words))
    ids = term_at[(windows[:, None] * BLOCK + np.arange(steps)).T]  # steps by windows
    live, given = ids >= 0, vectors[np.maximum(ids, 0)] * (ids >= 0)[..., None] if len(vectors) else np.zeros((steps, n, WORD_SIZE + CHAR_SIZE), np.float32)
    states, kept = {}, {}
    for d, order in (("f", range(steps)), ("b", reversed(range(steps)))):
        h = np.zeros((hid, n), np.float32)
        for t in order:
            last = h
            h, parts = _step(w, d, w[f"in_{d}"] @ given[t].T + w[f"bias_{d}"], h, live[t])
            states[d, t], kept[d, t] = h, (last, *parts)
    both = np.stack([np.concatenate([states["f", t], states["b", t]]) for t in range(steps)])  # steps, 2 hid, n
    share = np.exp(np.einsum("c,tcn->tn", w["focus"], both)) * live
    share /= share.sum(0) + 1e-6
    value = np.einsum("c,tcn->tn", w["out"], both)
    logit = (share * value).sum(0) + w["base"][0]
    p = 1 / (1 + np.exp(-logit))
    loss = float(-(labels * np.log(p + 1e-7) + (1 - labels) * np.log(1 - p + 1e-7)).mean())
    g = {k: np.zeros_like(v) for k, v in w.items()}
    up = ((p - labels) / n).astype(np.float32)
    g["base"][0] = up.sum()
    d_value = share * up
    d_score = d_value * (value - (share * value).sum(0))
    g["out"], g["focus"] = np.einsum("tn,tcn->c", d_value, both), np.einsum("tn,tcn->c", d_score, both)
    d_both = w["out"][None, :, None] * d_value[:, None] + w["focus"][None, :, None] * d_score[:, None]
    d_given = np.zeros_like(given)
    for d, order, part in (("f", reversed(range(steps)), slice(0, hid)), ("b", range(steps), slice(hid, None))):
        back = np.zeros((hid, n), np.float32)
        for t in order:
            last, rec, r, z, new, keep = kept[d, t]
            dh = back + d_both[t, part]
            d_new = dh * (1 - keep) * (1 - new * new)
            d_z = np.where(live[t], dh * (last - new) * z * (1 - z), 0)
            d_r = d_new * rec[2 * hid :] * r * (1 - r)
            d_in = np.concatenate([d_r, d_z, d_new])
            d_rec = np.concatenate([d_r, d_z, d_new * r])
            g[f"in_{d}"] += d_in @ given[t]
            g[f"bias_{d}"] += d_in.sum(1, keepdims=True)
            g[f"rec_{d}"] += d_rec @ last.T
            d_given[t] += d_in.T @ w[f"in_{d}"]
            back = dh * keep + w[f"rec_{d}"].T @ d_rec
    own = ids[live]
    grad = d_given[live]
    np.add.at(g["word"], x.words[own], grad[:, :WORD_SIZE])
    d_mean = grad[:, WORD_SIZE:] * (1 - vectors[own, WORD_SIZE:] ** 2) / sizes[own, None] if len(own) else grad[:, WORD_SIZE:]
    lengths = sizes[own].astype(np.int64) if len(own) else np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    at = np.repeat(x.starts[own] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))
    np.add.at(g["char"], x.chars[at], np.repeat(d_mean, lengths, axis=0))
    return loss, g


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = SEED) -> Weights:
    """Weights learnt from ``texts`` with ``labels`` of 0 and 1; the order of rows is a shuffle by ``seed``."""
    rng = np.random.default_rng(seed)
    w = fresh(rng)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    marks, step = np.array(labels, np.float32), 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for k in range(0, len(order), BATCH):
            own = order[k : k + BATCH]
            x = encode(pa.array([texts[i] for i in own], pa.string()))
            _, g = gradients(w, x, highest(window_logits(w, x), x.first), marks[own])
            step += 1
            rate = RATE * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for name in w:
                first[name] += 0.1 * (g[name] - first[name])
                second[name] += 0.001 * (g[name] ** 2 - second[name])
                w[name] -= (rate * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32)
    return w


def _sample(rows: DataFrame, labels: DataFrame, most_docs: int) -> tuple[list[str], list[int]]:
    """Texts and labels that are learnt from: ``most_docs`` a label at most, none of them held out."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic") == 1).alias("toxic"))
    marks = marks.where(~held_out(F.col("id")))
    order = F.xxhash64(F.lit(SEED), F.col("id"))
    # four times as many ids as rows, as longer texts are left out; the bound makes the broadcast safe
    some = [marks.where(F.col("toxic") == F.lit(t)).orderBy(order, "id").limit(4 * most_docs) for t in (True, False)]
    found = rows.where(F.length("text").between(1, MOST_CHARS)).join(F.broadcast(some[0].unionByName(some[1])), rows["doc_id"] == F.col("id"))
    parts = [found.where(F.col("toxic") == F.lit(t)).orderBy(order, "id", F.xxhash64("text")).limit(most_docs) for t in (True, False)]
    table = parts[0].unionByName(parts[1]).select("text", F.col("toxic").cast("int").alias("toxic")).toArrow()
    return table.column("text").to_pylist(), table.column("toxic").to_pylist()


def learn(docs: DataFrame, labels: DataFrame, most_docs: int = MOST_DOCS) -> Weights | None:
    """Weights from the labelled rows that are not held out; None if not both labels are there."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts, marks = _sample(rows, labels, most_docs)
    return train(texts, marks) if len(set(marks)) == 2 else None


def _score_rows(w: Weights | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, SLICE_BYTES):
                if w is None:
                    scores, tops = np.zeros(part.num_rows), np.zeros(part.num_rows, np.int64)
                else:
                    x = encode(part.column(2))
                    logits = window_logits(w, x)
                    best = highest(logits, x.first)
                    scores, tops = np.round(1 / (1 + np.exp(-logits[best].astype(np.float64))), 6), (best - x.first[:-1]) * BLOCK
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(scores), pa.array((scores >= LEAST_SCORE).astype(np.int32)), pa.array(tops)], ["doc_id", "held_out", "score", "predicted", "top_term"])

    return rows


def score(docs: DataFrame, weights: Weights | None) -> DataFrame:
    """doc_id, held_out, score, predicted and top_term of every row of ``docs(doc_id, text)``.

    ``top_term`` is the number of the term at which the most toxic window begins. A text
    that is null, empty or without terms has one window without terms; its score is what
    the network gives to that, as to any other. Without weights every score is 0. Texts
    may be of any length; repeated rows and null doc_ids are scored by their text like all
    others. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score_rows(weights), "doc_id long, held_out boolean, score double, predicted int, top_term long")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``score`` of all ``docs`` by a network learnt from ``labels(doc_id, toxic)``.

    A doc_id with several labels is toxic if one of them says so; a null label says nothing.
    Rows that share a doc_id all have its label. If no row is labelled as toxic, or none as
    not toxic, there is nothing to learn and every score is 0.
    """
    return score(docs, learn(docs, labels))
