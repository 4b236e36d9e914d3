"""Ranked lexical search by branch and bound over hierarchical max trees.

Documents are dealt to shards of a few MB of text. In a shard each term has a tree over the
range of the shard's documents: a leaf is a document with the term's impact in it, and a
node covers ``FAN`` nodes below it and has their greatest impact. Only nodes under which
the term occurs are kept, in order of term and node, with a pointer to the first child.

A query starts at the roots of its terms. The weighted sum of the terms' greatest impacts
under a node bounds the score of every document there. The node with the highest bound is
opened first: its children's bounds are summed up from the terms' child nodes, and those of
documents are their scores. Once ``k`` documents are found, a node is opened only if its
bound is the k-th score or more; at an equal bound it may hold a document of that score and
a smaller id, so it is opened too. A task keeps the k best of each query over all its
shards, so later shards are pruned by what earlier ones had.

Scores are sums of 64-bit integers, equal on any number of tasks. Terms are 64-bit hashes.
The text is read once; the index holds the terms that the queries have (all terms, if
these are more than ``MOST_TERMS``). Queries go to the tasks in blocks of bounded size. Each
task sends at most k rows a query, which are ranked within salts before they meet.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.shingles import slices, text_buffers, word_hashes
from corpuslens.llm.store import Workspace
from corpuslens.llm.terms import term_spans

TOP = 50
#: Bytes of text in a shard at most; a longer text is a shard of its own.
SHARD_BYTES = 4 << 20
#: Children of a tree's node.
FAN = 32
#: Terms that are looked for in the texts, 8 bytes each; with more, all terms are indexed.
MOST_TERMS = 1 << 20
#: A block of queries: so many at most, and so many distinct terms of each added up, but for one query alone.
BLOCK_QUERIES, BLOCK_TERMS = 1024, 1 << 18
#: Rows of a query are ranked in so many parts first.
SALTS = 64

_POSTINGS = "doc_ids array<long>, sizes array<long>, terms array<long>, dfs array<int>, docs binary, tfs binary"
_TREES = "doc_ids array<long>, terms array<long>, levels array<struct<nodes: binary, highest: binary, children: binary>>"
_FOUND = "query int, doc_id long, score long"
_LEVELS = pa.list_(pa.struct([("nodes", pa.binary()), ("highest", pa.binary()), ("children", pa.binary())]))


def hashed_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of the texts in order, and the number of the text that each is in."""
    data, offsets = text_buffers(column)
    starts, ends = term_spans(data, offsets)
    return word_hashes(data, starts, ends).view(np.int64), np.searchsorted(offsets, starts, "right") - 1


def _posting_rows(wanted: np.ndarray | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SHARD_BYTES):
                hashes, owner = hashed_terms(part.column(1))
                sizes = np.bincount(owner, minlength=part.num_rows)
                if wanted is not None:
                    at = np.minimum(np.searchsorted(wanted, hashes), max(len(wanted) - 1, 0))
                    there = wanted[at] == hashes if len(wanted) else np.zeros(len(hashes), bool)
                    hashes, owner = hashes[there], owner[there]
                terms, which = np.unique(hashes, return_inverse=True)
                pairs, tfs = np.unique(which * part.num_rows + owner, return_counts=True)
                dfs = np.bincount(pairs // part.num_rows, minlength=len(terms))
                one = lambda x, t: pa.array([x], pa.list_(t))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays([0, part.num_rows], part.column(0)),
                        one(sizes, pa.int64()),
                        one(terms, pa.int64()),
                        one(dfs.astype(np.int32), pa.int32()),
                        pa.array([(pairs % part.num_rows).astype(np.int32).tobytes()]),
                        pa.array([tfs.astype(np.int32).tobytes()]),
                    ],
                    ["doc_ids", "sizes", "terms", "dfs", "docs", "tfs"],
                )

    return rows


def impacts(tf: np.ndarray, size: np.ndarray, n: int, total: int) -> np.ndarray:
    """A term's share of the score before its weight, from its count and the document's size."""
    length = 50 + (50 * size * n) // max(total, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * length)


def tree_levels(term: np.ndarray, doc: np.ndarray, value: np.ndarray, n_docs: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(nodes, highest, children)`` of each level from the documents up to the roots.

    Entries are in order of term and node. ``children`` has the place of an entry's first
    child in the level below, and one place more at its end; at the roots there is one
    entry a term.
    """
    levels = [(doc, value, np.zeros(0, np.int64))]
    while n_docs > 1 or len(levels) == 1:
        doc, n_docs = doc // FAN, -(-n_docs // FAN)
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
        starts = np.flatnonzero(new)
        value = np.maximum.reduceat(value, starts) if len(starts) else value[:0]
        term, doc = term[starts], doc[starts]
        levels.append((doc, value, np.append(starts, len(new))))
    return levels


def _tree_rows(n: int, total: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                doc_ids, sizes, terms, dfs, docs, tfs = (batch.column(c).slice(k, 1) for c in range(6))
                doc, tf = (np.frombuffer(x[0].as_py(), np.int32).astype(np.int64) for x in (docs, tfs))
                term = np.repeat(np.arange(len(dfs.flatten())), dfs.flatten().to_numpy())
                sizes = sizes.flatten().to_numpy()
                levels = tree_levels(term, doc, impacts(tf, sizes[doc], n, total), len(sizes))
                packed = [{"nodes": a.astype(np.int32).tobytes(), "highest": b.astype(np.int32).tobytes(), "children": c.astype(np.int32).tobytes()} for a, b, c in levels]
                yield pa.RecordBatch.from_arrays([doc_ids, terms, pa.array([packed], _LEVELS)], ["doc_ids", "terms", "levels"])

    return rows


class Best:
    """The ``k`` best documents of a query: by score, of equal ones the smallest ids, null ids last."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    @property
    def least(self) -> int:
        """A document or bound below this can't count any more."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def offer(self, score: int, doc_id: int | None) -> None:
        row = (score, doc_id is not None, -(doc_id or 0))
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, row)
        elif row > self.heap[0]:
            heapq.heapreplace(self.heap, row)


def descend(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], roots: np.ndarray, weights: np.ndarray, doc_ids: list[int | None], best: Best) -> int:
    """Offer ``best`` the documents of a shard that may be among a query's best; the number of opened nodes.

    ``roots`` are the entries of the query's terms at the highest level.
    """
    top = len(levels) - 1
    bound = int((weights * levels[top][1][roots]).sum())
    nodes, order, opened = [(-bound, 0, top, 0, roots, weights)], 0, 0
    while nodes and -nodes[0][0] >= best.least:
        _, _, level, node, entries, weights = heapq.heappop(nodes)
        opened += 1
        starts = levels[level][2][entries]
        counts = levels[level][2][entries + 1] - starts
        ends = np.cumsum(counts)
        below = np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1])
        weight = np.repeat(weights, counts)
        child = levels[level - 1][0][below] - node * FAN
        bounds = np.zeros(FAN, np.int64)
        np.add.at(bounds, child, weight * levels[level - 1][1][below])
        for c in np.flatnonzero(bounds >= best.least).tolist():
            if level == 1:
                best.offer(int(bounds[c]), doc_ids[node * FAN + c])
            else:
                own, order = child == c, order + 1
                heapq.heappush(nodes, (-int(bounds[c]), order, level - 1, node * FAN + c, below[own], weight[own]))
    return opened


def _found_rows(queries: list[tuple[int, np.ndarray, np.ndarray]], k: int):
    """``queries``: number, sorted term hashes and their weights."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: Best(k) for number, _, _ in queries}
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, terms = batch.column(0).slice(i, 1).flatten().to_pylist(), batch.column(1).slice(i, 1).flatten().to_numpy()
                if not len(terms):
                    continue
                kinds = (np.int32, np.int64, np.int32)
                levels = [tuple(np.frombuffer(x[c], np.int32).astype(t) for c, t in zip(("nodes", "highest", "children"), kinds, strict=True)) for x in batch.column(2)[i].as_py()]
                for number, hashes, weights in queries:
                    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
                    there = (terms[at] == hashes) & (weights > 0)
                    if there.any():
                        descend(levels, at[there], weights[there], doc_ids, best[number])
        for number, own in best.items():
            if own.heap:
                ids = [-x[2] if x[1] else None for x in own.heap]
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(ids), pa.int32()), pa.array(ids, pa.int64()), pa.array([x[0] for x in own.heap], pa.int64())], ["query", "doc_id", "score"])

    return rows


class Index:
    """Trees of ``docs(doc_id, text)``, written as a table, with the counts that weights need.

    ``terms`` are the hashes that it holds (sorted); None: all terms.
    """

    def __init__(self, docs: DataFrame, work: Workspace, terms: np.ndarray | None = None):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.postings = work.write(rows.mapInArrow(_posting_rows(terms), _POSTINGS), "postings")
        sums = self.postings.select(F.expr("aggregate(sizes, 0L, (a, x) -> a + if(x > 0, 1L, 0L))").alias("n"), F.expr("aggregate(sizes, 0L, (a, x) -> a + x)").alias("total"))
        row = sums.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")).first()
        self.n, self.total = row["n"], row["total"]
        self.trees = work.write(self.postings.mapInArrow(_tree_rows(self.n, self.total), _TREES), "trees")
        pairs = self.postings.select(F.explode(F.arrays_zip("terms", "dfs")).alias("p")).select("p.terms", "p.dfs")
        self.dfs = work.write(pairs.groupBy(F.col("terms").alias("term")).agg(F.sum("dfs").alias("df")), "dfs")

    def weights(self, terms: np.ndarray) -> dict[int, int]:
        """The weight of each of ``terms`` that some document has."""
        asked = self.trees.sparkSession.createDataFrame([(int(t),) for t in terms.tolist()], "term long")
        found = self.dfs.join(asked, "term", "left_semi").collect()  # no more than a block's terms
        return {r["term"]: math.floor(1000 * math.log((2 * self.n + 2) / (2 * r["df"] + 1))) for r in found}

    def search(self, queries: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
        """``(query, doc_id, score)``, the ``k`` best of each of one block of queries (number, term hashes)."""
        weights = self.weights(np.unique(np.concatenate([h for _, h in queries])))
        ready = [(number, hashes, np.array([weights.get(h, 0) for h in hashes.tolist()], np.int64)) for number, hashes in queries]
        found = self.trees.mapInArrow(_found_rows(ready, k), _FOUND)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        some = found.withColumn("salt", F.spark_partition_id() % SALTS)
        some = some.withColumn("rank", rank("query", "salt")).where(F.col("rank") <= k)
        return some.withColumn("rank", rank("query")).where(F.col("rank") <= k).select("query", "rank", "doc_id", "score")


def _blocks(queries: DataFrame) -> Iterator[list[tuple[object, np.ndarray]]]:
    """``(id, sorted distinct term hashes)`` of ``queries(id, text)`` in blocks of bounded size; those without terms are left out."""
    block, held = [], 0
    for row in queries.toLocalIterator():
        hashes = np.unique(hashed_terms(pa.array([row[1]], pa.string()))[0])
        if block and (len(block) == BLOCK_QUERIES or held + len(hashes) > BLOCK_TERMS):
            yield block
            block, held = [], 0
        if len(hashes):
            block.append((row[0], hashes))
            held += len(hashes)
    if block:
        yield block


def search(docs: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best rows of ``docs(doc_id, text)`` for each of ``queries(item_id, text)``.

    Only scores above 0 count; equal ones are ranked by doc_id, null ids last. Each row of
    ``queries`` is an item, also if its item_id is null or repeats; one whose text is
    null or has no terms, or whose terms no document has, gives no rows. Rows that share a
    doc_id are documents of their own. A null or empty text has no terms and counts for
    nothing. Texts may be of any length. An empty table on either side gives no rows;
    other columns are not read.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "lexical-search")
    asked = work.write(queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")), "queries")
    terms: np.ndarray | None = np.zeros(0, np.int64)
    for block in _blocks(asked):
        terms = np.union1d(terms, np.concatenate([h for _, h in block]))
        if len(terms) > MOST_TERMS:
            terms = None
            break
    index = Index(docs, work, terms)
    out, number = None, 0
    for n, block in enumerate(_blocks(asked)):
        ids = [(number + i, item) for i, (item, _) in enumerate(block)]
        found = index.search([(number + i, hashes) for i, (_, hashes) in enumerate(block)], k)
        names = spark.createDataFrame(ids, "query int, item_id long")
        rows = work.write(found.join(names, "query").select("item_id", "rank", "doc_id", "score"), f"found-{n}")
        out, number = rows if out is None else out.unionByName(rows), number + len(block)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


#: ``search`` with its defaults, for DuckDB: all scores of all documents.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), s AS (
  SELECT count(*)::BIGINT AS n, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), p AS (
  SELECT doc_id, size, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(terms)::BIGINT AS size, unnest(terms) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s
), r AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * size * n) // total))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM r WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""
