"""N-gram Jaccard join with rare-first prefixes, and the classes that its links make.

Documents are sets of word shingles; two link when their Jaccard similarity is at least
``threshold`` percent. The steps:

1. Every text is read once for the size and a 128-bit signature of its set. Documents of
   one signature are one class from here on, so copies are never paired.
2. Every text is read again; its shingles are dealt out in packed blocks by hash range. A
   block range counts in how many classes each shingle is, and sends on only shingles of
   two classes or more, with that count: no other shingle can be in a link. No task gets all
   classes of a shingle that very many have, nor all copies of one class: such shingles are
   dealt by class too, and of such a class one row is dealt. Both lists are made before,
   from step 1, by counts over the whole table, and have a bound of their own.
3. A class knows its size and its shared shingles. Ordered rarest first, its unshared
   shingles come before the shared ones, so a class with as many unshared shingles as its
   prefix is long is done. The rest (texts with near copies) are the table ``sets``.
4. Prefix shingles are joined, with the length, positional and sketch filters in the join's
   condition. Pairs are made distinct, pass a suffix filter and are verified once. The
   sketch has the parity of how many shared shingles fall on each of its bits; two sets
   differ in at least as many shingles as their sketches differ in bits, so it prunes
   without loss before a pair is made.
5. A long list of classes under one prefix shingle is not paired with itself. First, classes
   that agree in the least of their shared shingles under a hash are held against one
   central class of them, ``STARS`` times with other hashes: as many pairs as classes.
   Those links merge classes into components. Then all pairs of step 4 that are still in
   different components, and only these, are verified. So components are exact, and a
   large group of near copies takes few pairs more than it has members.

Shingles are told apart by 64-bit hashes, and by 57 bits of them where two sets are
compared, so a result is exact but for collisions of these.

Order of shingles: the number of classes as a power of two, then the hash. Both are in
one 64-bit token, so tokens sort rarest first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.graph import components
from corpuslens.llm.rows import stay
from corpuslens.llm.shingles import WIDTH, mix, shingle_sets, signatures, slices
from corpuslens.llm.store import Workspace

THRESHOLD = 75
#: Shingles in one block range, and the least number of ranges.
RANGE_SHINGLES, LEAST_RANGES = 3_000_000, 64
#: A shingle of this share of a block range in classes is hot; the most of them, and the
#: classes that count for one in the classes counted (a fixed share of them, by signature).
HOT_SHARE, HOT_MOST, HOT_COUNTED = 1 / 8, 1 << 22, 1024
#: Rows of which a class is dealt by one only, and the most such classes.
HEAVY_LEAST, HEAVY_MOST = 256, 1 << 18
#: Hashes under which classes are first held against a central one.
STARS = 4
#: 64-bit words of the parity sketch of a class's shared shingles.
SKETCH = 16
_BITS = [f"b{k}" for k in range(SKETCH)]
_SETS = "sig binary, n int, single int, tokens array<long>, " + ", ".join(f"{b} long" for b in _BITS)

_RUNS = "part int, sigs binary, sizes binary, counts binary, tokens binary"


def _sig_strings(sigs: np.ndarray) -> list[bytes]:
    raw = sigs.astype("<u8").tobytes()
    return [raw[k : k + 16] for k in range(0, len(raw), 16)]


def _of_classes(ends: np.ndarray, hashes: np.ndarray, sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Owner and hash of the shingles of the first text of each class, and the number of classes."""
    sizes = np.diff(ends, prepend=0)
    _, first = np.unique(_classes(sigs), return_index=True)
    once = np.zeros(len(sizes), bool)
    once[first] = True
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner[once[owner]], hashes[once[owner]], len(first)


def _set_rows(width: int, every: int):
    """Size and signature of each text's set; one class in ``every``, by signature, with its shingles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                ends, hashes = shingle_sets(part.column(1), width)
                sizes, sigs = np.diff(ends, prepend=0), signatures(ends, hashes)
                owner, own, _ = _of_classes(ends, hashes, sigs)  # copies within the part count once
                told = sigs[owner, 1] % np.uint64(every) == 0
                counts = np.bincount(owner[told], minlength=len(sizes))
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32), mask=np.append(counts == 0, False))
                counted = pa.ListArray.from_arrays(offsets, pa.array(own[told].view(np.int64)))
                found = [pa.array(sizes), pa.array(_sig_strings(sigs), pa.binary()), counted]
                yield pa.RecordBatch.from_arrays([part.column(0), *found, part.column(2)], ["doc_id", "n_shingles", "sig", "counted", "digest"])

    return rows


def counted_share(range_shingles: int) -> int:
    """One class in so many is counted to find hot shingles: a hot one has ``HOT_COUNTED`` of these."""
    return max(1, int(HOT_SHARE * range_shingles) // HOT_COUNTED)


def hot_shingles(classes: DataFrame, total: int, range_shingles: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that very many classes have, sorted, and an estimate of how many.

    A shingle is hot from ``HOT_SHARE`` of a block range, or of ``2 / HOT_MOST`` of all
    ``total`` shingles if that is more. It is looked for by a count over the whole table of
    one class in ``every``, chosen by signature, each class once; half of the number that is
    expected there is enough, so a hot one is missed with a probability of about 1e-55. About
    ``HOT_MOST`` shingles can be this frequent, 16 bytes each, whatever ``total`` is.
    Results don't depend on what is found: only how shingles are dealt out does.
    """
    every = counted_share(range_shingles)
    least = max(HOT_SHARE * range_shingles, 2 * total / HOT_MOST) / 2 / every
    once = classes.where("counted is not null").select("sig", F.explode("counted").alias("hash")).distinct()
    found = once.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") >= max(2, least)).toArrow()
    hashes, n = found.column("hash").to_numpy().astype(np.int64).view(np.uint64), found.column("n").to_numpy() * every
    order = np.argsort(hashes)
    return hashes[order], n[order]


def heavy_classes(classes: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures (sorted by their first word) of classes of very many rows, and the least doc_id of each.

    Very many is ``HEAVY_LEAST``, or ``1 / HEAVY_MOST`` of all ``total`` rows if that is
    more, so there are at most ``HEAVY_MOST`` of them, 24 bytes each. A class without any
    doc_id is none.
    """
    rows = classes.where("n_shingles > 0").groupBy("sig").agg(F.count("*").alias("m"), F.min("doc_id").alias("least"))
    found = rows.where(F.col("m") >= max(HEAVY_LEAST, total / HEAVY_MOST)).where("least is not null").select("sig", "least").toArrow()
    sigs = np.frombuffer(b"".join(found.column("sig").to_pylist()), "<u8").reshape(-1, 2)
    _, first = np.unique(sigs[:, 0], return_index=True)
    return sigs[first], found.column("least").to_numpy()[first]


def _place(hashes: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Where each hash is in ``hot``, or -1."""
    if not len(hot):
        return np.full(len(hashes), -1, np.int64)
    at = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
    return np.where(hot[at] == hashes, at, -1)


def _packed(keys: np.ndarray, sigs: np.ndarray, sizes: np.ndarray, owner: np.ndarray, tokens: np.ndarray) -> Iterator[tuple]:
    """Rows of ``_RUNS``: for each key, the runs of tokens of one owner.

    ``owner`` (a row of ``sigs`` and ``sizes``) is not falling within a key.
    """
    order = np.argsort(keys, kind="stable")
    keys, owner, tokens = keys[order], owner[order], tokens[order]
    cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True]))) if len(keys) else np.zeros(1, int)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = owner[a:b]
        runs = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        who = own[runs]
        counts = np.diff(np.append(runs, b - a)).astype("<i4")
        yield int(keys[a]), sigs[who].astype("<u8").tobytes(), sizes[who].astype("<i4").tobytes(), counts.tobytes(), tokens[a:b].astype("<u8").tobytes()


def _run_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "sigs", "sizes", "counts", "tokens"])


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    whole = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    sigs, sizes, counts, tokens = whole("sigs", "<u8").reshape(-1, 2), whole("sizes", "<i4"), whole("counts", "<i4"), whole("tokens", "<u8")
    return sigs, sizes, np.repeat(np.arange(len(counts)), counts), tokens


def _classes(sigs: np.ndarray) -> np.ndarray:
    """A small number for each distinct row of ``sigs``."""
    order = np.lexsort((sigs[:, 1], sigs[:, 0]))
    new = np.any(sigs[order][1:] != sigs[order][:-1], axis=1)
    out = np.empty(len(sigs), np.int64)
    out[order] = np.concatenate(([0], np.cumsum(new))) if len(sigs) else 0
    return out


def _dealt_rows(width: int, ranges: int, hot: np.ndarray, heavy: np.ndarray, least: np.ndarray):
    """Shingles by hash range; those of ``hot`` by class and hash, in as many further parts.

    Of a class in ``heavy`` only rows with its doc_id in ``least`` are dealt.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                ends, hashes = shingle_sets(part.column(1), width)
                sigs, sizes = signatures(ends, hashes), np.diff(ends, prepend=0)
                if len(heavy):
                    at = _place(sigs[:, 0], heavy[:, 0])
                    ids = part.column(0)
                    named = ids.is_valid().to_numpy(zero_copy_only=False) & (ids.fill_null(0).to_numpy() == least[at])
                    stays = (at < 0) | (sigs[:, 1] != heavy[at, 1]) | named
                    hashes, sizes = hashes[np.repeat(stays, sizes)], np.where(stays, sizes, 0)
                    ends = np.cumsum(sizes)
                    sigs, sizes, ends = sigs[stays], sizes[stays], ends[stays]
                owner, hashes, _ = _of_classes(ends, hashes, sigs)  # copies within the part count once
                is_hot = _place(hashes, hot) >= 0
                spread = np.where(is_hot, mix(hashes ^ sigs[owner, 0]), hashes)
                keys = ((spread >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
                keys[is_hot] += ranges
                if packed := list(_packed(keys, sigs, sizes, owner, hashes)):
                    yield _run_batch(packed)

    return rows


def _shared_rows(parts: int, hot: np.ndarray, hot_counts: np.ndarray):
    """Of one hash range: shingles of two classes or more, as tokens, dealt out by class.

    A part of hot shingles has some of their classes only and takes their known counts.
    """

    def rows(table: pa.Table) -> pa.Table:
        sigs, sizes, owner, hashes = _unpacked(table)
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        same = ordered[1:] == ordered[:-1]
        known = bool(len(hashes)) and bool(_place(hashes[:1], hot)[0] >= 0)  # then all of the part are
        if len(order) and not known:
            order = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
        hashes, who = hashes[order], _classes(sigs)[owner[order]]
        order = order[(by := np.lexsort((who, hashes)))]
        hashes, who = hashes[by], who[by]
        if len(hashes):
            new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (who[1:] != who[:-1])))
            hashes, order = hashes[new], order[new]
        _, at, df = np.unique(hashes, return_inverse=True, return_counts=True)
        df = hot_counts[_place(hashes, hot)] if known else df[at]
        hashes, order, df = hashes[df > 1], order[df > 1], df[df > 1]
        tokens = (np.floor(np.log2(df)).astype(np.uint64) << np.uint64(57)) | (hashes >> np.uint64(7))
        own = owner[order]
        by = np.argsort(own, kind="stable")
        own, tokens = own[by], tokens[by]
        keys = (sigs[own, 0] % np.uint64(parts)).astype(np.int32) if len(own) else np.zeros(0, np.int32)
        packed = list(_packed(keys, sigs, sizes, own, tokens))
        empty = pa.RecordBatch.from_arrays([pa.array([], pa.int32()), *[pa.array([], pa.binary())] * 4], ["part", "sigs", "sizes", "counts", "tokens"])
        return pa.Table.from_batches([_run_batch(packed) if packed else empty])

    return rows


def overlap_needed(n: int, m: int, threshold: int) -> int:
    """The least intersection of sets of ``n`` and ``m`` that makes a link."""
    return -(-threshold * (n + m) // (100 + threshold))


def _candidate_rows(threshold: int):
    """Of one part of the classes: those whose shared shingles reach into their prefix."""

    def rows(table: pa.Table) -> pa.Table:
        sigs, sizes, owner, tokens = _unpacked(table)
        classes = _classes(sigs)
        who = classes[owner]
        by = np.lexsort((tokens, who))
        who, tokens, owner = who[by], tokens[by], owner[by]
        at = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1]))) if len(who) else np.zeros(0, int)
        out: dict[str, list] = {"sig": [], "n": [], "single": [], "tokens": []}
        sketches = []
        for a, b in zip(at.tolist(), [*at[1:].tolist(), len(who)], strict=True):
            n = int(sizes[owner[a]])
            single = n - (b - a)
            if single < n + threshold * n // -100 + 1:
                out["sig"].append(sigs[owner[a]].astype("<u8").tobytes())
                out["n"].append(n)
                out["single"].append(single)
                out["tokens"].append(tokens[a:b].astype(np.int64))
                sketches.append(parity_sketch(tokens[a:b]))
        words = np.array(sketches, np.int64).reshape(-1, SKETCH)
        columns = [pa.array(out["sig"], pa.binary()), pa.array(out["n"], pa.int32()), pa.array(out["single"], pa.int32()), pa.array(out["tokens"], pa.list_(pa.int64()))]
        return pa.table([*columns, *(pa.array(words[:, k]) for k in range(SKETCH))], names=[*out, *_BITS])

    return rows


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """``SKETCH`` words in which a bit is set if an odd number of tokens fall on it."""
    odd = np.bincount((tokens % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def apart(x: np.ndarray, y: np.ndarray, most: int, depth: int = 3) -> int:
    """A lower bound of how many tokens are in one of two sorted arrays only.

    The suffix filter: both are split at the middle token of ``y``; what can't be matched
    on each side is bounded by the difference of the sizes there, and further by splitting
    again, as long as the bound is not above ``most``.
    """
    if depth == 0 or not len(x) or not len(y):
        return abs(len(x) - len(y))
    mid = len(y) // 2
    pivot = y[mid]
    at = int(np.searchsorted(x, pivot))
    hit = at < len(x) and x[at] == pivot
    xl, xr, yl, yr = x[:at], x[at + hit :], y[:mid], y[mid + 1 :]
    left, right = abs(len(xl) - len(yl)), abs(len(xr) - len(yr))
    if left + right + (not hit) > most:
        return left + right + (not hit)
    left = apart(xl, yl, most - right - (not hit), depth - 1)
    if left + right + (not hit) > most:
        return left + right + (not hit)
    return left + apart(xr, yr, most - left - (not hit), depth - 1) + (not hit)


def _verified_rows(threshold: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            xs, ys = batch.column(4), batch.column(5)
            for k, (n, m) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                x, y = xs[k].values.to_numpy(), ys[k].values.to_numpy()
                need = overlap_needed(n, m, threshold)
                most = len(x) + len(y) - 2 * need
                if most < 0 or apart(x, y, most) > most:
                    continue
                if len(np.intersect1d(x, y, assume_unique=True)) >= need:
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), batch.column(1).take(pa.array(keep, pa.int64()))], ["a", "b"])

    return rows


def _could_link(a: str, b: str, threshold: int) -> Column:
    """Length, positional and sketch filters for postings ``a`` and ``b`` of one token."""
    need = f"ceil({threshold} * ({a}.n + {b}.n) / {100 + threshold})"
    differ = " + ".join(f"bit_count({a}.{w} ^ {b}.{w})" for w in _BITS)
    return F.expr(
        f"100 * least({a}.n, {b}.n) >= {threshold} * greatest({a}.n, {b}.n) and "
        f"least({a}.pos, {b}.pos) + 1 + least({a}.n - {a}.pos - 1, {b}.n - {b}.pos - 1) >= {need} and "
        f"{a}.single + {b}.single + {differ} <= {a}.n + {b}.n - 2 * {need}"
    )


class _Linker:
    """Verifies distinct candidate pairs, each once, and gathers the links."""

    def __init__(self, sets: DataFrame, work: Workspace, threshold: int):
        self.sets, self.work, self.threshold, self.seen, self.links, self.k = sets, work, threshold, None, None, 0

    def add(self, pairs: DataFrame) -> None:
        """``pairs(a, b)`` of signatures with ``a < b``."""
        self.k += 1
        pairs = pairs.distinct()
        if self.seen is not None:
            pairs = pairs.join(self.seen, ["a", "b"], "left_anti")
        pairs = self.work.write(pairs, f"pairs-{self.k}")
        side = lambda k: self.sets.select(F.col("sig").alias(k), F.col("n").alias(f"n{k}"), F.col("tokens").alias(f"t{k}"))
        full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ta", "tb")
        links = self.work.write(full.mapInArrow(_verified_rows(self.threshold), "a binary, b binary"), f"links-{self.k}")
        self.seen = pairs if self.seen is None else self.seen.unionByName(pairs)
        self.links = links if self.links is None else self.links.unionByName(links)


def shingle_classes(docs: DataFrame, work: Workspace, width: int = WIDTH, digest: Column | None = None, range_shingles: int = RANGE_SHINGLES) -> DataFrame:
    """``(doc_id, n_shingles, sig, digest)`` of every row; the signature of an empty set is 0."""
    digest = F.lit(None) if digest is None else digest
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), digest.cast("binary").alias("digest"))
    kinds = "doc_id long, n_shingles long, sig binary, counted array<long>, digest binary"
    return work.write(text.mapInArrow(_set_rows(width, counted_share(range_shingles)), kinds), "classes")


def dealt_shingles(docs: DataFrame, classes: DataFrame, width: int = WIDTH, range_shingles: int = RANGE_SHINGLES) -> tuple[DataFrame, int, np.ndarray, np.ndarray]:
    """Packed shingles by part (hash ranges, then as many parts of hot ones), the ranges, and the hot shingles."""
    rows_, total = classes.agg(F.count("*"), F.sum("n_shingles")).first()
    total = total or 0
    hot, hot_counts = hot_shingles(classes, total, range_shingles)
    ranges = max(LEAST_RANGES, -(-total // range_shingles))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(_dealt_rows(width, ranges, hot, *heavy_classes(classes, rows_)), _RUNS), ranges, hot, hot_counts


def class_links(docs: DataFrame, classes: DataFrame, work: Workspace, threshold: int = THRESHOLD, width: int = WIDTH, range_shingles: int = RANGE_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """``(links, sets)``: links ``(a, b)`` between signatures whose closure is exact."""
    dealt, ranges, hot, hot_counts = dealt_shingles(docs, classes, width, range_shingles)
    shared = dealt.groupBy("part").applyInArrow(_shared_rows(ranges, hot, hot_counts), _RUNS)
    sets = shared.groupBy("part").applyInArrow(_candidate_rows(threshold), _SETS)
    sets = work.write(sets, "sets")
    linker = _Linker(sets, work, threshold)
    keys = F.expr(f"transform(sequence(1, {STARS}), r -> array_min(transform(tokens, t -> xxhash64(t, r))))")
    lone = F.struct((F.col("single") / F.col("n")).alias("lone"), "sig", "n")
    stars = work.write(sets.select("sig", "n", "single", F.posexplode(keys).alias("r", "key")), "stars")
    hubs = stars.groupBy("r", "key").agg(F.min(lone).alias("hub"), F.count("*").alias("m")).where("m > 1").select("r", "key", "hub.sig", "hub.n")
    hubs = work.write(hubs, "hubs")
    near = stars.alias("x").join(hubs.alias("y"), (F.col("x.key") == F.col("y.key")) & F.expr(f"x.r = y.r and x.sig <> y.sig and 100 * least(x.n, y.n) >= {threshold} * greatest(x.n, y.n)"))
    pair = [F.least("x.sig", "y.sig").alias("a"), F.greatest("x.sig", "y.sig").alias("b")]
    linker.add(near.select(*pair))
    joined = components(linker.links, work, "components-stars").withColumnRenamed("node", "sig")
    prefix = F.expr(f"slice(tokens, 1, greatest(0, int(n - ceil({threshold} * n / 100) + 1 - single)))")
    placed = sets.join(joined, "sig", "left").select("sig", "n", "single", F.coalesce("root", "sig").alias("comp"), F.posexplode(prefix).alias("at", "tok"))
    postings = work.write(placed.select("tok", "sig", "n", "single", (F.col("at") + F.col("single")).alias("pos"), "comp"), "postings")
    counts = postings.groupBy("tok", "comp").agg(F.count("*").alias("c"))
    mixed = counts.groupBy("tok").agg(F.max(F.struct("c", "comp")).alias("top"), F.count("*").alias("comps")).where("comps > 1")
    mixed = work.write(mixed.select("tok", F.col("top.comp").alias("main")), "mixed")
    rest = work.write(postings.join(mixed, "tok").join(sets.select("sig", *_BITS), "sig"), "mixed-postings")
    minor = rest.where("comp <> main").alias("x")
    both = minor.join(rest.alias("y"), (F.col("x.tok") == F.col("y.tok")) & F.expr("x.comp <> y.comp and (y.comp = y.main or x.sig < y.sig)") & _could_link("x", "y", threshold))
    linker.add(both.select(*pair))
    return linker.links, sets


def _rooted(least: DataFrame, links: DataFrame, work: Workspace) -> DataFrame:
    """``least(sig, least)`` with ``root``, the component of each class."""
    roots = components(links, work, "components-final").withColumnRenamed("node", "sig")
    return work.write(least.join(roots, "sig", "left").select("sig", "least", F.coalesce("root", "sig").alias("root")), "rooted")


def ngram_components(docs: DataFrame, threshold: int = THRESHOLD, width: int = WIDTH, range_shingles: int = RANGE_SHINGLES) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs(doc_id, text)``.

    component_id is the smallest doc_id that links reach from the row, itself included.
    A text without words (null and empty ones too) has no shingles and its own doc_id as
    component. Rows with equal sets link, so repeated rows share a component. A null
    doc_id takes part in links but never names a component; if no row of its component
    has a doc_id, or it has no words, its component_id is null. An empty table gives no
    rows. Other columns are not read.
    """
    work = Workspace(docs.sparkSession, "ngram-join")
    classes = shingle_classes(docs, work, width, range_shingles=range_shingles)
    links, _ = class_links(docs, classes, work, threshold, width, range_shingles)
    rooted = _rooted(classes.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("least")), links, work)
    ids = work.write(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root-ids")
    ids = work.write(rooted.join(ids, "root").select("sig", "component_id"), "component-ids")
    some = classes.where("n_shingles > 0").join(ids, "sig").select("doc_id", "n_shingles", "component_id")
    return some.unionByName(classes.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def drop_near_copies(docs: DataFrame, threshold: int = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """``docs`` with one row of each component and all columns.

    The row with the least doc_id stays; a null one comes after all others, and rows that
    share a doc_id are told apart by a digest of their texts. Of rows with the same
    doc_id and text one stays. Rows without words (null and empty texts too) are linked
    with nothing and all stay. An empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "ngram-join-stage")
    key = {"doc_id": F.col("doc_id").cast("long"), "digest": F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))}
    classes = shingle_classes(docs, work, width, key["digest"])
    links, _ = class_links(docs, classes, work, threshold, width)
    rows = classes.where("n_shingles > 0").groupBy("sig", "doc_id", "digest").agg(F.count("*").alias("repeats"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest", "repeats")).alias("least")
    rooted = _rooted(rows.groupBy("sig").agg(first), links, work)
    keepers = rooted.groupBy("root").agg(F.min("least").alias("least")).select("least.doc_id", "least.digest", "least.repeats")
    wordless = classes.where("n_shingles = 0").select("doc_id", "digest", F.lit(1).cast("long").alias("repeats"))  # so that none is dropped as a repeat
    return stay(docs, work.write(keepers.unionByName(wordless), "keepers"), key)
