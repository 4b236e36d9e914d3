"""Paired bootstrap of metrics that come from additive counts.

A replicate weighs each row by a Poisson number of mean 1, inverted at a hash of the row's
key and the replicate's number, so the weights are the same wherever they are computed.
A task keeps one sum for each replicate and count and adds rows to them in groups, so what
is shuffled is one row a replicate and task, however many rows there are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPLICATES = 2000
#: Rows whose weights are held at once, 8 bytes a replicate each.
ROWS = 512
_P1, _P2, _P3, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def _chances() -> np.ndarray:
    """The Poisson distribution of mean 1, summed up, as far as a double tells it from 1."""
    out, chance, total = [], math.exp(-1), 0.0
    while total + chance > total:
        total += chance
        out.append(total)
        chance /= len(out)
    return np.array(out)


def weights(seeds: np.ndarray, replicates: int) -> np.ndarray:
    """Weights of rows by replicates: ``seeds`` are xxhash64 of the keys, which the replicate's number is hashed on to."""
    r = np.arange(1, replicates + 1, dtype=np.uint64)
    h = (seeds.view(np.uint64)[:, None] + _P5 + np.uint64(4)) ^ (r * _P1)
    h = (h << np.uint64(23) | h >> np.uint64(41)) * _P2 + _P3
    h = (h ^ h >> np.uint64(33)) * _P2
    h = (h ^ h >> np.uint64(29)) * _P3
    u = ((h ^ h >> np.uint64(32)) >> np.uint64(11)).astype(float) * 2.0**-53
    return np.searchsorted(_chances(), u, "right").astype(float)


def _sum_rows(replicates: int, n: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((replicates, n))
        for batch in batches:
            seeds, counts = batch.column(0).to_numpy(), np.stack([batch.column(k + 1).to_numpy() for k in range(n)], axis=1)
            for a in range(0, len(seeds), ROWS):
                sums += weights(seeds[a : a + ROWS], replicates).T @ counts[a : a + ROWS]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, replicates + 1, dtype=np.int32)), *[pa.array(sums[:, k]) for k in range(n)]], ["r", *[f"c{k}" for k in range(n)]])

    return rows


def replicate_sums(df: DataFrame, key: str, counts: dict[str, Column], replicates: int = REPLICATES) -> DataFrame:
    """``r`` and the weighted sum of each of ``counts`` in that replicate; a null count adds nothing."""
    own = [F.coalesce(c.cast("double"), F.lit(0.0)).alias(f"c{k}") for k, c in enumerate(counts.values())]
    part = df.select(F.xxhash64(key).alias("seed"), *own).mapInArrow(_sum_rows(replicates, len(own)), ", ".join(["r int", *[f"c{k} double" for k in range(len(own))]]))
    return part.groupBy("r").agg(*[F.sum(f"c{k}").alias(name) for k, name in enumerate(counts)])


def micro_f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.when(tp > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0)


def kappa(cells: dict[tuple[str, str], Column]) -> Column:
    """Cohen's kappa from the counts of (one label, other label): 0 without rows, 1 if chance agrees fully."""
    labels = sorted({x for pair in cells for x in pair})
    add = lambda pairs: sum((cells[p] for p in pairs if p in cells), F.lit(0.0))
    n = add(cells)
    agree = add([(x, x) for x in labels]) / n
    chance = sum((add([(x, y) for y in labels]) * add([(y, x) for y in labels]) for x in labels), F.lit(0.0)) / (n * n)
    return F.when(n == 0, 0.0).when(chance >= 1, 1.0).otherwise((agree - chance) / (1 - chance))


def paired_intervals(df: DataFrame, key: str, counts: dict[str, Column], metrics: dict[str, tuple[Column, Column]], replicates: int = REPLICATES, digits: int = 4) -> DataFrame:
    """``(metric, point, low, high)``: the difference of each metric's second from its first, and its 95% interval.

    ``metrics`` gives both sides as expressions over the sums of ``counts``. low and high are
    the values at 2.5 % and 97.5 % of the sorted replicates. Without rows all three are 0.
    """
    differ: Callable = lambda sides: sides[1] - sides[0]
    whole = df.agg(*[F.coalesce(F.sum(c.cast("double")), F.lit(0.0)).alias(name) for name, c in counts.items()])
    points = whole.select(*[differ(v).alias(name) for name, v in metrics.items()])
    ordered = replicate_sums(df, key, counts, replicates).agg(*[F.sort_array(F.collect_list(differ(v))).alias(name) for name, v in metrics.items()])
    low, high = int(0.025 * replicates), int(0.975 * replicates) - 1
    long = lambda rows, value: rows.select(F.explode(F.array(*[F.struct(F.lit(name).alias("metric"), value(name)) for name in metrics])).alias("x")).select("x.*")
    sides = long(ordered, lambda name: F.struct(F.get(name, F.lit(low)).alias("low"), F.get(name, F.lit(high)).alias("high")).alias("side"))
    told = long(points, lambda name: F.col(name).alias("point")).join(sides, "metric")
    return told.select("metric", *[F.round(F.coalesce(c, F.lit(0.0)), digits).alias(n) for n, c in (("point", F.col("point")), ("low", F.col("side.low")), ("high", F.col("side.high")))])
