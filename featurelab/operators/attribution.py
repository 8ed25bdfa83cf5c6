"""Sampled and exact Shapley attributions in Arrow batches (K5, K6).

A batch's rows walk their paths together: each step brings one more feature
of every row from the baseline to its own value and scores the whole batch
once, so a row in is a row out and nothing is exploded or shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.session import spread, workers_import

MAX_EXACT = 7  # features of which all orders are walked
ROWS = 2048    # rows that walk together


def path_orders(hashes: np.ndarray, path: int, d: int) -> np.ndarray:
    """Each row's order of ``d`` features on a path: by numbers drawn from the
    row's hash, the path and the feature alone."""
    with np.errstate(over="ignore"):
        step = np.uint64(0x9E3779B97F4A7C15)
        x = hashes.astype(np.uint64)[:, None] + step * (np.uint64(path * d) + np.arange(1, d + 1, dtype=np.uint64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return np.argsort(x ^ (x >> np.uint64(31)), axis=1, kind="stable")


def walk(x: np.ndarray, base: np.ndarray, score: Callable[[np.ndarray], np.ndarray], orders: Iterator[np.ndarray]) -> np.ndarray:
    """Mean gain of each feature of each row over the orders."""
    total, n = np.zeros_like(x), 0
    at = np.arange(len(x))
    for order in orders:
        point = np.tile(base, (len(x), 1))
        before = score(point)
        for j in order.T:
            point[at, j] = x[at, j]
            after = score(point)
            total[at, j] += after - before
            before = after
        n += 1
    return total / max(1, n)


def shapley(df: DataFrame, key: str | Sequence[str], features: Sequence[str], score: Callable[[np.ndarray], np.ndarray],
            baseline: Mapping[str, float], paths: int | None = 25, seed: int = 42, prefix: str = "attr_") -> DataFrame:
    """The rows with an attribution per feature, baseline_score and
    instance_score; ``score`` takes a matrix of rows and gives their scores.

    ``paths`` orders are drawn for each row from the hash of its key; ``None``
    walks all orders of up to seven features, which is exact.  A row's
    attributions add up to its score less the baseline's.  A null feature is
    NaN to the scorer.  Rows may share a key.
    """
    d = len(features)
    if paths is None and d > MAX_EXACT:
        raise ValueError(f"all orders of over {MAX_EXACT} features")
    keys = [key] if isinstance(key, str) else list(key)
    base = np.array([float(baseline[c]) for c in features])
    workers_import(df.sparkSession)
    added = [prefix + c for c in features] + ["baseline_score", "instance_score"]
    kept = [c for c in df.columns if c not in added]
    src = spread(df.select(*[F.col(f"`{c}`") for c in kept], F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("_x"),
                           F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit(seed)).alias("_h")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, ROWS):
                b = whole.slice(s, ROWS)
                x = b.column("_x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
                h = b.column("_h").to_numpy(zero_copy_only=False)
                if paths is None:
                    orders = (np.tile(p, (len(x), 1)) for p in permutations(range(d)))
                else:
                    orders = (path_orders(h, p, d) for p in range(paths))
                gains = walk(x, base, score, orders)
                cols = [b.column(c) for c in kept] + [pa.array(gains[:, j]) for j in range(d)]
                cols += [pa.array(np.full(len(x), float(score(base[None])[0]))), pa.array(np.asarray(score(x), dtype=float))]
                yield pa.RecordBatch.from_arrays(cols, kept + added)

    names = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name in kept]
                      + [f"`{c}` double" for c in added])
    return src.mapInArrow(run, names)


def linear(weights: Sequence[float], intercept: float = 0.0) -> Callable[[np.ndarray], np.ndarray]:
    """Scorer of a linear model."""
    w = np.array(weights, dtype=float)
    return lambda x: x @ w + intercept
