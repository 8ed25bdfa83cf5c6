"""Least squares and k-fold validation from Gram matrices.

One aggregate gives, per fold, the sums of all products of features and target:
a few numbers whatever the rows.  A fold's training sums are the total less its
own, so ten fits and their test errors take one pass over the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Fold:
    fold: int
    n_train: int
    n_test: int
    coefficients: list[float]  # the intercept first
    rmse: float                # on the fold's own rows
    r2_train: float


def gram(df: DataFrame, features: Sequence[str], label: str, fold: str | None = None) -> dict[int, np.ndarray]:
    """fold: symmetric matrix of the sums of products of (1, features, label).
    Rows with a null or non-finite value among them are left out."""
    cols = [F.lit(1.0), *[F.col(c).cast("double") for c in (*features, label)]]
    used = df
    for c in cols[1:]:
        used = used.where(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    m = len(cols)
    sums = [F.sum(cols[i] * cols[j]).alias(f"s{i}_{j}") for i in range(m) for j in range(i, m)]
    out = {}
    for r in used.groupBy((F.col(fold) if fold else F.lit(0)).alias("_f")).agg(*sums).collect():
        a = np.zeros((m, m))
        for i in range(m):
            for j in range(i, m):
                a[i, j] = a[j, i] = r[f"s{i}_{j}"]
        out[r["_f"]] = a
    return out


def solve(a: np.ndarray) -> np.ndarray:
    """Intercept and coefficients of the least-squares fit of the last column."""
    x, y = a[:-1, :-1], a[:-1, -1]
    scale = np.sqrt(np.maximum(np.diag(x), 1e-300))
    return np.linalg.lstsq(x / np.outer(scale, scale), y / scale, rcond=1e-12)[0] / scale


def squared_error(a: np.ndarray, beta: np.ndarray) -> float:
    """Sum of squared residuals of ``beta`` on the rows that gave ``a``."""
    b = np.append(beta, -1.0)
    return max(0.0, float(b @ a @ b))


def fit_linear(df: DataFrame, features: Sequence[str], label: str) -> np.ndarray:
    """Intercept and coefficients, in the order of ``features``."""
    return solve(gram(df, features, label)[0])


def cross_validate(df: DataFrame, features: Sequence[str], label: str, fold: str) -> list[Fold]:
    """A fit per value of ``fold`` (an integer column) on the other folds' rows,
    judged on its own, from one pass over the data."""
    per = gram(df, features, label, fold)
    total = sum(per.values())
    out = []
    for f in sorted(per):
        train = total - per[f]
        beta = solve(train)
        n, m = train[0, 0], per[f][0, 0]
        spread = train[-1, -1] - train[0, -1] ** 2 / n
        out.append(Fold(int(f), int(n), int(m), beta.tolist(), float(np.sqrt(squared_error(per[f], beta) / m)),
                        float(1.0 - squared_error(train, beta) / spread)))
    return out
