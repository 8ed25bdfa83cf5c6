"""Quality classifier: a generalised additive model with pairwise
interactions (operator 7).

The log-odds of "good" are a sum of one lookup table per text feature and one
two-way table per chosen pair of features.  Tables are learned by cyclic
boosting: round by round, each feature in turn gets the shallow tree (three
leaves) that best fits the current gradient, added into its table with a small
step; then the pairs that explain most of what is left get two-way trees (one
cut on each axis) in the same way.  A score is a few bin look-ups and sums,
done for a batch at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelab.llm.common import shared_table, small_side, text_rows

MAX_TRAIN_ROWS = 20_000  # the documented bound of the training sample
BINS, PAIR_BINS = 32, 8
FEATURES = ("log_words", "word_length", "distinct_words", "top_word", "punctuation", "upper", "digits",
            "wordless", "distinct_lines", "repeated_neighbours", "short_words", "sentence_ends",
            "decorated_words", "line_length", "distinct_pairs", "non_ascii", "character_entropy",
            "long_words")
# byte classes: 0 other ASCII control, 1 lower, 2 upper, 3 digit, 4 space, 5 punctuation, 6 beyond ASCII
CLASS = np.zeros(256, dtype=np.uint8)
CLASS[[*range(97, 123)]] = 1
CLASS[[*range(65, 91)]] = 2
CLASS[[*range(48, 58)]] = 3
CLASS[[9, 10, 11, 12, 13, 32]] = 4
CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 5
CLASS[128:] = 6


def text_features(text: str | None) -> list[float]:
    """The features of one whole text; zeros for a null or blank one."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    hist = np.bincount(raw, minlength=256)
    by_class = np.bincount(CLASS, weights=hist, minlength=7)
    n, size = len(words), len(raw)
    seen = Counter(words)
    p = hist[hist > 0] / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    letters = max(1.0, by_class[1] + by_class[2] + by_class[6])
    lines = [x for x in text.split("\n") if x.strip()]
    wordless = sum(c for w, c in seen.items() if not any(map(str.isalnum, w)))
    decorated = sum(c for w, c in seen.items() if len(w) > 2 and not w[-1].isalnum() and not w[-2].isalnum())
    neighbours = sum(map(str.__eq__, words[1:], words[:-1]))
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1)
    return [float(np.log1p(n)), float(lengths.mean()), len(seen) / n, max(seen.values()) / n,
            by_class[5] / size, by_class[2] / letters, by_class[3] / size, wordless / n,
            len(set(lines)) / len(lines), neighbours / n, float((lengths <= 3).mean()),
            text.count(".") / n, decorated / n, float(np.log1p(size / len(lines))), pairs,
            by_class[6] / size, float(-(p * np.log2(p)).sum()), float((lengths > 12).mean())]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def _leaf(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g / (h + ridge)


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def three_leaf_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Value per bin of the best tree with two cuts, from the gradient and
    curvature sums per bin."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    i, j = np.triu_indices(len(g) - 1)
    parts = [(cg[i], ch[i]), (cg[j] - cg[i], ch[j] - ch[i]), (cg[-1] - cg[j], ch[-1] - ch[j])]
    best = int(np.argmax(sum(_gain(a, b, ridge) for a, b in parts)))
    values = [float(_leaf(a[best], b[best], ridge)) for a, b in parts]
    out = np.full(len(g), values[2])
    out[: j[best] + 1] = values[1]
    out[: i[best] + 1] = values[0]
    return out


def quadrant_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """(values, gain) of the best tree with one cut on each axis."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def quarters(c: np.ndarray) -> list[np.ndarray]:
        a = c[:-1, :-1]
        b = c[:-1, -1:] - a
        d = c[-1:, :-1] - a
        return [a, b, d, c[-1, -1] - a - b - d]

    gs, hs = quarters(cg), quarters(ch)
    gain = sum(_gain(a, b, ridge) for a, b in zip(gs, hs))
    x, y = np.unravel_index(int(np.argmax(gain)), gain.shape)
    v = [float(_leaf(a[x, y], b[x, y], ridge)) for a, b in zip(gs, hs)]
    out = np.empty(g.shape)
    out[: x + 1, : y + 1], out[: x + 1, y + 1:] = v[0], v[1]
    out[x + 1:, : y + 1], out[x + 1:, y + 1:] = v[2], v[3]
    return out, float(gain[x, y])


@dataclass
class Gam:
    base: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pair_edges: list = field(default_factory=list)
    pairs: list = field(default_factory=list)       # (feature, feature)
    pair_tables: list = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        z = np.full(len(x), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            z += table[np.searchsorted(edges, x[:, f], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            z += table[np.searchsorted(self.pair_edges[a], x[:, a], side="right"),
                       np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return _sigmoid(z)


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def fit_gam(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, n_pairs: int = 8,
            step: float = 0.1, ridge: float = 1.0) -> Gam:
    """Fit on features ``x`` (rows, features) and targets in [0, 1].  Without
    rows the model scores everything 0.5."""
    if not len(x):
        return Gam()
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    m = Gam(base=float(np.log(mean / (1 - mean))))
    nf = x.shape[1]
    m.edges = [_edges(x[:, f], BINS) for f in range(nf)]
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(m.edges)]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    z = np.full(len(x), m.base)
    for _ in range(rounds):
        for f in range(nf):
            size = len(m.tables[f])
            if size < 2:
                continue
            p = _sigmoid(z)
            g = np.bincount(bins[f], weights=y - p, minlength=size)
            h = np.bincount(bins[f], weights=p * (1 - p), minlength=size)
            add = step * three_leaf_tree(g, h, ridge)
            m.tables[f] += add
            z += add[bins[f]]
    m.pair_edges = [_edges(x[:, f], PAIR_BINS) for f in range(nf)]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(m.pair_edges)]

    def pair_sums(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(m.pair_edges[a]) + 1, len(m.pair_edges[b]) + 1)
        cell = coarse[a] * shape[1] + coarse[b]
        p = _sigmoid(z)
        total = shape[0] * shape[1]
        return (cell, np.bincount(cell, weights=y - p, minlength=total).reshape(shape),
                np.bincount(cell, weights=p * (1 - p), minlength=total).reshape(shape))

    gains = []
    for a, b in combinations(range(nf), 2):
        if len(m.pair_edges[a]) and len(m.pair_edges[b]):
            _, g, h = pair_sums(a, b)
            gains.append((-quadrant_tree(g, h, ridge)[1], a, b))
    m.pairs = [(a, b) for _, a, b in sorted(gains)[:n_pairs]]
    m.pair_tables = [np.zeros((len(m.pair_edges[a]) + 1, len(m.pair_edges[b]) + 1)) for a, b in m.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(m.pairs):
            cell, g, h = pair_sums(a, b)
            add = step * quadrant_tree(g, h, ridge)[0]
            m.pair_tables[k] += add
            z += add.ravel()[cell]
    return m


def features(docs: DataFrame, text_col: str = "text", keep: Sequence[Column] = ()) -> DataFrame:
    """(*keep, x array<double>): the features of every whole text."""
    src = text_rows(docs.select(*keep, F.col(text_col).cast("string").alias("_t")))
    kept = [f for f in src.schema.fields if f.name != "_t"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.drop(columns="_t").assign(x=[text_features(t) for t in b["_t"]])

    names = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return src.mapInPandas(run, f"{names}x array<double>")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> Gam:
    """Fit on about ``max_rows`` labelled documents, chosen by the hash of the
    id; only their features reach the driver.  Null labels are left out; a
    document with several labels takes their mean as its target."""
    target = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.avg(F.col(label_col).cast("double")).alias("_y")))
    n = target.count()
    if n > max_rows:
        resolution = 1 << 30
        target = target.where(F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(resolution))
                              < F.lit(resolution * max_rows // n))
    target = small_side(shared_table(target, "quality-sample"), 32)
    chosen = shared_table(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(target, "_id"),
                          "quality-texts")
    rows = features(chosen, "_text", [F.col("_id"), F.col("_y")]).toPandas().sort_values("_id", kind="stable")
    x = np.array(rows["x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return fit_gam(x, rows["_y"].to_numpy(dtype=float))


def score(docs: DataFrame, model: Gam, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.3, keep: Sequence[Column] = ()) -> DataFrame:
    """(id_col, *keep, score, predicted) for every input row, from the whole
    text alone; null and blank texts have features of zero and a score too.
    Repeated rows are kept; an empty table gives an empty result."""
    src = text_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("_t"), *keep))
    kept = [f for f in src.schema.fields if f.name not in ("id", "_t")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.array([text_features(t) for t in b["_t"]], dtype=float).reshape(-1, len(FEATURES))
            s = model.score(x)
            yield b.drop(columns="_t").assign(score=s, predicted=(s >= threshold).astype(np.int32))

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [src.schema["id"], *kept])
    return (src.mapInPandas(run, f"{names}, score double, predicted int")
            .select(F.col("id").alias(id_col), *[f.name for f in kept], "score", "predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """The input rows, all columns, whose text scores ``threshold`` or more."""
    model = train(docs, labels, id_col, text_col, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([text_features(t) for t in b.column(text_col).to_pylist()], dtype=float)
            good = model.score(x.reshape(-1, len(FEATURES))) >= threshold
            yield b.filter(pa.array(good))

    return text_rows(docs).mapInArrow(run, docs.schema)
