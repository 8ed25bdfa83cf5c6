"""Language identification by error-correcting output codes (operator 5).

Every language has a codeword; one binary classifier per bit predicts that
bit from byte n-grams (2 to 4 bytes, hashed), and loss-weighted decoding picks
the language whose codeword disagrees least, each bit weighted by how well its
classifier does on that language.

Training is two passes over a bounded hash sample of labelled documents: the
n-gram counts of each language (summed in Spark), from which every bit's
smoothed log-odds follow, then each bit's accuracy on each language.  Only
tables of languages x buckets and languages x bits reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelab.llm.common import shared_table, small_side, text_rows

BUCKETS = 1 << 15
ORDERS = (2, 3, 4)
CHUNK = 1 << 18  # bytes of a text looked at together
MAX_TRAIN_DOCS = 4000  # per language: the documented bound of the training sample
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_buckets(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of all byte n-grams of the whole lower-cased text, in
    pieces that overlap by the longest n-gram."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    for s in range(0, max(1, len(data)), CHUNK):
        for n in ORDERS:
            part = data[s:s + CHUNK + n - 1]
            if len(part) < n:
                continue
            code = part[:len(part) - n + 1].copy()
            for k in range(1, n):
                code = (code << np.uint32(8)) | part[k:len(part) - n + 1 + k]
            yield ((code + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(17)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """(k, bits) of +1/-1.  Up to 6 languages: every split of the languages
    into two sides once; above: random codewords of 10 log2(k) bits at least,
    redrawn until any two differ in a quarter of the bits."""
    if k < 2:
        return np.ones((k, 0), dtype=np.int8)
    if k <= 6:
        cols = [[1 if (b >> i) & 1 else -1 for i in range(k)] for b in range(1, 1 << (k - 1))]
        return np.array(cols, dtype=np.int8).T
    rng, bits = np.random.default_rng(seed), max(16, int(np.ceil(10 * np.log2(k))))
    while True:
        m = rng.choice(np.array([-1, 1], dtype=np.int8), (k, bits))
        apart = min((m[i] != m[j]).sum() for i, j in combinations(range(k), 2))
        if apart * 4 >= bits and (abs(m.sum(0)) < k).all():
            return m


@dataclass
class EcocModel:
    langs: list[str]
    code: np.ndarray     # (langs, bits) of +1/-1
    weights: np.ndarray  # (buckets, bits) log-odds
    trust: np.ndarray    # (langs, bits): accuracy of each bit on each language, rows sum to 1
    sharpness: float = 8.0
    margin: float = 0.15

    def margins(self, text: str) -> np.ndarray:
        """Mean log-odds of each bit over all n-grams of the text."""
        total, n = np.zeros(self.code.shape[1]), 0
        for idx in gram_buckets(text):
            total += self.weights[idx].sum(0, dtype=np.float64)
            n += len(idx)
        return total / max(1, n)

    def decode(self, margins: np.ndarray) -> tuple[int, float, bool]:
        """(language number, probability-like score, ambiguous)."""
        loss = (self.trust * np.logaddexp(0, -self.sharpness * self.code * margins)).sum(1)
        e = np.exp(loss.min() - loss)
        p = e / e.sum()
        best = int(np.argmin(loss))
        second = np.partition(p, -2)[-2] if len(p) > 1 else 0.0
        return best, float(min(1.0, max(0.0, p[best]))), bool(p[best] - second < self.margin)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, True
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        i, score, unsure = self.decode(self.margins(text))
        return self.langs[i], score, unsure


def bounded_sample(rows: DataFrame, by: str, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows of each value of ``by``, all if it has fewer,
    chosen by the hash of ``key`` (the same rows every time).  The values'
    counts go to the rows, which are not shuffled while those are proven few."""
    sizes = small_side(shared_table(rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n")), "lang-sizes"), 64)
    resolution = 1 << 30
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(resolution)) * F.col("_n")
    return rows.join(sizes, by).where(drawn < F.lit(resolution * bound)).drop("_n")


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_docs: int = MAX_TRAIN_DOCS, smoothing: float = 0.5) -> EcocModel:
    """Fit on about ``max_docs`` rows of each non-null language."""
    ids = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("t"))
    sample = text_rows(shared_table(bounded_sample(ids, "lang", "id", max_docs), "lang-sample"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, t in zip(b["lang"], b["t"]):
                if has_letter(t):
                    into = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    for idx in gram_buckets(t):
                        into += np.bincount(idx, minlength=BUCKETS)
        for lang, c in held.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": c[at]})

    counted = (sample.mapInPandas(count, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(counted["lang"].unique())
    table = np.zeros((len(langs), BUCKETS))
    if len(langs):
        table[np.searchsorted(langs, counted["lang"]), counted["bucket"]] = counted["n"]
    rates = table / np.maximum(1.0, table.sum(1, keepdims=True))  # languages weigh the same
    code = codewords(len(langs))
    alpha = smoothing / BUCKETS
    weights = np.zeros((BUCKETS, code.shape[1]), dtype=np.float32)
    for b in range(code.shape[1]):
        up, down = rates[code[:, b] > 0], rates[code[:, b] < 0]
        weights[:, b] = np.log(up.mean(0) + alpha) - np.log(down.mean(0) + alpha)
    model = EcocModel(langs, code, weights, np.full(code.shape, 1.0 / max(1, code.shape[1])))
    if code.shape[1] == 0:
        return model

    def grade(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        right, seen = np.zeros(code.shape), np.zeros(len(langs))
        for b in batches:
            for lang, t in zip(b["lang"], b["t"]):
                if has_letter(t):
                    i = langs.index(lang)
                    right[i] += model.margins(t) * code[i] > 0
                    seen[i] += 1
        yield pd.DataFrame({"i": np.repeat(np.arange(len(langs)), code.shape[1]),
                            "bit": np.tile(np.arange(code.shape[1]), len(langs)),
                            "right_": right.ravel(), "seen": np.repeat(seen, code.shape[1])})

    graded = (sample.mapInPandas(grade, "i int, bit int, right_ double, seen double")
              .groupBy("i", "bit").agg(F.sum("right_").alias("r"), F.sum("seen").alias("s")).toPandas())
    trust = np.zeros(code.shape)
    trust[graded["i"], graded["bit"]] = (graded["r"] + 1) / (graded["s"] + 2)
    model.trust = trust / trust.sum(1, keepdims=True)
    return model


def predict(docs: DataFrame, model: EcocModel, id_col: str = "doc_id", text_col: str = "text",
            keep: Sequence[Column] = ()) -> DataFrame:
    """(id_col, lang_pred, score, ambiguous, *keep) for every input row, from
    the whole text alone.  Null texts and texts without a letter give ``und``,
    score 0 and ambiguous; so does everything if no language was learned.
    Repeated rows are kept; an empty table gives an empty result."""
    src = text_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), *keep))
    extra = [f for f in src.schema.fields if f.name not in ("id", "t")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [model.predict(t) for t in b["t"]]
            out = pd.DataFrame(found, columns=["lang_pred", "score", "ambiguous"], index=b.index)
            yield pd.concat([b.drop(columns="t"), out], axis=1)

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [src.schema["id"], *extra])
    return (src.mapInPandas(run, f"{names}, lang_pred string, score double, ambiguous boolean")
            .select(F.col("id").alias(id_col), *[f.name for f in extra], "lang_pred", "score", "ambiguous"))
