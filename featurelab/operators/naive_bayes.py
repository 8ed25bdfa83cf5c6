"""Multinomial naive Bayes over hashed tokens, any number of classes.

The model is a table of classes x buckets of integer weights, in millionths of
a natural logarithm, from grouped token counts; a prediction is a sum of whole
numbers within the row, so it does not depend on the order of tokens, rows or
engines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICRO = 1_000_000.0


@dataclass
class NaiveBayes:
    classes: list[str]
    prior: list[int]
    weights: list[list[int]]  # per class, one number per bucket


def _micro(num: Column, den: Column) -> Column:
    return F.round(F.lit(MICRO) * (F.ln(num.cast("double")) - F.ln(den.cast("double")))).cast("long")


def fit(counts: DataFrame, label: str, buckets: int, max_classes: int = 256) -> NaiveBayes:
    """From rows of idx, tf (see ``embed.term_counts``) and a class; rows of a
    null class are left out.  One is added to every bucket of every class.  At
    most classes x buckets numbers reach the driver; more classes than
    ``max_classes`` are refused."""
    known = counts.where(F.col(label).isNotNull()).withColumn("_c", F.col(label).cast("string"))
    docs = {r["_c"]: r["n"] for r in known.groupBy("_c").agg(F.count("*").alias("n")).limit(max_classes + 1).collect()}
    if len(docs) > max_classes:
        raise ValueError(f"over {max_classes} classes")
    classes = sorted(docs)
    per = known.select("_c", F.explode(F.arrays_zip("idx", "tf")).alias("p")).groupBy("_c", F.col("p.idx").alias("b")).agg(
        F.sum("p.tf").alias("n"))
    seen = {(r["_c"], r["b"]): r["n"] for r in per.collect()}
    rows = [(c, b, seen.get((c, b), 0)) for c in classes for b in range(buckets)]
    if not rows:
        return NaiveBayes([], [], [])
    spark = counts.sparkSession
    total = {c: sum(n for (x, _), n in seen.items() if x == c) for c in classes}
    table = spark.createDataFrame([(c, b, n, total[c] + buckets) for c, b, n in rows], "c string, b int, n long, t long")
    found = {(r["c"], r["b"]): r["w"] for r in table.select("c", "b", _micro(F.col("n") + 1, F.col("t")).alias("w")).collect()}
    prior = spark.createDataFrame([(c, docs[c], sum(docs.values())) for c in classes], "c string, n long, t long")
    first = {r["c"]: r["w"] for r in prior.select("c", _micro(F.col("n"), F.col("t")).alias("w")).collect()}
    return NaiveBayes(classes, [first[c] for c in classes], [[found[c, b] for b in range(buckets)] for c in classes])


def scores(model: NaiveBayes) -> Column:
    """Array of each class's score of a row of idx and tf, within the row."""
    def one(first: int, w: list[int]) -> Column:
        table = F.split(F.lit(",".join(map(str, w))), ",").cast("array<bigint>")
        terms = F.zip_with("idx", "tf", lambda i, t: t * F.get(table, i))
        return F.aggregate(terms, F.lit(first).cast("long"), lambda a, x: a + x)

    return F.array(*[one(*x) for x in zip(model.prior, model.weights)])


def predict(counts: DataFrame, model: NaiveBayes) -> DataFrame:
    """The rows with their class in ``prediction`` (the first by name among
    equals; null if none was learned) and ``margin``, how far the runner-up
    is behind.  A row without tokens gets the most frequent class."""
    if not model.classes:
        return counts.drop("idx", "tf").withColumns({"prediction": F.lit(None).cast("string"), "margin": F.lit(None).cast("long")})
    keep = [c for c in counts.columns if c not in ("idx", "tf")]
    ranked = F.transform(scores(model), lambda s, i: F.struct((-s).alias("s"), i.alias("i")))
    x = counts.select(*keep, F.explode(F.array(F.array_sort(ranked))).alias("_r"))
    names = F.array(*[F.lit(c) for c in model.classes])
    return x.select(*keep, F.get(names, F.get("_r", F.lit(0))["i"]).alias("prediction"),
                    (F.get("_r", F.lit(1))["s"] - F.get("_r", F.lit(0))["s"]).alias("margin"))
