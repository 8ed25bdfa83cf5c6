"""Batch scoring, read-back, version comparison and attributions (K1-K6)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.operators import forest
from featurelab.operators.joins import side_by_side

ScoreFn = Callable[[Mapping[str, Column]], Column]


def batch_predict(model: PipelineModel, df: DataFrame, keep: Sequence[str], out_path: str | None = None,
                  prediction: str = "prediction") -> DataFrame:
    """Instances in, instance + prediction out (K1); with ``out_path`` the
    result is written as JSON Lines."""
    scored = forest.predict(model, df).select(*keep, F.col(prediction).alias("prediction"))
    if out_path:
        scored.write.mode("overwrite").json(out_path)
    return scored


def read_predictions(spark: SparkSession, path: str, schema: str,
                     name_glob: str = "*.json") -> DataFrame:
    """Read prediction files back (K2, IO8): only files matching the glob,
    blank lines skipped, malformed lines kept in ``_corrupt_record``."""
    return (spark.read.schema(schema + ", _corrupt_record string")
            .option("pathGlobFilter", name_glob).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def linear_scorer(weights: Mapping[str, float], intercept: float = 0.0) -> ScoreFn:
    def f(x: Mapping[str, Column]) -> Column:
        out = F.lit(float(intercept))
        for k, w in weights.items():
            out = out + F.lit(float(w)) * x[k]
        return out
    return f


def compare_versions(df: DataFrame, key: str, scorers: Mapping[str, tuple[ScoreFn, Column | None]],
                     features: Sequence[str]) -> DataFrame:
    """Score with two versions and compare side by side.

    ``scorers`` maps version name -> (score function, optional row filter:
    the rows that version serves).  Full outer join on the instance key."""
    (na, (fa, ca)), (nb, (fb, cb)) = list(scorers.items())
    x = {c: F.col(c).cast("double") for c in features}
    a = (df.where(ca) if ca is not None else df).select(key, fa(x).alias("score"))
    b = (df.where(cb) if cb is not None else df).select(key, fb(x).alias("score"))
    return side_by_side(a, b, key, ["score"], (na, nb))


def _path_points(df: DataFrame, key: str, features: Sequence[str], baseline: Mapping[str, float],
                 paths: int, seed: int) -> DataFrame:
    """Every row x path x prefix length: the point whose first ``_p`` features
    of the path are the row's and the rest the baseline's, with ``_cur`` and
    ``_next``, the numbers of the last feature taken and of the one to come.

    A path is the order of the hashes ``xxhash64(key, path, j, seed)``, sorted
    once; each feature then only compares its place with the prefix length,
    so a point costs d comparisons and a path d + 1 scores.
    """
    d = len(features)
    kept = [c for c in df.columns if c not in features]
    x = df.select(*kept, F.array(*[F.col(c).cast("double") for c in features]).alias("_x"))
    x = x.withColumn("_path", F.explode(F.sequence(F.lit(0), F.lit(paths - 1))))
    order = F.transform(F.array_sort(F.array(*[
        F.struct(F.xxhash64(F.col(key), F.col("_path"), F.lit(j), F.lit(seed)).alias("h"), F.lit(j).alias("j"))
        for j in range(d)])), lambda s: s["j"])
    # one-element explodes keep the sorted order and the places as columns, so
    # the points below read them instead of sorting again
    x = x.withColumn("_order", F.explode(F.array(order)))
    place = F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda j: F.array_position("_order", j))
    x = x.withColumn("_place", F.explode(F.array(place)))
    x = x.withColumn("_p", F.explode(F.sequence(F.lit(0), F.lit(d))))
    return x.select(
        *kept, *[F.when(F.col("_place")[k] <= F.col("_p"), F.col("_x")[k]).otherwise(F.lit(float(baseline[c]))).alias(c)
                 for k, c in enumerate(features)],
        F.when(F.col("_p") > 0, F.try_element_at("_order", F.greatest(F.col("_p"), F.lit(1)))).alias("_cur"),
        F.try_element_at("_order", F.col("_p") + 1).alias("_next"),
        ((F.col("_path") == 0) & (F.col("_p") == d)).alias("_whole"))


def _gains(features: Sequence[str], score: Column, paths: int, prefix: str) -> list[Column]:
    """Mean gain of each feature: the score after it came in less the one before."""
    return [(F.sum(F.when(F.col("_cur") == i, score).otherwise(F.lit(0.0))
                   - F.when(F.col("_next") == i, score).otherwise(F.lit(0.0))) / F.lit(float(paths))).alias(prefix + c)
            for i, c in enumerate(features)]


def sampled_shapley(df: DataFrame, key: str, features: Sequence[str], score: ScoreFn,
                    baseline: Mapping[str, float], paths: int = 25, seed: int = 42,
                    prefix: str = "attr_") -> DataFrame:
    """Sampled Shapley attributions (K5) for a model given as a column
    expression; ``key`` must be unique.

    Every row is expanded to ``paths`` hash-seeded feature orders and each
    order to its d + 1 prefixes, which are scored once; the gain of a feature
    is the score after it came in less the score before.  The per-row average
    is an aggregate whose partial step runs in the same task as the expansion,
    so only one row per key is shuffled.  Per path the gains add up to
    f(x) - f(baseline), so the averages do too.
    """
    keep = df.columns
    points = _path_points(df, key, features, baseline, paths, seed)
    scored = points.withColumn("_score", score({c: F.col(c) for c in features}))
    # the other columns ride along with first(): the key is unique per row,
    # so no second scan and no join back are needed
    kept = [c for c in keep if c not in features and c != key]
    agg = scored.groupBy(key).agg(
        *[F.first(c).alias(c) for c in kept], *[F.max(F.when(F.col("_whole"), F.col(c))).alias(c) for c in features],
        *_gains(features, F.col("_score"), paths, prefix))
    base = {c: F.lit(float(baseline[c])) for c in features}
    return agg.select(*keep, *[prefix + c for c in features], score(base).alias("baseline_score"),
                      score({c: F.col(c) for c in features}).alias("instance_score"))


def shapley_error(df: DataFrame, features: Sequence[str], prefix: str = "attr_") -> Column:
    """|sum of attributions - (instance - baseline)|: the approximation error."""
    total = F.lit(0.0)
    for c in features:
        total = total + F.col(prefix + c)
    return F.abs(total - (F.col("instance_score") - F.col("baseline_score")))


def sampled_shapley_model(model, df: DataFrame, key: str, features: Sequence[str],
                          baseline: Mapping[str, float], paths: int = 25, seed: int = 42,
                          output: str = "prediction", prefix: str = "attr_") -> DataFrame:
    """Sampled Shapley attributions (K5, K6) for any fitted model whose
    ``transform`` reads the feature columns (a ``PipelineModel`` that
    assembles them, a tree ensemble, ...).

    The points are those of ``sampled_shapley``, scored in one
    ``model.transform`` (the model stays in the JVM); the gains are averaged
    per row and feature by an aggregate whose partial step runs in the
    expanding task.  ``output`` names the scored column; a vector column
    (e.g. ``probability``) is read at index 1.
    """
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(_path_points(df.select(key, *features), key, features, baseline, paths, seed))
    out_type = dict(scored.dtypes)[output]
    y = F.element_at(vector_to_array(F.col(output)), 2) if out_type == "vector" else F.col(output)
    return scored.groupBy(key).agg(*_gains(features, y, paths, prefix))
