"""Threshold and beat-the-last gates.

The comparison operator is data (a gate table), because pipelines differ in
strict vs non-strict bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelab.operators.aggregate import top_k_within

OPS = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
       "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}


def op_expr(op: Column, value: Column, bound: Column) -> Column:
    out = F.lit(None).cast("boolean")
    for name, fn in OPS.items():
        out = F.when(op == name, fn(value, bound)).otherwise(out)
    return out


def threshold_gate(metrics: DataFrame, gates: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Gate table (metric, op, bound) joined to long metrics (keys, metric,
    value); every gate must hold (``bool_and``).  A missing or NULL metric
    fails: each key of the metrics is checked against every gate, whether or
    not the metric was logged for it.
    """
    if keys:
        # the gates are configuration, a handful of rows: literals beside each key
        rules = F.array(*[F.struct(F.lit(r["metric"]).alias("metric"), F.lit(r["op"]).alias("op"),
                                   F.lit(float(r["bound"])).alias("bound"))
                          for r in gates.select("metric", "op", "bound").collect()])
        asked = metrics.select(*keys).distinct().select(*keys, F.explode(rules).alias("_g")).select(*keys, "_g.*")
        j = asked.join(metrics, [*keys, "metric"], "left")
    else:
        j = gates.join(metrics, "metric", "left")
    ok = F.coalesce(op_expr(F.col("op"), F.col("value"), F.col("bound")), F.lit(False))
    return j.groupBy(*keys).agg(F.bool_and(ok).alias("passes"),
                                F.count(F.lit(1)).alias("n_checks"))


def beat_the_last(log: DataFrame, key: str, order: Sequence[str], metric: str,
                  threshold: float) -> DataFrame:
    """Newest run per key must reach ``threshold`` and be >= the run before it.

    With no earlier run the threshold alone decides (the reference would
    crash on an empty history); a NULL newest metric fails, and a NULL earlier
    one is no bar.  The history is read once: the two newest runs per key come
    from a ``row_number() <= 2`` window, which Spark limits map-side, and are
    folded into one row.
    """
    top2 = top_k_within(log, [key], [F.col(c).desc() for c in order], 2, "_rn")
    first, second = F.col("_rn") == 1, F.col("_rn") == 2
    j = top2.groupBy(key).agg(F.max(F.when(first, F.col(order[-1]))).alias(order[-1]),
                              F.max(F.when(first, F.col(metric))).alias(metric),
                              F.max(F.when(second, F.col(metric))).alias("previous_metric"))
    passes = F.coalesce((F.col(metric) >= threshold) & (
        F.col("previous_metric").isNull() | (F.col(metric) >= F.col("previous_metric"))), F.lit(False))
    return j.select(key, order[-1], metric, "previous_metric", passes.alias("passes"))
