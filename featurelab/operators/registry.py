"""Model registry as append-only tables.

``versions``: (model, version, created_at, ...) rows, appended.
``alias_events``: (model, alias, version, at, action 'add'|'remove'),
appended; the current alias is the newest event per (model, alias), so a
swap is two appended rows and history is never rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.functions.columns import stable_unit
from featurelab.operators.aggregate import latest_per_key
from featurelab.operators.rank import range_rank
from featurelab.session import materialize


def resolve_aliases(alias_events: DataFrame) -> DataFrame:
    """Current (model, alias) -> version (R4): newest event wins; an alias
    whose newest event is a removal is unset."""
    latest = latest_per_key(alias_events, ["model", "alias"], ["at", "seq"],
                            ["version", "at", "action"])
    return latest.where(F.col("action") == "add").drop("action")


def list_versions(versions: DataFrame, alias_events: DataFrame) -> DataFrame:
    """Version list (R3): every registered (model, version, created_at) with
    its number within the model, its parent (the version before it) and the
    aliases that point at it now, sorted by name; '' for none.

    Numbers come from range buckets, so a model with very many versions is not
    one task; the parent is a join on the number before.
    """
    numbered = materialize(range_rank(versions.select("model", "version", "created_at"), ["created_at", "version"],
                                      "number", keys=["model"]))
    parent = numbered.select("model", (F.col("number") + 1).alias("number"), F.col("version").alias("parent"))
    labels = resolve_aliases(alias_events).groupBy("model", "version").agg(
        F.array_join(F.array_sort(F.collect_set("alias")), ",").alias("aliases"))
    return (numbered.join(parent, ["model", "number"], "left").join(labels, ["model", "version"], "left")
            .select("model", "number", "version", "created_at", "parent", F.coalesce("aliases", F.lit("")).alias("aliases")))


def swap_alias_events(spark, model: str, alias: str, old_version, new_version, at) -> DataFrame:
    """The two events of an alias swap (remove old, add new), to append."""
    return spark.createDataFrame(
        [(model, alias, old_version, at, 0, "remove"), (model, alias, new_version, at, 1, "add")],
        "model string, alias string, version bigint, at timestamp, seq int, action string")


def traffic_route(key, splits: Sequence[tuple[str, int]], seed: int = 11):
    """Sticky traffic split (R5): bucket = md5(key || seed) mod 100 against
    the cumulative percentages of ``splits`` [(target, percent), ...]."""
    total = sum(p for _, p in splits)
    if total != 100:
        raise ValueError("traffic split must add up to 100")
    bucket = F.floor(stable_unit(key, seed) / 10_000)
    expr = None
    upper = 0
    for target, pct in splits:
        upper += pct
        expr = F.when(bucket < upper, F.lit(target)) if expr is None else expr.when(
            bucket < upper, F.lit(target))
    return expr.otherwise(F.lit(splits[-1][0]))
