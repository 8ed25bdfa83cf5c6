"""SMOTE oversampling (F10), after Chawla et al. (2002).

Every class below the majority size gets synthetic rows
``x + u * (neighbour - x)`` where the neighbour is one of the k nearest rows
of the same class.  Deterministic: the copies per row follow the same exact
count rule as random oversampling, and both the neighbour choice and the gap
``u`` come from hashes of (row, copy).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.functions.columns import md5_prefix_int, stable_unit
from featurelab.operators.balance import class_sizes, explode_copies
from featurelab.operators.knn import nearest
from featurelab.operators.rank import hash_rank

RES = 1_000_000


def smote(df: DataFrame, key: str, vec: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic rows only: (synthetic_id, label, vec, base_id, neighbour_id, gap)."""
    sizes = class_sizes(df, label)
    m = sizes.agg(F.max("n")).first()[0] or 0
    small = sizes.where((F.col("n") < m) & (F.col("n") > 1)).select(F.col(label).alias("_label"), F.col("n").alias("_n"))
    minority = df.join(small, F.col(label).eqNullSafe(F.col("_label"))).select(
        F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("v"), F.col(label).alias("label"), "_n")
    # neighbours within the same class: one tiled search, class in the tile key
    nn = nearest(minority.select("id", "v", "label"), minority.drop("_n"), k, exclude_self=True, group="label")
    nbrs = nn.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "tid"))).alias("_nb"))
    # copies per minority row: exact count rule, hash-ranked remainder
    r = minority.withColumn("_h", stable_unit(F.col("id"), seed, RES))
    r = hash_rank(r, ["label"], "_h", "id", RES, out="_rank")
    need = F.lit(m) - F.col("_n")
    copies = F.floor(need / F.col("_n")) + F.when(F.col("_rank") <= F.pmod(need, F.col("_n")), 1).otherwise(0)
    base = explode_copies(r, copies, "copy", "id")
    base = base.join(nbrs, base.id == nbrs.qid, "inner").drop("qid")
    # md5 of "id|copy|seed" (not xxhash64): a SQL engine can redo the choice
    pick = F.pmod(md5_prefix_int(F.concat_ws("|", F.col("id").cast("string"), F.col("copy").cast("string"),
                                             F.lit(str(seed)))), F.size("_nb")) + 1
    base = base.withColumn("neighbour_id", F.element_at("_nb", pick.cast("int"))["tid"])
    base = base.withColumn("gap", stable_unit(F.concat_ws("|", F.col("id").cast("string"),
                                                          F.col("copy").cast("string")), seed + 1, RES) / RES)
    nv = minority.select(F.col("id").alias("neighbour_id"), F.col("v").alias("_nv"))
    j = base.join(nv, "neighbour_id", "inner")
    synth = F.zip_with("v", "_nv", lambda a, b: a + F.col("gap") * (b - a))
    return j.select(F.concat(F.lit("s"), F.col("id").cast("string"), F.lit("_"), F.col("copy").cast("string"))
                    .alias("synthetic_id"), F.col("label").alias(label), synth.alias(vec),
                    F.col("id").alias("base_id"), "neighbour_id", "gap")
