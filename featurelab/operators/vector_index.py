"""Exact nearest neighbours over a partitioned vector index.

The index deals vectors to cells, each the neighbourhood of a pivot, and knows
of every cell how many vectors it holds and between which distances of its
pivot they lie.  For a query at distance d of that pivot the triangle
inequality then bounds all of them from below by ``d - most`` and ``least - d``,
and by half of what the pivot is farther than the query's nearest one.  A
search asks a query's own cell first; the k-th distance found there decides
which other cells can hold a nearer vector, and no other is opened.  Results
are those of comparing everything, ties by smaller id.

Cosine similarity is the same search over unit vectors, where the squared
distance is 2 - 2 cos.

A list of queries proven small goes to the tasks that scan the index, and the
vectors stay where they are.  Beyond that, (queries, vectors) meet in tiles of
bounded size, as many for a cell as its vectors and its queries need, so a cell
that holds a third of all rows is many tiles.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from featurelab.session import scratch_path, workers_import

CELL_ROWS = 8192       # vectors of a cell, about
MAX_CELLS = 1024       # cells of a group; a larger corpus has larger cells
MAX_STATS = 200_000    # (group, cell) figures on the driver; more groups get fewer cells
SAMPLE_ROWS = 4096     # vectors among which pivots are chosen; only the work depends on it
FEW_BYTES = 4 << 20    # of queries that go to the tasks as they are
SIZES_BYTES = 16 << 20 # of cell sizes that go to the rows as they are


def _finite(v: str, metric: str) -> Column:
    ok = F.col(v).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return ok & F.exists(v, lambda x: x != 0) if metric == "cosine" else ok


def _group(group: str | None) -> Column:
    """The group as text; null is a group of its own."""
    if group is None:
        return F.lit("")
    return F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to all pivots from differences: no cancellation in the bounds."""
    return np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in pivots], axis=1)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` pivots: farthest-first among the sample, then the means of four
    rounds of assignment.  Any points would do; near ones prune more."""
    if not len(sample):
        return np.zeros((1, 0))
    picked, far = [0], np.full(len(sample), np.inf)
    for _ in range(min(n, len(sample)) - 1):
        far = np.minimum(far, ((sample - sample[picked[-1]]) ** 2).sum(1))
        if far.max() <= 0:
            break
        picked.append(int(far.argmax()))
    pivots = sample[picked].copy()
    for _ in range(4):
        home = (-2 * sample @ pivots.T + (pivots * pivots).sum(1)).argmin(1)
        for c in np.unique(home):
            pivots[c] = sample[home == c].mean(0)
    return pivots


def best_of_tile(qv: np.ndarray, bound: np.ndarray, cv: np.ndarray, ids: np.ndarray, k: int, metric: str,
                 skip: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows, keys) of each query's ``k`` best rows of a tile whose
    distance is within ``bound``.  A matrix product picks the rows that can be
    among them, with room for its rounding; their keys (distance, or cosine
    with its sign turned) are then computed by themselves.  ``skip`` holds an
    id per query that is not its neighbour."""
    a, b = (_unit(qv), _unit(cv)) if metric == "cosine" else (qv, cv)
    aa, bb = (a * a).sum(1), (b * b).sum(1)
    rough = aa[:, None] + bb - 2 * (a @ b.T)
    room = 1e-13 * (aa + bb.max()) * max(8, a.shape[1])
    most = np.minimum(bound * (1 + 1e-9) + 1e-9, 1e150) ** 2 + room
    n = k + (skip is not None)
    if n < len(cv):
        most = np.minimum(most, np.partition(rough, n - 1, axis=1)[:, n - 1] + 2 * room)
    place = ids if ids.dtype.kind in "iuf" else np.unique(ids, return_inverse=True)[1]
    for i in range(len(qv)):
        at = np.flatnonzero(rough[i] <= most[i])
        if skip is not None:
            at = at[ids[at] != skip[i]]
        if metric == "cosine":
            key = -(cv[at] * qv[i]).sum(1) / (np.sqrt((cv[at] * cv[at]).sum(1)) * np.sqrt((qv[i] * qv[i]).sum()))
        else:
            key = np.sqrt(((cv[at] - qv[i]) ** 2).sum(1))
        first = np.lexsort((place[at], key))[:k]
        yield i, at[first], key[first]


def lower_bounds(cells: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Least distance of each query (row of ``d``, to all pivots) to any vector
    of each of a group's cells."""
    at = cells[:, 0].astype(int)
    bound = np.maximum(d[:, at] - cells[:, 3], cells[:, 2] - d[:, at])
    return np.maximum(bound, (d[:, at] - d.min(1, keepdims=True)) / 2)


@dataclass
class VectorIndex:
    """Vectors by cell in a table of the shared folder, and the cells' figures."""

    rows: DataFrame        # grp, cell, r (distance to the pivot), id, v, label
    pivots: np.ndarray
    cells: dict[str, np.ndarray]  # group: rows (cell, n, least r, most r)
    metric: str
    cell_rows: int

    @classmethod
    def build(cls, corpus: DataFrame, id_col: str, vec_col: str, label_col: str | None = None,
              group: str | None = None, metric: str = "euclidean", cell_rows: int = CELL_ROWS,
              max_cells: int = MAX_CELLS, store: bool = True) -> VectorIndex:
        """Index the rows whose vector is whole and finite (for cosine, not
        zero).  ``store`` writes the table in order of cells, so that a search
        of few cells reads few row groups; without it the table is kept as a
        checkpoint in the order of the corpus."""
        workers_import(corpus.sparkSession)
        rows = corpus.select(_group(group).alias("grp"), F.col(id_col).alias("id"),
                             F.col(vec_col).cast("array<double>").alias("v"),
                             (F.col(label_col) if label_col else F.lit(None)).cast("long").alias("label"))
        rows = rows.where(_finite("v", metric))
        sizes = rows.groupBy("grp").count().agg(F.count("*").alias("groups"), F.max("count").alias("most")).first()
        groups, most = sizes["groups"], sizes["most"] or 0
        n = max(1, min(max_cells, math.ceil(most / cell_rows), MAX_STATS // max(1, groups)))
        sample = rows.select("v").orderBy(F.xxhash64("id", "v")).limit(min(SAMPLE_ROWS, 64 * n)).collect()
        x = np.array([r["v"] for r in sample], dtype=float) if sample else np.zeros((0, 0))
        pivots = choose_pivots(_unit(x) if metric == "cosine" and len(x) else x, n)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    v = _matrix(b.column("v"))
                    d = _to_pivots(_unit(v) if metric == "cosine" else v, pivots)
                    cell = d.argmin(1)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("grp"), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell]),
                         b.column("id"), b.column("v"), b.column("label")], ["grp", "cell", "r", "id", "v", "label"])

        kind = rows.schema["id"].dataType.simpleString()
        dealt = rows.mapInArrow(assign, f"grp string, cell int, r double, id {kind}, v array<double>, label long")
        path = scratch_path(corpus.sparkSession, "vector-index")
        if store:
            # by ranges of (cell, distance, id hash): a hot cell, or one vector's copies, fill several tasks
            order = ["grp", "cell", "r", F.xxhash64("id")]
            dealt = dealt.repartitionByRange(*order).sortWithinPartitions("grp", "cell", "r")
        dealt.write.parquet(path)
        stored = corpus.sparkSession.read.schema(dealt.schema).parquet(path)
        cells: dict[str, list] = {}
        if n > 1:
            per = stored.groupBy("grp", "cell").agg(F.count("*").alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi"))
            for r in per.collect():
                cells.setdefault(r["grp"], []).append((r["cell"], r["n"], r["lo"], r["hi"]))
        return cls(stored, pivots, {g: np.array(sorted(c), dtype=float) for g, c in cells.items()}, metric, cell_rows)

    def routes(self, queries: DataFrame, home: bool) -> DataFrame:
        """(grp, cell, qid, qv, bound): the cells that each query (grp, qid, qv,
        bound) must open, its own (``home``) or the others."""
        workers_import(queries.sparkSession)
        pivots, stats, metric = self.pivots, self.cells, self.metric
        if not pivots.shape[1]:  # nothing is indexed
            queries = queries.where(F.lit(False))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                qv = _matrix(b.column("qv"))
                d = _to_pivots(_unit(qv) if metric == "cosine" else qv, pivots)
                bound = b.column("bound").to_numpy(zero_copy_only=False)
                grp = np.array(b.column("grp").to_pylist(), dtype=object)
                row, cell = [], []
                for g in set(grp):
                    at = np.flatnonzero(grp == g)
                    if not stats:
                        take, of = at, np.zeros(len(at), dtype=int)
                    elif g not in stats:
                        continue
                    else:
                        low = lower_bounds(stats[g], d[at])
                        own = d[at][:, stats[g][:, 0].astype(int)].argmin(1)
                        if home:
                            take, of = at, own
                        else:
                            open_ = low <= (bound[at] * (1 + 1e-9) + 1e-9)[:, None]
                            open_[np.arange(len(at)), own] = False
                            i, of = np.nonzero(open_)
                            take = at[i]
                        of = stats[g][of, 0].astype(int)
                    row.append(take)
                    cell.append(of)
                if row:
                    row = pa.array(np.concatenate(row))
                    yield pa.RecordBatch.from_arrays(
                        [b.column("grp").take(row), pa.array(np.concatenate(cell).astype(np.int32)), b.column("qid").take(row),
                         b.column("qv").take(row), b.column("bound").take(row)], ["grp", "cell", "qid", "qv", "bound"])

        kind = queries.schema["qid"].dataType.simpleString()
        return queries.mapInArrow(run, f"grp string, cell int, qid {kind}, qv array<double>, bound double")

    def _opened(self, routes: DataFrame, k: int, self_out: bool, few: bool, block: int) -> DataFrame:
        """(qid, tid, key, tlabel): each route's ``k`` best rows per tile."""
        kinds = [x.simpleString() for x in (routes.schema["qid"].dataType, self.rows.schema["id"].dataType)]
        schema = f"qid {kinds[0]}, tid {kinds[1]}, key double, tlabel long"
        if few:
            return self._scanned(routes, k, self_out, schema)
        path = scratch_path(self.rows.sparkSession, "vector-routes")
        routes.write.parquet(path)
        routes = self.rows.sparkSession.read.schema(routes.schema).parquet(path)
        # a cell's tiles: its queries in blocks times its vectors in blocks
        needed = routes.groupBy("grp", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("qs"))
        held = self.rows.groupBy("grp", "cell").agg(F.ceil(F.count("*") / self.cell_rows).cast("int").alias("cs"))
        path = scratch_path(self.rows.sparkSession, "vector-tiles")
        needed.join(held, ["grp", "cell"]).write.parquet(path)
        sizes = self.rows.sparkSession.read.parquet(path)
        if sizes.count() * 64 <= SIZES_BYTES:  # then a hot cell's rows are not brought together to learn its size
            sizes = F.broadcast(sizes)
        q = (routes.join(sizes, ["grp", "cell"]).withColumn("qb", F.pmod(F.xxhash64("qid"), F.col("qs")))
             .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cs").cast("long") - 1)))
             .select("grp", "cell", "qb", "cb", "qid", "qv", "bound"))
        c = (self.rows.join(sizes, ["grp", "cell"]).withColumn("cb", F.pmod(F.xxhash64("id"), F.col("cs")))
             .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qs").cast("long") - 1)))
             .select(F.col("grp").alias("g"), F.col("cell").alias("c"), F.col("qb").alias("b"), F.col("cb").alias("d"), "id",
                     "v", "label"))
        tile = _tile(k, self.metric, self_out)
        return q.groupBy("grp", "cell", "qb", "cb").cogroup(c.groupBy("g", "c", "b", "d")).applyInPandas(tile, schema)

    def _scanned(self, routes: DataFrame, k: int, self_out: bool, schema: str) -> DataFrame:
        """Few routes, collected: the cells they open are scanned where they lie."""
        by_cell: dict[tuple, list] = {}
        for r in routes.collect():
            by_cell.setdefault((r["grp"], r["cell"]), []).append((r["qid"], r["qv"], r["bound"]))
        packed = {key: ([x[0] for x in rs], np.array([x[1] for x in rs], dtype=float), np.array([x[2] for x in rs]))
                  for key, rs in by_cell.items()}
        cells = sorted({c for _, c in packed})
        metric = self.metric

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                grp = b.column("grp").dictionary_encode()
                code = grp.indices.to_numpy(zero_copy_only=False).astype(np.int64) << 32
                code += b.column("cell").to_numpy(zero_copy_only=False)
                out = []
                for at in (np.flatnonzero(code == x) for x in np.unique(code)):
                    key = (b.column("grp")[int(at[0])].as_py(), b.column("cell")[int(at[0])].as_py())
                    if key not in packed:
                        continue
                    qid, qv, bound = packed[key]
                    part = b.take(pa.array(at))
                    ids = _ids(part.column("id"))
                    skip = np.array(qid, dtype=ids.dtype) if self_out else None
                    for i, rows, keys in best_of_tile(qv, bound, _matrix(part.column("v")), ids, k, metric, skip):
                        out += [(qid[i], int(at[r]), float(x)) for r, x in zip(rows, keys)]
                if out:
                    rows = pa.array([x[1] for x in out])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in out], kind), b.column("id").take(rows), pa.array([x[2] for x in out]),
                         b.column("label").take(rows)], ["qid", "tid", "key", "tlabel"])

        kind = to_arrow_type(routes.schema["qid"].dataType)
        return self.rows.where(F.col("cell").isin(cells) if cells else F.lit(False)).mapInArrow(run, schema)

    def search(self, queries: DataFrame, query_id: str, vec_col: str, k: int, group: str | None = None,
               exclude_self: bool = False, query_block: int = 1024, few_bytes: int = FEW_BYTES) -> DataFrame:
        """(qid, tid, key, tlabel, rank): the ``k`` nearest rows of every query
        whose vector is whole and finite, within its group; the key is the
        distance, or the cosine with its sign turned.  Ties go to the smaller
        id, and ``exclude_self`` leaves the query's own id out."""
        q = queries.select(_group(group).alias("grp"), F.col(query_id).alias("qid"),
                           F.col(vec_col).cast("array<double>").alias("qv"), F.lit(math.inf).alias("bound"))
        q = q.where(_finite("qv", self.metric))
        size = q.agg(F.sum(F.size("qv").cast("long") * 8 + 64)).first()[0] or 0
        few = size <= few_bytes
        found = self._opened(self.routes(q, home=True), k, exclude_self, few, query_block)
        if self.cells:
            path = scratch_path(self.rows.sparkSession, "vector-found")
            found.write.parquet(path)
            found = self.rows.sparkSession.read.schema(found.schema).parquet(path)
            far = F.sqrt(F.greatest(2 + 2 * F.col("key"), F.lit(0.0))) if self.metric == "cosine" else F.col("key")
            w = Window.partitionBy("qid").orderBy("key", "tid")
            # a query with fewer than k in its own cell has no bound yet
            kth = (found.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == k)
                   .select(F.col("qid").alias("_q"), far.alias("_d")))
            again = q.join(kth, F.col("qid") == F.col("_q"), "left").select(
                "grp", "qid", "qv", F.coalesce("_d", "bound").alias("bound"))
            others = self.routes(again, home=False)
            few = few and (others.count() if few else 0) * (size // max(1, q.count() if few else 1)) <= 4 * few_bytes
            found = found.unionByName(self._opened(others, k, exclude_self, few, query_block))
        w = Window.partitionBy("qid").orderBy("key", "tid")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _ids(col: pa.Array) -> np.ndarray:
    if pa.types.is_integer(col.type):
        return col.to_numpy(zero_copy_only=False)
    return np.array(col.to_pylist(), dtype=object)


def _tile(k: int, metric: str, self_out: bool) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def fn(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"qid": [], "tid": [], "key": [], "tlabel": []}
        if len(q) and len(c):
            ids, qid = c["id"].to_numpy(), q["qid"].to_numpy()
            label = c["label"].to_numpy()
            best = best_of_tile(np.stack(q["qv"].to_numpy()).astype(float), q["bound"].to_numpy(),
                                np.stack(c["v"].to_numpy()).astype(float), ids, k, metric, qid if self_out else None)
            for i, rows, keys in best:
                out["qid"] += [qid[i]] * len(rows)
                out["tid"] += ids[rows].tolist()
                out["key"] += keys.tolist()
                out["tlabel"] += label[rows].tolist()
        return pd.DataFrame(out, dtype=object)  # a tile without rows must not turn text columns into numbers

    return fn
