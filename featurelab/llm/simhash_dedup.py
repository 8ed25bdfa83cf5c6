"""SimHash near-duplicates through vantage-point trees (operator 1).

1. ``fingerprints``: one 64-bit SimHash per document, in Arrow batches.
2. ``vp_shards``: the distinct fingerprints are cut by vantage-point trees.
   A node has a vantage point v and a radius m: d(x, v) <= m goes inside,
   the rest outside.  Two points at distance r or less differ by at most r
   in d(., v), so an inside point with d > m - r is also copied to the outer
   side; every pair within r then meets in some shard, and a branch that the
   triangle bound excludes is never visited.
3. ``shard_links``: inside a shard, pairs are compared exactly.  A shard that
   cannot be cut any further (a dense ball) is dealt as pairs of blocks of
   bounded size.  Each block pair returns a spanning forest of its links, not
   every pair.
4. Connected components over fingerprints, joined back to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.llm.common import fresh, shared_table, text_rows
from featurelab.llm.components import connected_components

SEED = 42


def simhash64(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text: A-Z lower-cased, words between ASCII white space,
    ``shingle`` words joined by spaces, repeats included."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        spans = [(0, len(flat))]
    else:
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    h64 = xxhash.xxh64_intdigest
    counts, n, chunk = np.zeros(64, np.int64), 0, []

    def add(values: list) -> None:
        bits = np.unpackbits(np.array(values, dtype=">u8").view(np.uint8)).reshape(-1, 64)
        counts[:] += bits.sum(0, dtype=np.int64)

    for s, e in spans:
        chunk.append(h64(flat[s:e], SEED))
        if len(chunk) == 65536:  # bounds the bit matrix of a very long text
            add(chunk)
            n, chunk = n + len(chunk), []
    if chunk:
        add(chunk)
        n += len(chunk)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(id_col, fp bigint: the 64 bits as a signed long), one row per input
    row.  A null or wordless text has fingerprint 0."""
    src = text_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([simhash64(t, shingle) for t in b.column("t").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fp.view(np.int64))], ["id", "fp"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, fp long").select(F.col("id").alias(id_col), "fp")


def _cut(points: np.ndarray, radius: int, tries: int = 8) -> tuple[int, int, float]:
    """Vantage point and radius with the smallest expected pair work: of a few
    points and all radii the one that minimises inner^2 + (outer + copies)^2.
    Returns (vantage, radius, work relative to no cut)."""
    best = (0, 0, 1.0)
    n = len(points)
    for v in points[:: max(1, n // tries)][:tries]:
        hist = np.bincount(np.bitwise_count(points ^ v), minlength=65).astype(float)
        inside = np.cumsum(hist)
        for m in range(64):
            band = inside[m] - (inside[m - radius] if m >= radius else 0.0)
            work = (inside[m] ** 2 + (n - inside[m] + band) ** 2) / n ** 2
            if work < best[2]:
                best = (int(v), m, work)
    return best


def build_tree(points: np.ndarray, depth: int, radius: int, max_work: float = 0.8) -> list:
    """Nodes in heap order (index 1 is the root): (vantage, m), or None where
    a cut would not pay and the branch ends."""
    nodes: list = [None] * (1 << depth)

    def grow(i: int, pts: np.ndarray) -> None:
        if i >= len(nodes) or len(pts) < 16:
            return
        v, m, work = _cut(pts, radius)
        if work > max_work:
            return
        nodes[i] = (v, m)
        d = np.bitwise_count(pts ^ np.uint64(v)).astype(np.int64)
        grow(2 * i, pts[d <= m])
        grow(2 * i + 1, pts[d > m - radius])

    grow(1, points)
    return nodes


def route(points: np.ndarray, nodes: list, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, branch as heap path) of every copy of ``points``."""
    rows, paths = [], []
    todo = [(1, np.arange(len(points)))]
    while todo:
        i, idx = todo.pop()
        if i >= len(nodes) or nodes[i] is None:
            rows.append(idx)
            paths.append(np.full(len(idx), i))
            continue
        v, m = nodes[i]
        d = np.bitwise_count(points[idx] ^ np.uint64(v)).astype(np.int64)
        todo += [(2 * i, idx[d <= m]), (2 * i + 1, idx[d > m - radius])]
    return np.concatenate(rows), np.concatenate(paths)


def vp_shards(points: DataFrame, max_bits: int, shard_rows: int = 4096, depth: int = 4,
              sample_rows: int = 2048) -> DataFrame:
    """(fp, shard): every fingerprint in its own shard and, as a copy, in
    those whose boundary lies within ``max_bits`` of it.

    Works in rounds until no shard above ``shard_rows`` can be cut: each
    round, every such shard gets a tree of at most ``depth`` levels, built in
    a task of its own from a hash sample of about ``sample_rows`` of its
    points (the sample shapes the tree only; all points are routed).  The
    trees are a table joined by shard, so neither the driver nor a broadcast
    holds anything that grows with the data.
    """
    tree_type = "shard string, vantage array<long>, bound array<int>"
    # written, so that the joins by shard see a column and not a constant
    open_ = shared_table(points.select("fp", F.lit("").alias("shard")), "vp-root")
    done = open_.limit(0)
    while True:
        sizes = open_.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
        big = sizes.where(F.col("n") > shard_rows)
        done = done.unionByName(open_.join(big, "shard", "left_anti").select("fp", "shard"))
        if big.isEmpty():
            return done
        big_points = open_.join(big, "shard")
        resolution = 1 << 30
        sample = big_points.where(F.pmod(F.xxhash64("fp"), F.lit(resolution)) * F.col("n")
                                  < F.lit(resolution * sample_rows)).select("shard", "fp")

        def grow(pdf: pd.DataFrame) -> pd.DataFrame:
            pts = np.sort(pdf["fp"].to_numpy(np.int64).view(np.uint64))
            pts = pts[np.argsort((pts * np.uint64(0x9E3779B97F4A7C15)), kind="stable")]
            nodes = build_tree(pts, depth, max_bits)
            v = np.array([n[0] if n else 0 for n in nodes], dtype=np.uint64).view(np.int64)
            m = [n[1] if n else -1 for n in nodes]
            return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "vantage": [v.tolist()], "bound": [m]})

        trees = sample.groupBy("shard").applyInPandas(grow, tree_type)

        def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for shard, g in b.groupby("shard", sort=False):
                    first = g.iloc[0]
                    nodes = [(int(v) & (1 << 64) - 1, int(m)) if m >= 0 else None
                             for v, m in zip(first["vantage"], first["bound"])]
                    pts = g["fp"].to_numpy(np.int64)
                    rows, paths = route(pts.view(np.uint64), nodes, max_bits)
                    yield pd.DataFrame({"fp": pts[rows], "shard": [f"{shard}/{p}" for p in paths],
                                        "cut": bool(nodes[1])})

        routed = shared_table(
            big_points.select("fp", "shard").join(trees, "shard").mapInPandas(
                send, "fp long, shard string, cut boolean"), "vp-round")
        # a shard whose root has no paying cut is final at any size
        done = done.unionByName(routed.where("not cut").select("fp", "shard"))
        open_ = routed.where("cut").select("fp", "shard")


def _forest(points: np.ndarray, left: np.ndarray, right: np.ndarray, max_bits: int) -> list:
    """Spanning forest of the links between ``points[left]`` and
    ``points[right]``; both are index arrays."""
    label = np.arange(len(points))
    edges = []
    rp = points[right]
    for s in range(0, len(left), 256):
        rows = left[s:s + 256]
        near = np.bitwise_count(points[rows][:, None] ^ rp[None, :]) <= max_bits
        for k, i in enumerate(rows):
            js = right[near[k]]
            of = label[js]
            other = np.flatnonzero(of != label[i])
            for old, first in zip(*np.unique(of[other], return_index=True)):
                edges.append((i, js[other[first]]))
                label[label == old] = label[i]
    return edges


def shard_links(shards: DataFrame, max_bits: int, block_rows: int = 4096) -> DataFrame:
    """(u, v): fingerprints within ``max_bits`` of each other, as one spanning
    forest per shard or, for shards over ``block_rows``, per pair of blocks."""
    sizes = shards.groupBy("shard").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("blocks"))
    dealt = (shards.join(sizes, "shard")
             .withColumn("own", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("shard", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                     "own", "fp"))

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        pts = pdf["fp"].to_numpy(np.int64)
        own, lo, hi = pdf["own"].to_numpy(), pdf["lo"].iloc[0], pdf["hi"].iloc[0]
        left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        e = np.array(_forest(pts.view(np.uint64), left, right, max_bits), dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"u": pts[e[:, 0]], "v": pts[e[:, 1]]})

    return dealt.groupBy("shard", "lo", "hi").applyInPandas(links, "u long, v long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, max_bits: int = 2, shard_rows: int = 4096) -> DataFrame:
    """(id_col, fp, component_id) for every input row.

    Two rows are linked when their fingerprints differ in at most ``max_bits``
    bits; ``component_id`` is the smallest id reachable, the row's own
    included.  Null, empty and wordless texts share fingerprint 0 and are
    linked like any other.  A null id never names a component; if all ids of
    a component are null so is the component.  Repeated rows are kept.  An
    empty table gives an empty result; other columns are not touched.
    """
    fps = shared_table(fingerprints(docs, id_col, text_col, shingle)
                       .select(F.col(id_col).alias("id"), "fp"), "simhash")
    points = shared_table(fps.groupBy("fp").agg(F.min("id").alias("low")), "fps")
    shards = shared_table(vp_shards(points, max_bits, shard_rows), "vp-shards")
    comp = connected_components(shard_links(shards, max_bits, shard_rows))
    named = (points.join(comp, points.fp == comp.node, "left")
             .select("fp", "low", F.coalesce("component", "fp").alias("c")))
    low = named.groupBy("c").agg(F.min("low").alias("component_id"))
    of_fp = named.join(low, "c").select("fp", "component_id")
    return (fps.join(of_fp, "fp")
            .select(F.col("id").alias(id_col), "fp", "component_id"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The input rows (all columns) whose id is the smallest of its group.

    Rows with a null id, which nothing can name, stay when their group has no
    row with an id.  Rows that share the kept id are one document: repeats are
    reduced to one row, and each of its different texts stays.
    """
    c = shared_table(simhash_components(docs, id_col, text_col, shingle, max_bits), "simhash-groups")
    [name] = fresh(docs, "keep")
    keep = (c.where(F.col("component_id").eqNullSafe(F.col(id_col)))
            .select(F.col(id_col).alias(name)).distinct())
    kept = docs.join(keep, F.col(id_col).eqNullSafe(F.col(name)), "left_semi")
    ids = c.where(F.col(id_col).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(id_col).alias("d")).first()
    if ids["n"] == ids["d"]:
        return kept
    named = kept.where(F.col(id_col).isNotNull())
    return (named.dropDuplicates([id_col, text_col])
            .unionByName(kept.where(F.col(id_col).isNull())))
