"""Repeated byte windows by a depth-limited radix sort (operator 10).

A window is ``length`` bytes; it is repeated if the same bytes start at any
other place.  Suffixes are ordered only as deep as that, by passes from the
most significant digit, and a group of one leaves after every pass.

* Anchors.  Every window contains one anchor: of the ``digit``-byte strings
  inside it, the leftmost with the smallest hash.  Equal windows have equal
  anchors at equal offsets, so only the suffixes at anchors (about one in 70
  bytes) need sorting; an anchor owns the run of windows that chose it.
* First pass: the ``digit`` bytes at the anchor.  Anchors met once leave.
* Second pass: the whole stretch of an anchor's windows.  Where it is met
  again at the same offset, all those windows are repeated.
* Last pass: for the anchors left, each of their windows by its bytes.  Equal
  groups are exactly the repeated windows.

A digit is compared as a hash of its bytes: 64 bits in the first pass, which
only selects; 128 in the two passes that decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.llm.common import semi_join_small, shared_table, text_rows

BASE = 0x9E3779B97F4A7C15
CHUNK = 1 << 18  # bytes of a text hashed together
LOCAL = (1 << 24) - 1
_POWERS: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        for name, b in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.full(CHUNK + 1024, np.uint64(b))
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` neighbours, from block prefix and suffix minima."""
    p = np.concatenate([v, np.full(-len(v) % w, np.uint64((1 << 64) - 1))]).reshape(-1, w)
    before = np.minimum.accumulate(p, axis=1).ravel()
    after = np.minimum.accumulate(p[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:len(v) - w + 1], before[w - 1:len(v)])


def anchors(data: bytes, length: int, digit: int) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window, hash of the anchor's digit) of all
    windows of one text, in order.  Long texts are hashed in overlapping
    chunks, so an anchor may come twice with neighbouring runs."""
    up, down = _powers()
    out = []
    for at in range(0, max(0, len(data) - length + 1), CHUNK):
        part = np.frombuffer(data[at:at + CHUNK + length - 1], np.uint8)
        n = len(part)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:n], out=prefix[1:])
        h = _mix((prefix[digit:] - prefix[:-digit]) * down[:n - digit + 1])
        places = np.arange(len(h), dtype=np.uint64)
        low = _sliding_min((h & ~np.uint64(LOCAL)) | places, length - digit + 1)
        of = (low & np.uint64(LOCAL)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        last = np.concatenate([first[1:], [len(of)]]) - 1
        out.append((of[first] + at, first + at, last + at, h[of[first]]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _anchor_rows(src: DataFrame, length: int, digit: int) -> DataFrame:
    """(k, a, first, last, h, f): a document's key, an anchor's place, the
    offsets back to its first and last window, the hash of its digit, and the
    hash of the stretch that its windows cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = []
            for k, t in zip(b.column("k").to_pylist(), b.column("t").to_pylist()):
                data = _bytes(t)
                a, s, e, h = anchors(data, length, digit)
                if len(a):
                    f = np.fromiter((xxhash.xxh3_64_intdigest(data[i:j + length], p - i)
                                     for p, i, j in zip(a.tolist(), s.tolist(), e.tolist())), np.uint64, len(a))
                    parts.append((np.full(len(a), k, np.int64), a, a - s, a - e, h, f))
            if parts:
                k, a, s, e, h, f = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k), pa.array(a.astype(np.int32)), pa.array(s.astype(np.int16)),
                     pa.array(e.astype(np.int16)), _signed(h), _signed(f)],
                    ["k", "a", "first", "last", "h", "f"])

    return src.mapInArrow(run, "k long, a int, first smallint, last smallint, h long, f long")


def _window_digests(pdf: pd.DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, digest) of every window of every stretch in ``pdf``."""
    rows, found = [], []
    digest = xxhash.xxh3_128_digest
    for i, s in enumerate(pdf["stretch"]):
        n = len(s) - length + 1
        rows.append(np.full(n, i))
        found += [digest(s[p:p + length]) for p in range(n)]
    return np.concatenate(rows), np.array(found, dtype="V16")


def _runs(pdf: pd.DataFrame, row: np.ndarray, repeated: np.ndarray, length: int) -> pd.DataFrame:
    """Byte spans (k, start, stop) of the repeated windows of the open rows."""
    n = np.bincount(row, minlength=len(pdf))
    place = np.arange(len(row)) - (np.cumsum(n) - n)[row]
    at = np.flatnonzero(repeated & pdf["open"].to_numpy(bool)[row])
    if not len(at):
        return pd.DataFrame({"k": [], "start": [], "stop": []}).astype({"k": "int64", "start": "int32", "stop": "int32"})
    begin = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(row[at]) > 0)])
    first = at[begin]
    last = at[np.concatenate([np.flatnonzero(begin)[1:], [len(at)]]) - 1]
    base = pdf["w"].to_numpy(np.int64)[row[first]]
    return pd.DataFrame({"k": pdf["k"].to_numpy(np.int64)[row[first]],
                         "start": (base + place[first]).astype(np.int32),
                         "stop": (base + place[last] + length).astype(np.int32)})


def repeated_spans(src: DataFrame, length: int = 200, digit: int = 32, bucket_rows: int = 8192) -> DataFrame:
    """(k, start, stop) byte spans covered by repeated windows, from (k, t);
    spans of one text may overlap."""
    found = shared_table(_anchor_rows(src, length, digit), "anchors")
    # first digit
    again = found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    left = shared_table(found.join(again, "h"), "anchors-repeated")
    # second digit: whole stretches
    whole = (left.groupBy("h", "f").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "a", "first", "last")).alias("one"))
             .where("n > 1"))
    lead = F.struct("k", "a", "first", "last")
    marked = shared_table(left.join(whole.select("h", "f", "one"), ["h", "f"], "left").select(
        "k", "a", "first", "last", "h", F.col("one").isNotNull().alias("closed"),
        F.coalesce(F.col("one") == lead, F.lit(False)).alias("lead")), "anchors-marked")
    closed = (marked.where("closed")
              .select("k", (F.col("a") - F.col("first")).alias("start"),
                      (F.col("a") - F.col("last") + F.lit(length)).alias("stop")))
    # last digit: windows of the rest, beside one of each closed group they may meet
    rest = marked.where("not closed").select("k", "a", "first", "last", "h", F.lit(True).alias("open"))
    sizes = rest.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    met = (marked.where("lead")
           .join(sizes, "h", "left_semi")
           .select("k", "a", "first", "last", "h", F.lit(False).alias("open")).distinct())
    places = shared_table(rest.unionByName(met), "anchors-open")
    total = places.count()
    buckets = max(1, -(-total // bucket_rows))
    hot = places.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows).select(
        "h", F.lit(True).alias("hot"))
    of_text = places.join(hot, "h", "left").groupBy("k").agg(F.collect_list(F.struct(
        "a", "first", "last", "h", "open", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("at"))
    texts = semi_join_small(src, of_text.select("k"), "k")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, t, at in zip(b["k"], b["t"], b["at"]):
                data = _bytes(t)
                for x in at:
                    w = x["a"] - x["first"]
                    out.append((k, w, x["h"], x["open"], x["hot"], data[w:x["a"] - x["last"] + length]))
                    if len(out) >= 20_000:
                        yield pd.DataFrame(out, columns=["k", "w", "h", "open", "hot", "stretch"])
                        out = []
            if out:
                yield pd.DataFrame(out, columns=["k", "w", "h", "open", "hot", "stretch"])

    stretches = shared_table(texts.join(of_text, "k").mapInPandas(
        cut, "k long, w int, h long, open boolean, hot boolean, stretch binary"), "stretches")

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        row, digest = _window_digests(pdf, length)
        _, which, n = np.unique(digest, return_inverse=True, return_counts=True)
        return _runs(pdf, row, n[which] > 1, length)

    spans = "k long, start int, stop int"
    usual = (stretches.where("not hot").withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
             .groupBy("bucket").applyInPandas(settle, spans))

    # an anchor met too often for one task: its windows are rows, counted by Spark
    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for s in range(0, len(b), 256):
                part = b.iloc[s:s + 256].reset_index(drop=True)
                row, digest = _window_digests(part, length)
                place = np.arange(len(row)) - np.flatnonzero(np.diff(row, prepend=-1))[row]
                two = digest.view("<i8").reshape(-1, 2)
                yield pd.DataFrame({"k": part["k"].to_numpy()[row], "start": part["w"].to_numpy()[row] + place,
                                    "open": part["open"].to_numpy()[row], "d1": two[:, 0], "d2": two[:, 1]})

    rows = stretches.where("hot").mapInPandas(windows, "k long, start int, open boolean, d1 long, d2 long")
    twice = rows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d1", "d2")
    frequent = (rows.where("open").join(twice, ["d1", "d2"], "left_semi")
                .select("k", "start", (F.col("start") + length).alias("stop")))
    return closed.unionByName(usual).unionByName(frequent)


def _merge(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of sorted (start, stop) spans."""
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    first = np.flatnonzero(new)
    return np.column_stack([spans[first, 0], reach[np.concatenate([first[1:], [len(spans)]]) - 1]])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                 digit: int = 32) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept): every whole text as UTF-8
    without the bytes covered by a ``length``-byte string that also starts
    anywhere else.  ``kept`` is binary, since a cut may fall inside a character.

    Null texts are empty; empty and short ones lose nothing.  Repeated rows are
    two places each, so a long one loses everything.  Rows with the same id
    and different texts, or a null id, are texts of their own (a text's key is
    the 64-bit hash of id and text).  An empty table gives an empty result;
    other columns are not read.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).withColumn(
        "k", F.xxhash64(F.col("id"), F.coalesce("t", F.lit(""))))
    spans = shared_table(repeated_spans(text_rows(src.select("k", "t")), length, digit), "spans")
    of_text = spans.groupBy("k").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    kind = src.schema["id"].dataType.simpleString()
    joined = src.join(of_text, "k", "left").select("id", "t", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for t, found in zip(b.column("t").to_pylist(), b.column("spans").to_pylist()):
                data = _bytes(t)
                cut = _merge(np.array([(x["start"], x["stop"]) for x in found])) if found else np.zeros((0, 2), int)
                edges = [0, *cut.ravel().tolist(), len(data)]
                for into, v in zip(out, (len(data), int((cut[:, 1] - cut[:, 0]).sum()), len(cut),
                                         b"".join(data[i:j] for i, j in zip(edges[::2], edges[1::2])))):
                    into.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.binary())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return (joined.mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
            .withColumnRenamed("id", id_col))
