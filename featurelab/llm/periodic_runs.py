"""Periodic runs of words by descending-LCP Kruskal (operator 13).

A run is a stretch of words of smallest period q that no neighbour extends.
Positions a period apart share a long common prefix, so runs are read off the
suffix order of a text: its suffix classes are united in descending order of
their common prefix, each class an ordered set of positions, and two positions
that become neighbours in a set at a distance within that prefix seed a run.
Neighbours have nothing of their class between them, which makes the distance
the smallest period (a smaller one would put a position between).

All texts of a batch are worked at once: classes of 1, 2, 4, ... words come
from numpy sorts over the batch, and only positions whose 16-word window
occurs twice in their text go on, for a run of at least 24 words and three
periods is a prefix of at least 16 words shared by two suffixes.
"""

from __future__ import annotations

from bisect import insort, bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.llm.common import text_rows

BATCH_WORDS = 500_000


def least_prefix(min_words: int, min_periods: int) -> int:
    """The least LCP of two suffixes one period apart at the start of a run:
    its length less q, over all q with length >= max(min_words, min_periods * q)."""
    return min(max(min_words - q, (min_periods - 1) * q) for q in range(1, min_words + 1))


def refine(rank: np.ndarray, act: np.ndarray, end: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(rank, act) for windows of 2 * step words from those of ``step``.

    ``rank`` is the place of a position's class in suffix order (that of its
    first member), so ranks stay in order as classes split; ``act`` are the
    positions whose class has others.  Their windows lie inside their text,
    which ends at ``end``; one that ends there comes first, alone.
    """
    follow = np.where(act + step < end[act], rank[np.minimum(act + step, len(rank) - 1)], -1)
    order = np.lexsort((follow, rank[act]))
    act, follow = act[order], follow[order]
    old = rank[act]
    head = np.ones(len(act), dtype=bool)
    head[1:] = old[1:] != old[:-1]
    new = head.copy()
    new[1:] |= follow[1:] != follow[:-1]
    i = np.arange(len(act))
    start_old = np.maximum.accumulate(np.where(head, i, 0))
    start_new = np.maximum.accumulate(np.where(new, i, 0))
    rank = rank.copy()
    rank[act] = old + (start_new - start_old)
    return rank, act[_shared(new)]


def _shared(new: np.ndarray) -> np.ndarray:
    """Which members of a list of classes, each begun by a ``new`` mark, are not alone."""
    alone = new.copy()
    alone[:-1] &= new[1:]
    return ~alone


def suffix_links(doc: np.ndarray, word: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, position, LCP) of suffixes that are neighbours in suffix
    order, of the same text and with an LCP of at least ``least`` words."""
    n = len(doc)
    end = np.searchsorted(doc, doc, side="right").astype(np.int32)
    order = np.lexsort((word, doc))
    new = np.ones(n, dtype=bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (word[order][1:] != word[order][:-1])
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    act = order[_shared(new)]
    levels, step, kept = [rank], 1, act
    while len(act):
        rank, act = refine(rank, act, end, step)
        levels.append(rank)
        step *= 2
        if step <= least:
            kept = act
    pos = kept[np.argsort(rank[kept])]
    p, q = pos[:-1], pos[1:]
    lcp = np.zeros(len(p), dtype=np.int64)
    for i in range(len(levels) - 1, -1, -1):
        a, b = p + lcp, q + lcp
        inside = np.maximum(a, b) < n
        same = inside.copy()
        same[inside] = levels[i][a[inside]] == levels[i][b[inside]]
        lcp[same] += 1 << i
    far = lcp >= least
    return p[far], q[far], lcp[far]


def seeds(p: np.ndarray, q: np.ndarray, lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(i, j, LCP), i < j, of positions that become neighbours in a united set
    at a distance within the LCP: Kruskal over the links by descending LCP."""
    order = np.argsort(-lcp, kind="stable")
    home: dict[int, int] = {}
    sets: dict[int, list[int]] = {}
    near: list[tuple[int, int, int]] = []

    def root(x: int) -> int:
        r = home.setdefault(x, x)
        if r == x and x not in sets:
            sets[x] = [x]
        while home[r] != r:
            r = home[r]
        while home[x] != r:
            home[x], x = r, home[x]
        return r

    for a, b, n in zip(p[order].tolist(), q[order].tolist(), lcp[order].tolist()):
        a, b = root(a), root(b)
        if a == b:
            continue
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        big, small = sets[a], sets.pop(b)
        home[b] = a
        if small[0] > big[-1]:
            if small[0] - big[-1] <= n:
                near.append((big[-1], small[0], n))
            big.extend(small)
        elif small[-1] < big[0]:
            if big[0] - small[-1] <= n:
                near.append((small[-1], big[0], n))
            big[:0] = small
        else:
            for x in small:
                insort(big, x)
            own = set(small)
            for x in small:
                i = bisect_left(big, x)
                if i and x - big[i - 1] <= n and big[i - 1] not in own:
                    near.append((big[i - 1], x, n))
                if i + 1 < len(big) and big[i + 1] - x <= n and big[i + 1] not in own:
                    near.append((x, big[i + 1], n))
        yield from near
        near.clear()


def find_runs(doc: np.ndarray, word: np.ndarray, min_words: int, min_periods: int) -> np.ndarray:
    """Rows (start, length, period) by start and period over the concatenated
    words of a batch; ``doc`` numbers the texts, ``word`` the words."""
    found = np.array(list(seeds(*suffix_links(doc, word, least_prefix(min_words, min_periods)))), dtype=np.int64).reshape(-1, 3)
    i, j, n = found.T
    q = j - i
    # the run starts at i: the words before i and j differ, or i begins its text
    first = (i == 0) | (doc[i - 1] != doc[i]) | (word[i - 1] != word[j - 1])
    size = q + n
    keep = first & (size >= np.maximum(min_words, min_periods * q))
    out = np.unique(np.stack([i[keep], q[keep], size[keep]], axis=1), axis=0)
    return out[:, [0, 2, 1]]


def text_runs(texts: list[str | None], min_words: int, min_periods: int) -> list[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(words, runs with starts counted in the text, kept words' mask) of each
    text of a batch."""
    words = [t.encode().split() if t else [] for t in texts]  # splits at the six ASCII white-space characters
    size = np.array([len(w) for w in words], dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(size)])
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    flat = pa.array([x for w in words for x in w], pa.binary()).dictionary_encode()
    word = flat.indices.to_numpy(zero_copy_only=False)
    runs = find_runs(doc, word, min_words, min_periods)
    cover = np.zeros(len(doc) + 1, dtype=np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(cover)[:-1] == 0
    cut = np.searchsorted(runs[:, 0], start)
    out = []
    for k, w in enumerate(words):
        mine = runs[cut[k]:cut[k + 1]].copy()
        mine[:, 0] -= start[k]
        out.append((w, mine, kept[start[k]:start[k + 1]]))
    return out


def batches_of_words(texts: list[str | None], limit: int) -> Iterator[slice]:
    """Slices of texts that hold about ``limit`` words together; a longer text
    is a batch of its own."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) // 6 if t else 0
        if held and held + n > limit:
            yield slice(at, i)
            at, held = i, 0
        held += n
    if at < len(texts):
        yield slice(at, len(texts))


def collapse_runs(docs: DataFrame, text_col: str = "text", min_words: int = 24, min_periods: int = 3,
                  batch_words: int = BATCH_WORDS) -> DataFrame:
    """``docs`` with n_words, runs (array of start, length, period by start and
    period, in words from 0) and collapsed (the text's words without those that
    a run holds after its first period, joined by single spaces) added.

    Words are stretches without ASCII white space.  A null, empty or blank text
    has no words, no runs and an empty collapsed text.  Overlapping runs are
    all listed and a word goes if any of them drops it.  Repeated rows are each
    answered; an empty table gives an empty result; the input's own columns of
    the added names are replaced.  A very long text is worked whole in one
    task, in memory of some 30 integers a word at most.
    """
    added = {"n_words", "runs", "collapsed"}
    src = text_rows(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added or c == text_col]))
    keep = [f for f in src.schema.fields if f.name.lower() not in added]
    out_type = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keep] + [
        "n_words long", "runs array<struct<start:long,length:long,period:long>>", "collapsed string"])
    at = src.columns.index(text_col)
    kept_at = [src.columns.index(f.name) for f in keep]
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            for s in batches_of_words(texts, batch_words):
                found = text_runs(texts[s], min_words, min_periods)
                part = b.slice(s.start, s.stop - s.start)
                collapsed = [b" ".join(w if m.all() else [x for x, k in zip(w, m.tolist()) if k]).decode() for w, _, m in found]
                runs = [[dict(zip(("start", "length", "period"), r)) for r in rs.tolist()] for _, rs, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in kept_at] + [pa.array([len(w) for w, _, _ in found], pa.int64()),
                                                         pa.array(runs, run_type), pa.array(collapsed, pa.string())],
                    [f.name for f in keep] + ["n_words", "runs", "collapsed"])

    return src.mapInArrow(run, out_type)
