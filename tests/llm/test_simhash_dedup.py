"""SimHash groups against a brute-force version."""

import numpy as np
import pytest
import xxhash

from featurelab.llm import simhash_dedup as S
from featurelab.llm.components import connected_components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, fp string, id string"


def slow_fingerprint(text, n=3):
    words = [w for w in _split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _split(text):
    word = ""
    for c in text:
        if c in " \t\n\x0b\x0c\r":
            yield word
            word = ""
        else:
            word += c
    yield word


def slow_groups(ids, fps, bits):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    low = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            low[root(i)] = min(ids[i], low.get(root(i), ids[i]))
    return [low.get(root(i)) for i in range(len(ids))]


def test_fingerprints_match_the_definition(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    for t in [*texts, None, "", " \t\n", "One", "a B c", "É É É é", "x y z\x1cw", "a " * 70_000]:
        assert S.simhash64(t) == slow_fingerprint(t), t[:50]


@pytest.mark.parametrize("shard_rows", [4096, 40])
def test_components_match_brute_force(spark, shard_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in S.simhash_components(docs, shard_rows=shard_rows).collect()}
    ids = sorted(got)
    fps = [got[i]["fp"] & (1 << 64) - 1 for i in ids]
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert fps == [slow_fingerprint(text[i]) for i in ids]
    assert [got[i]["component_id"] for i in ids] == slow_groups(ids, fps, 2)


def test_shards_hold_every_near_pair(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 63, 150, dtype=np.uint64))
    dense = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 63, 200, dtype=np.uint64)) ^ (
        np.uint64(1) << rng.integers(0, 63, 200, dtype=np.uint64))
    fps = sorted(set(np.concatenate([base, near, dense]).view(np.int64).tolist()))
    shards = S.vp_shards(spark.createDataFrame([(f,) for f in fps], "fp long"), 2, shard_rows=32, depth=2, sample_rows=64)
    of = {}
    for r in shards.collect():
        of.setdefault(r["fp"], set()).add(r["shard"])
    assert len(set().union(*of.values())) > 4
    u = np.array(fps, dtype=np.int64).view(np.uint64)
    for i, j in zip(*np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= 2)):
        assert of[fps[i]] & of[fps[j]]
    # blocks of a shard that cannot be cut lose no link either
    links = S.shard_links(shards, 2, block_rows=16)
    group = {r["node"]: r["component"] for r in connected_components(links).collect()}
    want = slow_groups(list(range(len(fps))), [f & (1 << 64) - 1 for f in fps], 2)
    got = [group.get(f, f) for f in fps]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_odd_rows_and_columns(spark):
    rows = [(1, None, "x", "y"), (2, "", None, None), (3, " \t", "", ""), (None, "the same text here", "", ""),
            (5, "the same text here", "", ""), (5, "the same text here", "", ""), (7, "quite another line of words", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r["doc_id"], r["component_id"]) for r in S.simhash_components(df).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (3, 1), (None, 5), (5, 5), (5, 5), (7, 7)], key=str)
    kept = S.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 5, 7]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert S.simhash_components(empty).collect() == []
    assert S.keep_one_per_group(empty).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(3, 3), (8, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 40)}}
