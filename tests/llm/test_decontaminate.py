"""BM25 retrieval against full scoring, planted items, odd rows."""

import random
from collections import Counter

import numpy as np
import pytest

from featurelab.llm import decontaminate as D

SF = "/root/testdata/sf0.01"


def small_benchmark(seed, n=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    say = lambda k: " ".join(rng.choice(vocab[:40] if rng.random() < 0.4 else vocab) for _ in range(k))
    return [(i, say(rng.randint(6, 30)) + ("\n" + say(rng.randint(3, 12)) if i % 2 else "")) for i in range(n)], say


def index_of(items):
    df = Counter(w for _, t in items for w in set(D.words_of(t)))
    lens = [len(D.words_of(t)) for _, t in items]
    return D.build_index(items, df, len(items), sum(lens) / len(lens), max(lens)), df, lens


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.5])
def test_wand_finds_what_full_scoring_finds(threshold):
    items, say = small_benchmark(1)
    index, df, lens = index_of(items)
    impact = {}
    mean = sum(lens) / len(lens)
    for (i, t), n in zip(items, lens):
        tf = Counter(D.words_of(t))
        w = {x: np.log1p((len(items) - df[x] + 0.5) / (df[x] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * n / mean))
             for x, c in tf.items()}
        impact[i] = {x: v / sum(w.values()) for x, v in w.items()}
    passages = [D.words_of(say(50)) for _ in range(80)]
    pairs = sorted({(p, index.term[w]) for p, ws in enumerate(passages) for w in ws if w in index.term})
    p, t = np.array(pairs).T
    got = {(a, index.items[b]): s for a, b, s in zip(*D.wand(index, p, t, len(passages), threshold))}
    want = {(a, i): sum(impact[i].get(w, 0) for w in set(ws)) for a, ws in enumerate(passages) for i in impact}
    want = {k: v for k, v in want.items() if v >= threshold - 1e-9}
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k]) for k in want)
    assert threshold > 0.1 or want


def brute(texts, items, min_overlap=0.8, min_part=0.5):
    """Items whose shingles lie in the document, whatever their score."""
    out = set()
    for d, text in texts:
        words = D.words_of(text)
        for i, t in items:
            q, _, a = t.partition("\n")
            held = []
            for part in (D.words_of(q), D.words_of(a)):
                n = min(5, len(part))
                grams = {" ".join(part[k:k + n]) for k in range(len(part) - n + 1)} if n else set()
                seen = {" ".join(words[k:k + n]) for k in range(len(words) - n + 1)} if n else set()
                held.append((len(grams & seen), len(grams)))
            both = sum(n for _, n in held)
            if both and sum(x for x, _ in held) / both >= min_overlap and all(x >= min_part * n for x, n in held):
                out.add((d, i))
    return out


def test_documents_match_brute_force(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, bench).collect()}
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert got == want and got
    parts = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, bench, part_bytes=2000).collect()}
    assert parts == want
    kept = D.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in want}


def test_planted_anywhere_in_long_texts(spark):
    items, say = small_benchmark(2)
    rng = random.Random(3)
    texts = []
    for d in range(30):
        words = say(rng.randint(0, 400)).split(" ")
        at = rng.randint(0, len(words))
        item = items[d][1].replace("\n", rng.choice(["\n", " ", ". "])).title()
        texts.append((d, " ".join(words[:at]) + " " + item + " " + " ".join(words[at:])))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, bench).collect()}
    assert {(d, d) for d in range(30)} <= got == brute(texts, items)


def test_odd_rows(spark):
    item = "what is the name of the river here\nit is the long one"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "..."), (None, item), (5, item), (6, "short one")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, f"so {item} yes", "x"), (3, f"a {item}", "x"),
                                  (3, f"a {item}", "x"), (4, "nothing of it " * 30_000, "x"), (7, "one short", "x")],
                                 "doc_id long, text string, item_id string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, bench).collect()), key=str)
    assert got == sorted([(None, 1), (None, 5), (3, 1), (3, 1), (3, 5), (3, 5)], key=str)
    assert D.find_leaks(docs.limit(0), bench).collect() == []
    assert D.find_leaks(docs, bench.limit(0)).collect() == []
    assert D.drop_leaks(docs, bench.limit(0)).count() == 7
    assert sorted(r["doc_id"] for r in D.drop_leaks(docs, bench).collect()) == [1, 2, 4, 7]


def test_benchmark_partitions_without_words(spark):
    bench = spark.createDataFrame([(1, "..."), (2, "!"), (3, "")], "item_id long, text string").repartition(3)
    docs = spark.createDataFrame([(1, "some text of five words"), (2, None)], "doc_id long, text string")
    assert D.find_leaks(docs, bench).collect() == [] and D.drop_leaks(docs, bench).count() == 2
