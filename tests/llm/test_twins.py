"""Plain twins of the two learned operators: the whole training and every
prediction again, one value at a time, against the queries' rows."""

import math
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from featurelab.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def crc(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod


# ---- operator 5 ---------------------------------------------------------------

def grams(text):
    """Bucket of every 2- to 4-byte n-gram of the lower-cased text."""
    data = text.lower().encode()
    for n in (2, 3, 4):
        for i in range(len(data) - n + 1):
            yield ((int.from_bytes(data[i:i + n], "big") + n) % 2**32 * 2654435761 % 2**32) >> 17


def letters(text):
    return any(c.isalpha() for c in text or "")


def test_language_twin(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    train = [d for d in docs if crc(d["doc_id"], 4) != 2 and d["lang"] is not None and letters(d["text"])]
    langs = sorted({d["lang"] for d in train})
    k, buckets = len(langs), 1 << 15
    counts = {x: Counter() for x in langs}
    for d in train:
        counts[d["lang"]].update(grams(d["text"]))
    # every split of the languages into two sides, the last language's side first
    code = [[1 if (b >> i) & 1 else -1 for b in range(1, 1 << (k - 1))] for i in range(k)]
    bits, alpha = len(code[0]), 0.5 / buckets
    rate = {x: {g: n / sum(c.values()) for g, n in c.items()} for x, c in counts.items()}

    def weight(g, b):
        up = [rate[x].get(g, 0.0) for i, x in enumerate(langs) if code[i][b] > 0]
        down = [rate[x].get(g, 0.0) for i, x in enumerate(langs) if code[i][b] < 0]
        return math.log(sum(up) / len(up) + alpha) - math.log(sum(down) / len(down) + alpha)

    known = {}

    def margins(text):
        total, n = [0.0] * bits, 0
        for g, c in Counter(grams(text)).items():
            if g not in known:
                known[g] = [weight(g, b) for b in range(bits)]
            n += c
            for b in range(bits):
                total[b] += c * known[g][b]
        return [t / max(1, n) for t in total]

    right, seen = [[0] * bits for _ in langs], [0] * k
    for d in train:
        i = langs.index(d["lang"])
        seen[i] += 1
        for b, m in enumerate(margins(d["text"])):
            right[i][b] += m * code[i][b] > 0
    trust = [[(r + 1) / (seen[i] + 2) for r in right[i]] for i in range(k)]
    trust = [[t / sum(row) for t in row] for row in trust]
    got = {r["doc_id"]: r for r in QUERIES["op5_language_id"](spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r = got[d["doc_id"]]
        assert r["held_out"] == (crc(d["doc_id"], 4) == 2)
        if not letters(d["text"]):
            assert (r["lang_pred"], r["score"], r["ambiguous"]) == ("und", 0.0, True)
            continue
        m = margins(d["text"])
        loss = [sum(trust[i][b] * math.log1p(math.exp(-8.0 * code[i][b] * m[b])) for b in range(bits)) for i in range(k)]
        p = [math.exp(min(loss) - x) for x in loss]
        p = sorted(((x / sum(p), -i) for i, x in enumerate(p)), reverse=True)
        assert r["lang_pred"] == langs[-p[0][1]] and r["score"] == pytest.approx(p[0][0], abs=1e-5)
        if abs(p[0][0] - p[1][0] - 0.15) > 1e-4:
            assert r["ambiguous"] == (p[0][0] - p[1][0] < 0.15)


# ---- operator 7 ---------------------------------------------------------------

def measures(text):
    """The 18 measures, each from its definition."""
    words = (text or "").split()
    if not words:
        return [0.0] * 18
    raw, n = text.encode(), len(words)
    size = len(raw)
    lower = sum(97 <= b <= 122 for b in raw)
    upper = sum(65 <= b <= 90 for b in raw)
    beyond = sum(b >= 128 for b in raw)
    punct = sum(33 <= b <= 126 and not chr(b).isalnum() for b in raw)
    lines = [x for x in text.split("\n") if x.strip()]
    share = [c / size for c in Counter(raw).values()]
    return [math.log1p(n), sum(map(len, words)) / n, len(set(words)) / n, Counter(words).most_common(1)[0][1] / n,
            punct / size, upper / max(1.0, lower + upper + beyond), sum(48 <= b <= 57 for b in raw) / size,
            sum(not any(c.isalnum() for c in w) for w in words) / n, len(set(lines)) / len(lines),
            sum(a == b for a, b in zip(words, words[1:])) / n, sum(len(w) <= 3 for w in words) / n, text.count(".") / n,
            sum(len(w) > 2 and not w[-1].isalnum() and not w[-2].isalnum() for w in words) / n, math.log1p(size / len(lines)),
            len(set(zip(words, words[1:]))) / max(1, n - 1), beyond / size, -sum(p * math.log2(p) for p in share),
            sum(len(w) > 12 for w in words) / n]


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-z))


def best_cuts(g, h):
    """Values per bin of the best two cuts, by trying all of them."""
    best = (-1.0, None)
    for i in range(len(g) - 1):
        for j in range(i, len(g) - 1):
            parts = [(0, i + 1), (i + 1, j + 1), (j + 1, len(g))]
            gain = sum(g[a:b].sum() ** 2 / (h[a:b].sum() + 1.0) for a, b in parts)
            if gain > best[0] + 1e-12:
                best = (gain, parts)
    out = np.zeros(len(g))
    for a, b in best[1]:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def best_quarters(g, h):
    best = (-1.0, None, None)
    for x in range(g.shape[0] - 1):
        for y in range(g.shape[1] - 1):
            quarters = [(slice(0, x + 1), slice(0, y + 1)), (slice(0, x + 1), slice(y + 1, None)),
                        (slice(x + 1, None), slice(0, y + 1)), (slice(x + 1, None), slice(y + 1, None))]
            gain = sum(g[q].sum() ** 2 / (h[q].sum() + 1.0) for q in quarters)
            if gain > best[0] + 1e-12:
                best = (gain, quarters, None)
    out = np.zeros(g.shape)
    for q in best[1]:
        out[q] = g[q].sum() / (h[q].sum() + 1.0)
    return out, best[0]


def test_quality_twin(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if crc(r["doc_id"], 5) != 0}
    every = np.array([measures(t) for _, t in docs])
    # the library sums in the order of ids
    rows = sorted((i, n) for n, (i, _) in enumerate(docs) if labels.get(i) is not None)
    x, y = every[[n for _, n in rows]], np.array([labels[i] for i, _ in rows], dtype=float)
    mean = min(1 - 1e-3, max(1e-3, y.mean()))
    base = math.log(mean / (1 - mean))
    cuts = [[np.unique(np.quantile(x[:, f], np.arange(1, b) / b)) for f in range(18)] for b in (32, 8)]
    place = lambda e, v: int((e <= v).sum())
    bins = [[[place(cuts[c][f], v) for v in x[:, f]] for f in range(18)] for c in (0, 1)]
    z, tables = np.full(len(x), base), [np.zeros(len(e) + 1) for e in cuts[0]]
    for _ in range(150):
        for f in range(18):
            if len(tables[f]) < 2:
                continue
            p = sigmoid(z)
            g, h = np.zeros(len(tables[f])), np.zeros(len(tables[f]))
            for r, b in enumerate(bins[0][f]):
                g[b] += y[r] - p[r]
                h[b] += p[r] * (1 - p[r])
            add = 0.1 * best_cuts(g, h)
            tables[f] += add
            z += add[bins[0][f]]

    def pair_sums(a, b):
        g, h = np.zeros((len(cuts[1][a]) + 1, len(cuts[1][b]) + 1)), np.zeros((len(cuts[1][a]) + 1, len(cuts[1][b]) + 1))
        p = sigmoid(z)
        for r, (i, j) in enumerate(zip(bins[1][a], bins[1][b])):
            g[i, j] += y[r] - p[r]
            h[i, j] += p[r] * (1 - p[r])
        return g, h

    pairs = sorted((-best_quarters(*pair_sums(a, b))[1], a, b) for a, b in combinations(range(18), 2)
                   if len(cuts[1][a]) and len(cuts[1][b]))[:8]
    two = [np.zeros((len(cuts[1][a]) + 1, len(cuts[1][b]) + 1)) for _, a, b in pairs]
    for _ in range(60):
        for t, (_, a, b) in zip(two, pairs):
            add = 0.1 * best_quarters(*pair_sums(a, b))[0]
            t += add
            z += add[bins[1][a], bins[1][b]]
    got = {r["doc_id"]: r for r in QUERIES["op7_quality"](spark, SF).collect()}
    assert len(got) == len(docs)
    for (i, _), v in zip(docs, every):
        s = base + sum(t[place(e, v[f])] for f, (e, t) in enumerate(zip(cuts[0], tables)))
        s += sum(t[place(cuts[1][a], v[a]), place(cuts[1][b], v[b])] for t, (_, a, b) in zip(two, pairs))
        assert got[i]["score"] == pytest.approx(float(sigmoid(s)), abs=1e-6), i
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.3) and got[i]["held_out"] == (crc(i, 5) == 0)
