"""Brute-force checks for segmentation, MMR, hierarchy and silhouettes."""
import math
import random

import numpy as np
from pyspark.sql import functions as F

from feedlens.operators import cluster as CL
from feedlens.operators import keywords as KW
from feedlens.operators import phrases as PH


def _greedy(tokens, lex):
    out, i = [], 0
    while i < len(tokens):
        if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) in lex:
            out.append(tokens[i] + "_" + tokens[i + 1])
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return " ".join(out)


def test_segment_greedy(spark):
    lex = {("a", "b"), ("b", "c"), ("c", "d"), ("x", "y")}
    texts = ["a b c d e", "a b b c", "x y x y x", "q", "", "b c d a b c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, clean string")
    lx = spark.createDataFrame(sorted(lex), "a string, b string")
    got = {r.doc_id: r.clean for r in PH.segment_words(df, lx).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _greedy(t.split(), lex), (t, got[i])


def test_learn_phrases_formula(spark):
    docs = ["new york is big", "new york city", "i love new york", "york new"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, clean string")
    got = {(r.a, r.b): r.score for r in PH.learn_phrases(df, 2, 1.0, 0.0).collect()}
    toks = [d.split() for d in docs]
    n = sum(len(t) for t in toks)
    uni = {}
    for t in toks:
        for w in t:
            uni[w] = uni.get(w, 0) + 1
    assert math.isclose(got[("new", "york")], (3 - 1.0) * n / (uni["new"] * uni["york"]))
    assert set(got) == {("new", "york")}


def test_mmr_matches_numpy(spark):
    rnd = np.random.default_rng(1)
    words = [f"w{i:02d}" for i in range(12)]
    wv = {w: rnd.normal(size=4).tolist() for w in words}
    tvec = rnd.normal(size=4).tolist()
    cands = spark.createDataFrame([(0, w) for w in words], "topic int, word string")
    wdf = spark.createDataFrame([(w, v) for w, v in wv.items()], "word string, vec array<double>")
    tdf = spark.createDataFrame([(0, tvec)], "topic int, vec array<double>")
    got = [r.word for r in sorted(KW.mmr_keywords(cands, tdf, wdf, 0.3, 5).collect(), key=lambda r: r.rank)]
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    want = [max(words, key=lambda w: cos(wv[w], tvec))]
    while len(want) < 5:  # the definition: relevance against the closest word chosen so far
        want.append(max((w for w in words if w not in want),
                        key=lambda w: 0.7 * cos(wv[w], tvec) - 0.3 * max(cos(wv[w], wv[c]) for c in want)))
    assert got == want


def test_hierarchy_leaves_are_disjoint_and_large(spark):
    rnd = random.Random(11)
    pts = []
    centers = [(0, 0), (0.6, 0), (5, 5)]   # two close blobs and one far blob
    for c, (x, y) in enumerate(centers):
        for i in range(25):
            pts.append((len(pts), [x + rnd.gauss(0, 0.08), y + rnd.gauss(0, 0.08)]))
    df = spark.createDataFrame(pts, "doc_id long, vec array<double>")
    out = CL.density_cluster_tree(df, 5, 3).collect()
    labels = {r.doc_id: r.cluster for r in out}
    clusters = {}
    for i, c in labels.items():
        if c != -1:
            clusters.setdefault(c, set()).add(i)
    assert all(len(m) >= 5 for m in clusters.values())
    # leaf selection separates the two close blobs and the far one
    blob_of = {i: i // 25 for i in range(75)}
    assert len(clusters) >= 3
    for m in clusters.values():
        assert len({blob_of[i] for i in m}) == 1


def _silhouette(points, labels):
    n = len(points)
    out = []
    for i in range(n):
        own = [j for j in range(n) if labels[j] == labels[i] and j != i]
        if not own:
            out.append(0.0)
            continue
        d = lambda j: math.dist(points[i], points[j])
        a = sum(d(j) for j in own) / len(own)
        b = min(sum(d(j) for j in range(n) if labels[j] == lab) / sum(1 for j in range(n) if labels[j] == lab)
                for lab in set(labels) if lab != labels[i])
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return sum(out) / n


def test_silhouette_brute_force(spark):
    rnd = random.Random(2)
    pts = [[rnd.random(), rnd.random(), rnd.random()] for _ in range(40)]
    labs = [i % 3 if i < 39 else 7 for i in range(40)]   # label 7 is a singleton
    v = spark.createDataFrame([(i, p) for i, p in enumerate(pts)], "doc_id long, vec array<double>")
    t = spark.createDataFrame([(i, l) for i, l in enumerate(labs)], "doc_id long, topic int")
    got = CL.silhouette(v, t, 3).first()[0]
    assert math.isclose(got, _silhouette(pts, labs), rel_tol=1e-9)
    one = spark.createDataFrame([(i, 0) for i in range(40)], "doc_id long, topic int")
    assert CL.silhouette(v, one, 3).first()[0] is None


def test_fuzzy_graph_brute_force(spark):
    from feedlens.operators import neighbors as NB
    rnd = random.Random(4)
    pts = [(i, [rnd.random(), rnd.random()]) for i in range(30)]
    df = spark.createDataFrame(pts, "doc_id long, vec array<double>")
    k = 4
    got = {(r.src, r.dst): r.weight for r in NB.fuzzy_graph(NB.knn(df, k, 2)).collect()}
    P = np.array([p for _, p in pts])
    w = {}
    for i in range(len(P)):
        d = np.sqrt(((P - P[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        nn = np.argsort(d, kind="stable")[:k]
        rho = d[nn[0]]
        lo, hi = 0.0, np.inf
        mid = 1.0
        for _ in range(64):
            s = np.exp(-np.maximum(d[nn] - rho, 0) / mid).sum()
            if s > math.log2(k):
                hi = mid
            else:
                lo = mid
            mid = mid * 2 if hi == np.inf else (lo + hi) / 2
        for j in nn:
            w[(i, int(j))] = math.exp(-max(d[j] - rho, 0) / mid)
    want = {}
    for (i, j), x in w.items():
        a, b = min(i, j), max(i, j)
        y = w.get((j, i), 0.0)
        want[(a, b)] = x + y - x * y
    assert set(got) == set(want)
    for key, val in want.items():
        assert math.isclose(got[key], val, rel_tol=1e-6, abs_tol=1e-9)


def test_hierarchy_eom_prefers_stable_parent(spark):
    rnd = random.Random(11)
    pts = []
    for c, (x, y) in enumerate([(0, 0), (0.6, 0), (5, 5)]):
        for i in range(25):
            pts.append((len(pts), [x + rnd.gauss(0, 0.08), y + rnd.gauss(0, 0.08)]))
    df = spark.createDataFrame(pts, "doc_id long, vec array<double>")
    out = CL.density_cluster_tree(df, 5, 3, method="eom").collect()
    clusters = {}
    for r in out:
        if r.cluster != -1:
            clusters.setdefault(r.cluster, set()).add(r.doc_id)
    assert clusters and all(len(m) >= 5 for m in clusters.values())
    ids = [i for m in clusters.values() for i in m]
    assert len(ids) == len(set(ids))          # disjoint
    # the far blob is never merged with the two close ones
    for m in clusters.values():
        assert not ({i // 25 for i in m} >= {0, 2}) and not ({i // 25 for i in m} >= {1, 2})
