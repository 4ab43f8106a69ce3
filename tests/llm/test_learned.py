"""Language identification and toxicity: algorithms by brute force, held-out accuracy on the tables."""
import itertools
import math
import random

import numpy as np
import public_tokenizers as P
import pytest

from feedlens.llm import language_id as G
from feedlens.llm import toxicity as T
from feedlens.llm.queries import QUERIES
from feedlens.session import table

SF01 = "/root/testdata/sf0.01"
PIECES = P.path("piece_bpe_32k.model")


def small_lattice():
    return G.Lattice({p: i for i, p in enumerate(["▁", "a", "b", "ab", "▁a", "ba", "abb", "bb"])})


def segmentations(lattice, w):
    for cuts in itertools.product([0, 1], repeat=len(w) - 1):
        parts, at = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(w[at:i])
                at = i
        parts.append(w[at:])
        nums = [lattice.pieces.get(p, lattice.unknown if len(p) == 1 and p not in lattice.pieces else None) for p in parts]
        if None not in nums:
            yield nums


def test_forward_sums_all_segmentations():
    lattice = small_lattice()
    logp = np.log(np.random.default_rng(1).dirichlet(np.ones(9), 2).T)
    words = ["", "a", "abba", "xab", "bbabxx", "abbabbab"]
    found = G.word_scores(lattice, words, logp)
    even = np.full((9, 1), -math.log(9))
    for w in words:
        all_ = list(segmentations(lattice, "▁" + w))
        want = [math.log(sum(math.exp(sum(logp[p, k] for p in s)) for s in all_)) for k in range(2)]
        assert np.allclose(found[w], want)
    for lot, k, p, share in G.expected_pieces(lattice, words, even):
        for n, w in enumerate(lot):
            all_ = list(segmentations(lattice, "▁" + w))
            total = sum(9.0 ** -len(s) for s in all_)
            want = np.zeros(9)
            for s in all_:
                for x in s:
                    want[x] += 9.0 ** -len(s) / total
            assert np.allclose(np.bincount(p[k == n], share[k == n], minlength=9), want)


def test_very_long_words_are_whole():
    lattice = small_lattice()
    logp = np.log(np.full((9, 2), 1 / 9))
    assert np.isfinite(G.word_scores(lattice, ["ab" * 20000, "a"], logp)["ab" * 20000]).all()


def lang_rows(spark, rows):
    return spark.createDataFrame([(d, t, l, 1.5) for d, t, l in rows], "doc_id long, text string, lang string, score double")


def test_language_table(spark):
    rng = random.Random(1)
    en, de = ["the", "river", "walks", "and", "stone"], ["der", "fluß", "geht", "und", "stein"]
    rows = [(i, " ".join(rng.choice(w) for _ in range(8)), lang) for i, (w, lang) in enumerate([(en, "en"), (de, "de")] * 20)]
    rows += [(90, None, "en"), (91, "the river", None)]
    model = G.train(lang_rows(spark, rows), PIECES)
    assert model["languages"] == ["de", "en"] and np.allclose(np.exp(model["logp"]).sum(axis=0), 1)
    asked = [(1, "The RIVER and the stone", None), (2, "der Stein und der Fluß", "en"), (3, None, None), (4, "", None), (5, "12 %% 3", None),
             (None, "und", None), (1, "The RIVER and the stone", None)]
    got = sorted((r.doc_id or -1, r.lang_pred) for r in G.predict(lang_rows(spark, asked), model, PIECES).collect())
    assert got == [(-1, "de"), (1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und")]
    none = G.train(lang_rows(spark, []), PIECES)
    assert [r.lang_pred for r in G.predict(lang_rows(spark, asked[:1]), none, PIECES).collect()] == ["und"]
    assert G.predict(lang_rows(spark, []), model, PIECES).count() == 0


def test_language_held_out(spark):
    truth = {r.doc_id: r.lang for r in table(spark, SF01, "documents").collect() if r.lang is not None and r.text and len(r.text) > 40}
    rows = [r for r in QUERIES["op8_language_id"](spark, SF01).collect() if r.held_out and r.doc_id in truth]
    right = sum(r.lang_pred == truth[r.doc_id] for r in rows) / len(rows)
    assert all(0 <= r.score <= 1 for r in rows) and right > 0.95, right


def test_features_are_the_distinct_ngrams():
    seen = np.zeros(1 << T.BITS, bool)
    a = T.features("You IDIOT, you".encode(), seen)
    assert not seen.any() and len(a) == len(set(a.tolist()))
    text = " you idiot, you "
    grams = {text[i:i + n] for n in T.NGRAMS for i in range(len(text) - n + 1)}
    assert len(grams) - 2 <= len(a) <= len(grams)
    assert set(T.features(b"idiot", seen)) <= set(T.features(b"the idiot is", seen))
    assert len(T.features(None, seen)) == 0 and len(T.features(b"", seen)) == 0


def tox_rows(spark, rows):
    return spark.createDataFrame([(d, t, 3) for d, t in rows], "doc_id long, text string, y int")


def test_toxicity_table(spark):
    rng = random.Random(5)
    words = ["river", "stone", "green", "walk", "house", "über"]
    rows, labels = [], []
    for i in range(120):
        bad = i % 4 == 0
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(3, 60))) + (" you scum" if bad else "")))
        labels.append((i, int(bad)))
    rows += [(500, None), (501, "no label")]
    labels += [(600, 1), (500, 0), (3, None)]
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = T.train(tox_rows(spark, rows), lab)
    asked = tox_rows(spark, [(1, "green stone scum walk"), (2, "green stone walk"), (3, None), (4, ""), (4, ""), (5, "river " * 20000 + "scum")])
    got = sorted((r.doc_id, r.score) for r in T.score(asked, model).collect())
    s = dict(got)
    assert s[1] >= 0.7 and s[5] >= 0.7 and s[2] < 0.3 and s[3] == s[4] < 0.5 and len(got) == 6
    one = T.train(tox_rows(spark, rows), lab.where("toxic = 0"))
    assert all(r.score < 1e-6 for r in T.score(asked, one).collect())
    assert T.score(tox_rows(spark, []), model).count() == 0
    empty = T.train(tox_rows(spark, []), lab)
    assert all(0 <= r.score <= 1 for r in T.score(asked, empty).collect())


def test_counts_ratios_and_fit_equal_brute_force(spark):
    rng = random.Random(8)
    words = ["river", "stone", "idiot", "walk", "scum", "über"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 9)))) for i in range(80)]
    y = {i: int("idiot" in t or rng.random() < 0.1) for i, t in rows}
    # repeated labels count once; ids with both labels aren't learned from
    labels = [(i, v) for i, v in y.items()] + [(0, y[0]), (0, y[0]), (1, 1 - y[1])]
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    learned = [(t, y[i]) for i, t in rows if i != 1]
    seen = np.zeros(1 << T.BITS, bool)
    want, n = np.zeros((2, 1 << T.BITS), int), np.zeros(2, int)
    for t, v in learned:
        n[v] += 1
        want[v, sorted(set(T.features(t.encode(), seen).tolist()))] += 1
    df = spark.createDataFrame([(v, t) for t, v in learned], "y int, text string")
    got_n, got = T.label_counts(df)
    assert (got_n == n).all() and (got == want).all()
    r = T.log_count_ratios(n, want)
    for f in np.flatnonzero(r)[:200]:
        p, q = (want[1, f] + 1) / (n[1] + 2), (want[0, f] + 1) / (n[0] + 2)
        assert math.isclose(r[f], math.log(p / q)) and want[:, f].sum() >= T.LEAST_TEXTS
    # at the fit's end the objective's gradient is small against its beginning
    weights, bias = T.fit([(v, t.encode()) for t, v in learned], r, n[1] / n.sum())

    def gradient(w, b):
        g, gb = T.PENALTY * 10 / len(learned) * w, 0.0
        for t, v in learned:
            f = T.features(t.encode(), seen)
            f = f[r[f] != 0]
            d = (1 / (1 + math.exp(-((w[f] * r[f]).sum() + b))) - v) / len(learned)
            g[f] += d * r[f]
            gb += d
        return math.sqrt((g ** 2).sum() + gb ** 2)
    scaled = np.divide(weights, r, out=np.zeros_like(weights), where=r != 0)
    assert gradient(scaled, bias) < 0.1 * gradient(np.zeros_like(r), math.log(n[1] / n[0]))
    model = T.train(tox_rows(spark, rows), lab)
    scores = {d.doc_id: d.score for d in T.score(tox_rows(spark, rows), model).collect()}
    for i, t in rows:
        z = weights[T.features(t.encode(), seen)].sum() + bias
        assert math.isclose(scores[i], 1 / (1 + math.exp(-z)), rel_tol=1e-6, abs_tol=1e-9)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.1"])
def test_toxicity_held_out(spark, sf):
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    rows = [r for r in QUERIES["op2_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in rows) / len(rows)
    assert all(0 <= r.score <= 1 for r in rows) and right > 0.93, right


def test_words_are_letters_with_their_marks():
    assert G.words_of("² ½ ① ٣ 12 _ — 💡") == []
    assert G.words_of("हिन्दी") == ["हिन्दी"]
    assert G.words_of("It's 2nd ÀB_c e\u0301a") == ["it", "s", "nd", "àb", "c", "e\u0301a"]
