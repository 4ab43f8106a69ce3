"""Near-dedup against all pairs compared directly."""
import hashlib
import random

import pytest
from pyspark.sql import Row

from feedlens.llm import near_dedup as N


def brute(rows):
    sets = []
    for _, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")).encode().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    mark = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    low, low_mark = {}, {}
    for i, (d, t) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
        else:
            low_mark[find(i)] = min(low_mark.get(find(i), mark(t)), mark(t))
    out = []
    for i, (d, t) in enumerate(rows):
        c = low.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, not sets[i] or (d == c if c is not None else mark(t) == low_mark[find(i)])))
    return sorted(out, key=repr)


def run(spark, rows, **extra):
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows],
                               "doc_id long, text string, comp string, cls long, sig long")
    return sorted((tuple(r) for r in N.near_dedup(df).collect()), key=repr)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randint(20, 80))] for _ in range(n // 5)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = rng.choice(words)
        t = " ".join(w)
        rows.append((i, t.upper() if rng.random() < .1 else t))
    return rows


def test_matches_all_pairs_with_chains_and_edges(spark):
    rows = corpus(220, 3) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "a b"), (1004, "A  b"), (1005, "a b c"),
                             (1003, "a b"), (None, "a b"), (1006, "one two three four five " * 400)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("hubs, block", [((2, 16), 256), ((1,), 16)])
def test_hub_rounds_then_the_rest_equal_all_pairs(spark, monkeypatch, hubs, block):
    monkeypatch.setattr(N, "HUBS", hubs)
    monkeypatch.setattr(N, "BLOCK", block)
    rng = random.Random(5)
    words = [f"q{i}" for i in range(3000)]
    core = [rng.choice(words) for _ in range(60)]
    rows = []
    for i in range(260):  # one large group of near copies, many of which aren't linked to each other
        w = list(core)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(60)] = rng.choice(words)
        rows.append((i, " ".join(w)))
    assert run(spark, rows) == brute(rows)


def test_rows_without_an_id_take_part(spark):
    base = [f"n{i}" for i in range(40)]
    near = lambda k: " ".join(base[:k] + ["other"] + base[k:])
    rows = [(None, near(0)), (None, near(40)), (None, near(40)), (None, "z1 z2 z3"), (None, None), (5, "lone " * 9)]
    assert run(spark, rows) == brute(rows)
    rows += [(8, " ".join(base)), (9, near(39))]
    assert run(spark, rows) == brute(rows)
    df = spark.createDataFrame([(*r, "k") for r in rows[:4]], "doc_id long, text string, kept string")
    assert len({r.text for r in N.keep_first_of_group(df).collect()}) == 2


def test_values_of_a_signature_use_all_bits():
    import numpy as np
    rng = np.random.default_rng(2)
    sigs = np.stack([N.signature(np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64))) for _ in range(400)])
    assert len(np.unique(sigs)) == sigs.size  # no accidental matches, in one coordinate or between two
    assert abs(float((sigs < 0).mean()) - 0.5) < 0.02


def test_empty_table(spark):
    assert run(spark, []) == []


def test_kept_rows_keep_their_columns(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, None)]
    df = spark.createDataFrame([Row(doc_id=d, text=t, kept="k") for d, t in rows], "doc_id long, text string, kept string")
    got = N.keep_first_of_group(df)
    assert got.columns == ["doc_id", "text", "kept"]
    assert sorted(r.doc_id for r in got.collect()) == [1, 3]


def test_shared_counts():
    import numpy as np
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64) * np.uint64(2**50)) for n in (1, 3, 4000, 8000, 60)]
    got = N.shared_counts(sets, sets[::-1])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[::-1]] for a in sets]
