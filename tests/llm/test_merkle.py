"""The manifest against a tree built in plain Python."""
import hashlib
import random
import zlib

import pytest

from feedlens.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, g string, idx int"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(level, k):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i: i + k]) for i in range(0, len(levels[-1]), k)])
    return levels


def proof(levels, i, k):
    out = []
    for level in levels[:-1]:
        run = level[i - i % k: i - i % k + k]
        out.append((i % k, run[: i % k] + run[i % k + 1:]))
        i //= k
    return out


def brute(rows, k=8):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, h(field(v) for v in r[:5]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        trees.append(tree([x[2] for x in groups[g]], k))
    top = tree([t[-1][0] for t in trees], k)
    root, out = top[-1][0] if names else None, []
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for j, g in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(groups[g]):
            steps = proof(trees[j], i, k) + proof(top, j, k)
            now = leaf
            if zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 3 == 0:
                now = h([*(field(v) for v in r[:4]), field(r[4] if r[4] is None else r[4].translate(lower))])
            for slot, sibs in steps:
                now = h(sibs[:slot] + [now] + sibs[slot:])
            out.append((r[0], leaf, trees[j][-1][0], root, h(s for _, sibs in steps for s in sibs), now, now == root))
    return sorted(out, key=repr)


def rows_of(seed, n, langs):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = langs[0] if rng.random() < 0.4 else rng.choice(langs)
        out.append((i * 3 - 50, rng.choice([None, "", "web", "ü"]), lang, rng.choice([None, 0, 12]),
                    rng.choice([None, "", "lower", "Some Text ÀÉ", "x" * 20_000 + "Q", "1:a"]), "1en", i))
    return out


def found(spark, rows, **options):
    return sorted((tuple(r) for r in M.verified(spark.createDataFrame(rows, SCHEMA), **options).collect()), key=repr)


@pytest.mark.parametrize("arity", [8, 2])
def test_manifest_equals_plain_tree(spark, arity):
    rows = rows_of(1, 150, ["en", None, "", "z", "é", "de"])
    rows += [rows[3], rows[3], (None, "a", "en", 1, "Null Id", "g", 0), (None, "b", "en", 1, "Null Id", "g", 0),
             (9, "s", "alone", 1, "One", "g", 0)]
    assert found(spark, rows, arity=arity) == brute(rows, arity)


def test_many_groups_and_none(spark):
    assert found(spark, []) == []
    one = [(3, "s", None, 1, "One Row", "g", 0)]
    assert found(spark, one) == brute(one)
    rows = rows_of(2, 90, [f"l{i}" for i in range(70)])
    assert found(spark, rows) == brute(rows)


def test_a_changed_text_is_found(spark):
    rows = [(i, "s", "en", 1, t, "g", 0) for i, t in enumerate(["Upper", "lower"] * 20)]
    for r in found(spark, rows):
        assert r[6] == (zlib.crc32(str(r[0]).encode()) % 3 != 0 or r[0] % 2 == 1)
