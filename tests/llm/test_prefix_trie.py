"""The conversation trie against a dictionary of prefixes, with shards of a few turns."""
import hashlib
import random
import zlib

import numpy as np
import pytest

from feedlens.llm import prefix_trie as T

SCHEMA = "conv_id long, turn int, role string, text string, node string, path int"


def brute(rows):
    by = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: (x[0], x[1], x[2], token(x[2], x[3])))] for c, v in by.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        seq = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append((c, d == len(seq)))
    first = {k: min(c for c, _ in v) for k, v in nodes.items()}
    out = {}
    for k, v in nodes.items():
        ends = ",".join(map(str, sorted(c for c, e in v if e)))
        out[k] = [first[k], len(k), first[k[:-1]] if k else None, len(v), 0, 0, 0, hashlib.sha256(ends.encode()).hexdigest()]
    for k in sorted(nodes, key=len, reverse=True):
        row = out[k]
        row[5] += row[4] == 0
        row[6] += (row[3] - 1) * (len(k[-1][1]) if k else 0)
        if k:
            up = out[k[:-1]]
            up[4] += 1
            up[5] += row[5]
            up[6] += row[6]
    return sorted(map(tuple, out.values()), key=repr)


def token(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in T.prefix_trie(df, **options).drop("node").collect()), key=repr)


def conversations(seed, n, hot=0.4):
    rng = random.Random(seed)
    texts = ["", "a", "é👍", "long " * 50] + [f"t{i}" for i in range(6)]
    rows = []
    for c in range(n):
        c = c * 7 - 30
        if rng.random() < hot:  # a group of copies
            seq = [("user", "hello"), ("assistant", "hi"), ("user", "bye")]
        else:
            seq = [(rng.choice(["user", "assistant", None]), rng.choice(texts + [None])) for _ in range(rng.randrange(1, 9))]
        rows += [(c, t if t or rng.random() < 0.5 else None, r, x) for t, (r, x) in enumerate(seq)]
    rows += [(None, 0, "user", "nobody"), (5, 1, "b", "tie"), (5, 1, "a", "tie"), (5, 1, "a", "tie"), (5, 1, "a", "other")]
    rows += [(300, t, "user", f"deep {t % 5}") for t in range(250)] + [(200, 0, "user", "hello")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("turns", [1, 60, 10**9])
def test_trie_equals_brute_force(spark, turns, monkeypatch):
    monkeypatch.setattr(T, "SHARD_PATHS", 4)
    rows = conversations(turns % 97, 260)
    assert found(spark, rows, shard_turns=max(turns, 30)) == brute(rows)


def test_no_rows_one_row_and_a_turnless_conversation(spark):
    assert found(spark, []) == []
    for rows in ([(100, 0, "user", "x")], [(0, None, None, None)], [(c, 0, "u", "x") for c in range(1, 40)]):
        assert found(spark, rows) == brute(rows)


def test_ends_of_a_hot_node_are_hashed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 7)
    rows = [(c, 0, "u", "x") for c in range(0, 40000, 100)]
    assert found(spark, rows, shard_turns=50) == brute(rows)


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 50_000):
        keys = rng.integers(0, 2**63, (n, 2), dtype=np.uint64)
        table = T.MinimalPerfectHash(keys)
        assert sorted(table.slots(keys).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        T.MinimalPerfectHash(np.zeros((2, 2), np.uint64))
    path = "0" * 32 + "00000001"
    with pytest.raises(ValueError):  # the same prefix with two text lengths can't be one node
        s = T.digests_of
        try:
            T.digests_of = lambda p: (lambda k, d, a, x: (k, d, a, np.arange(len(x))))(*s(p))
            one = np.ones(2, np.int64)
            T.Shard([path, path + "1" * 32 + "00000002"], [one, np.ones(3, np.int64)], [one, np.ones(3, np.int64)],
                    [tuple(np.zeros(k, np.int64) for _ in range(3)) for k in (2, 3)])
        finally:
            T.digests_of = s
