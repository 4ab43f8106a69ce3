"""Exact dedup by chunk recipes and line dedup by chunks, against direct comparison."""
import hashlib
import random

import pytest

from feedlens.llm import exact_dedup as X
from feedlens.llm import line_dedup as L

SCHEMA = "doc_id long, text string, recipe string, rid long, lines string"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "r", 5, "l") for d, t in rows], SCHEMA)


def long_texts():
    rng = random.Random(2)
    base = " ".join(rng.choice(["alpha", "béta", "gamma", "delta", "ε"]) + str(rng.randrange(999)) for _ in range(6000))
    return [(10, base), (11, base), (12, base[:-1]), (13, base[:20000] + "x" + base[20000:]), (14, "a" * 50000), (15, "a" * 50000)]


EDGES = [(1, None), (2, ""), (3, "x"), (4, "x"), (4, "x"), (5, " x"), (None, "x"), (6, "X"), (7, "\x00y"), (8, "y")]


def direct(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for t, ids in groups.items():
        top = max((d for d in ids if d is not None), default=None)
        left = 1
        for d in sorted(ids, key=lambda x: (x is None, x)):
            kept = d == top and left == 1
            left -= kept
            out.append((d, top, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest_bytes", [32, 1])  # one byte: contents share digests, and must stay apart
def test_exact_dedup_equals_direct_grouping(spark, digest_bytes):
    rows = EDGES + long_texts() + [(100 + i, f"short text {i % 37}") for i in range(150)]
    got = sorted((tuple(r) for r in X.exact_dedup(table(spark, rows), digest_bytes=digest_bytes).collect()), key=repr)
    assert got == direct(rows)


def test_empty_tables(spark):
    assert X.exact_dedup(table(spark, [])).count() == 0
    assert X.drop_exact_copies(table(spark, [])).count() == 0
    assert L.remove_repeated_chunks(table(spark, [])).count() == 0


def test_kept_rows_have_their_own_columns(spark):
    got = X.drop_exact_copies(table(spark, EDGES))
    assert got.columns == ["doc_id", "text", "recipe", "rid", "lines"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(2, ""), (4, "x"), (5, " x"), (6, "X"), (7, "\x00y"), (8, "y")], key=repr)


def test_cut_points_cover_the_text_and_resist_shifts():
    rng = random.Random(1)
    b = bytes(rng.randrange(256) for _ in range(60000))
    ends = X.cut_points(b)
    assert ends[-1] == len(b) and all(0 < y - x <= X.MAX_CHUNK for x, y in zip([0, *ends], ends))
    chunks = lambda z: {z[x:y] for e in [X.cut_points(z)] for x, y in zip([0, *e], e)}
    assert len(chunks(b) - chunks(b"inserted" + b)) <= 3
    assert X.cut_points(b"") == []


def line_brute(rows):
    """Chunks by the stated rule, the first of equal chunks stays."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    docs = []
    for n, (d, t) in enumerate(rows):
        ls = [] if t is None else t.split("\n")
        chunks, at = [], 0
        for i in range(len(ls)):
            if i == len(ls) - 1 or md5((md5(ls[i - 1]) if i else "") + md5(ls[i]))[0] <= "3":
                chunks.append("\n".join(ls[at:i + 1]))
                at = i + 1
        docs.append((d, n, t, chunks))
    seen, out = set(), {}
    for d, n, t, chunks in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        kept, gone = [], []
        for c in chunks:
            if c.count("\n") and c.split(None) and c in seen:
                gone.append(c)
            else:
                kept.append(c)
            seen.add(c)
        out[n] = (d, None if t is None else "\n".join(kept), sum(c.count("\n") + 1 for c in chunks),
                  sum(c.count("\n") + 1 for c in gone), len(gone))
    return sorted(out.values(), key=repr)


def test_line_dedup_equals_direct_comparison(spark):
    rng = random.Random(4)
    passages = ["\n".join(f"line {rng.randrange(40)} of passage" for _ in range(rng.randint(3, 9))) for _ in range(6)]
    rows = [(1, None), (2, ""), (3, "\n\n\n"), (4, "\n\n\n"), (None, passages[0]), (5, passages[0] + "\n" + passages[0])]
    for i in range(60):
        own = [f"own {i} {j}" for j in range(rng.randint(0, 5))]
        rows.append((10 + i, "\n".join(own + [rng.choice(passages)] + own[:1] + [rng.choice(passages)])))
    got = sorted(((r.doc_id, r.text, r.n_lines, r.removed_lines, r.removed_chunks)
                  for r in L.remove_repeated_chunks(table(spark, rows)).collect()), key=repr)
    want = line_brute(rows)
    assert got == want and sum(x[4] for x in want) > 40


def test_line_dedup_runs_no_python(spark):
    plan = L.remove_repeated_chunks(table(spark, EDGES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
