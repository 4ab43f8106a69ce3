"""Packing: exact pieces, gapless sequences, and how few there are."""
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from feedlens.llm import packing as P

WORDS = str(public_tokenizers.path("word_bpe_49k.json"))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, length int, lot string")


def expected(rows, capacity):
    tok = Tokenizer.from_file(WORDS)
    out = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at: at + capacity]
            out.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=repr)


def fitted(lengths, capacity):
    """Sequences that best fit, longest first, would need."""
    bins = []
    for n in sorted(lengths, reverse=True):
        room = [b for b in range(len(bins)) if bins[b] >= n]
        if room:
            bins[min(room, key=lambda b: bins[b])] -= n
        else:
            bins.append(capacity - n)
    return len(bins)


def some_rows(seed=1, n=300):
    rng = random.Random(seed)
    words = ["the", "packing", "Überzug", "naïve", "x1", "...", "<|endoftext|>", "日本語", "l'été"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 20, 60])))) for i in range(n)]
    return rows + [(7, "again"), (7, "again"), (None, "nobody"), (None, None), (n, None), (n + 1, ""), (n + 2, "long words " * 3000)]


def test_pieces_places_and_count(spark):
    rows, capacity = some_rows(), 64
    got = P.packed(docs(spark, rows), WORDS, capacity).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == expected(rows, capacity)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    lengths = [r.length for r in got]
    assert len(by) <= fitted(lengths, capacity)
    assert len(by) <= -(-sum(lengths) // capacity) + 1


def test_sequences_hold_the_ids(spark):
    rows, capacity = some_rows(4, 80), 64
    cut = P.pieces(docs(spark, rows), WORDS, capacity)
    got = []
    for r in P.sequences(cut, capacity).collect():
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.n_tokens <= capacity and sum(s.length for s in r.spans) == len(ids)
        got += [(s.doc_id, s.piece, s.start, s.length, zlib.crc32(ids[s.offset: s.offset + s.length].tobytes())) for s in r.spans]
    assert sorted(got, key=repr) == expected(rows, capacity)


def test_empty_table(spark):
    assert P.packed(docs(spark, []), WORDS).collect() == []


def brute_fullest(lengths, room):
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= room}
    return max(sums)


def test_combinations_are_the_fullest():
    rng = random.Random(2)
    for _ in range(200):
        capacity = rng.randrange(5, 60)
        counts = {n: rng.randrange(1, 5) for n in rng.sample(range(1, capacity + 1), rng.randrange(1, min(8, capacity)))}
        left = dict(counts)
        for found, times in P.combinations(counts, capacity):
            for _ in range(times):
                longest = max(n for n, c in left.items() if c)
                rest = [n for n, c in left.items() for _ in range(c - (n == longest))]
                assert found[longest] and sum(n * k for n, k in found.items()) == longest + brute_fullest(rest, capacity - longest)
                for n, k in found.items():
                    left[n] -= k
        assert not any(left.values())


def test_near_the_lower_bound_on_skewed_lengths():
    rng = np.random.default_rng(5)
    lengths = np.clip(rng.lognormal(5.5, 1.2, 200_000).astype(int) + 1, 1, 2048)
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    bins = sum(times for _, times in P.combinations(counts, 2048))
    assert bins <= -(-int(lengths.sum()) // 2048) + 1
