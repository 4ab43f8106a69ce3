"""The transducer against the public library, and the streaming decoder."""
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from feedlens.llm import bpe as B

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.load_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return B.Encoder(PATH, P.PATTERN)


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def texts(n, seed):
    rng = random.Random(seed)
    alpha = list("aaabbe  \n\t'stré中😀\x1c\x85 　!!??--01") + ["the ", "ing", "tion", " \n", "  ", "'re", "\r\n", "<|endoftext|>"]
    return ["".join(rng.choice(alpha) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_encodes_as_the_library(library, encoder):
    hard = ["", " ", "a" * 3000, "ab" * 2000, "1234567890" * 200, "é" * 900, "\n" * 50, " " * 77 + "x", "<|endoftext|>"]
    for t in hard + texts(3000, 1):
        assert ids(encoder.encode(t)) == library.encode_ordinary(t), t


def test_every_token_and_small_state_table(library, monkeypatch):
    monkeypatch.setattr(B, "MAX_STATES", 50)  # starts over all the time
    monkeypatch.setattr(B, "MEMO_BYTES", 2000)
    e = B.Encoder(PATH, P.PATTERN)
    vocabulary = [b.decode("utf-8", "ignore") for b in list(B.load_ranks(PATH))[::23]]
    for t in vocabulary:
        assert ids(e.encode(t)) == library.encode_ordinary(t), t


@pytest.mark.parametrize("step", [1, 2, 5, 4096])
def test_streamed_text_is_whole(encoder, step):
    d = B.Decoder(PATH)
    for t in texts(200, 9):
        assert "".join(d.stream(ids(encoder.encode(t)), step)) == t


def test_stream_replaces_what_is_not_utf8():
    for raw in (b"a\xff\xfeb", b"\xe4\xb8", b"\xc3", b"\xf0\x9f\x98x", b"\x80\x80"):
        for cut in range(len(raw) + 1):
            s = B.Utf8Stream()
            assert s.feed(raw[:cut]) + s.feed(raw[cut:]) + s.end() == raw.decode("utf-8", "replace")


def test_table(spark, library):
    import hashlib
    rows = [(1, None), (2, ""), (3, "Hello wörld"), (3, "Hello wörld"), (None, "x")]
    df = spark.createDataFrame([(d, t, b"z", "q") for d, t in rows], "doc_id long, text string, ids binary, n_tokens string")
    got = sorted((tuple(r) for r in B.round_trip(df, PATH, P.PATTERN).collect()), key=repr)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for d, t in rows:
        own = library.encode_ordinary(t or "")
        want.append((d, len(own), sha(np.array(own, "<u4").tobytes()), sha((t or "").encode())))
    assert got == sorted(want, key=repr)
    both = B.decode(B.encode(df, PATH, P.PATTERN), PATH)
    assert sorted(((r.doc_id, r.text) for r in both.collect()), key=repr) == sorted(((d, t or "") for d, t in rows), key=repr)
    assert B.round_trip(df.limit(0), PATH, P.PATTERN).count() == 0


def test_pairs_that_fit_are_those_that_merging_leaves():
    t = B.Transducer(B.load_ranks(PATH))
    rng = random.Random(1)
    some = list(t.bytes_of)
    short = [i for i in some if len(t.bytes_of[i]) <= 3]
    for k in range(6000):
        a, b = rng.choice(short if k % 2 else some), rng.choice(short if k % 3 else some)
        assert t._fits(a, b) == (t.merge(t.bytes_of[a] + t.bytes_of[b]) == [a, b])


def test_states_hold_what_can_still_grow():
    t = B.Transducer(B.load_ranks(PATH))
    rng = random.Random(4)
    parts = "the of and ing tion er on re en ch ly st ha wh ble".split()
    for _ in range(3000):
        word = (" " + "".join(rng.choice(parts) for _ in range(5))).encode()
        assert t.encode_piece(word) == ([t.ranks[word]] if word in t.ranks else t.merge(word))
    assert len(t._states) < 6700
