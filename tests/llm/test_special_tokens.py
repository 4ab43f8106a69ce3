"""op10's ids of texts that hold the strings of special tokens, against the library's plain call."""
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")


def test_special_tokens_are_those_of_the_library():
    from tokenizers import Tokenizer

    from feedlens.llm.common import tokenizer_path
    from feedlens.llm.token_store import WordEncoder
    path = tokenizer_path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), WordEncoder(path)
    assert own._special
    names = [t[1:].decode() for t in own._special]
    rng = random.Random(3)
    parts = [*names, *(x.upper() for x in names), names[0][:-1], "the", "Word.", "It's", " ", "\n", "é", ".", "!?", "12", "<|", "|>"]
    texts = ["", None, names[0], f"a {names[0]} b", f"a{names[0]}b", f"end.{names[0]}", names[0].upper(), names[0] * 3]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    got = own.encode([None if t is None else t.encode() for t in texts])
    ids = [np.frombuffer(x, f"<u{own.width}").tolist() for x in got]
    for t, x in zip(texts, ids):
        assert x == library.encode(t or "", add_special_tokens=False).ids, t
    # n_tokens of the plain call: one for the special token
    assert len(ids[2]) == 1 and len(ids[6]) > 1
