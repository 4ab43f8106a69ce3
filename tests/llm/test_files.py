"""WARC archives and token shards: exact round trips through their files."""
import gzip
import io
import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from feedlens.llm import token_store as S
from feedlens.llm import warc as W
from feedlens.llm.files import filesystem

WORDS = P.path("word_bpe_49k.json")


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "a", 3) for i, u, h in rows],
                                 "page_id long, url string, html string, archive string, seq int")


def archived(rows, least=0):
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(top.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        t = top.get(h or "") if len(raw) >= least else None
        again = t is not None and i != t
        out.append((i, len(raw), W.payload_digest(raw), "revisit" if again else "response", t if again else None))
    return sorted(out, key=repr)


ROWS = [(1, "http://a", "<p>x</p>"), (2, "http://b\r\nX: y", "<p>x</p>"), (3, None, None), (4, "http://é", ""), (5, "u", "é\r\n\r\nWARC/1.1\r\n"),
        (5, "u", "é\r\n\r\nWARC/1.1\r\n"), (None, "n", "<p>x</p>"), (None, "n", "only"), (9, "big", "z" * 3_000_000), (-7, "neg", "q")]


def test_warc_round_trip(spark):
    rows = ROWS + [(100 + i, f"http://h/{i}", f"body {i % 17} " * (i % 5)) for i in range(120)]
    for least, size in ((0, 1 << 26), (4, 2000)):
        got = W.archived(pages(spark, rows), least_bytes=least, archive_bytes=size).select(
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted((tuple(r) for r in got), key=repr) == archived(rows, least)


def test_members_stand_alone_and_payloads_are_whole(spark):
    records = W.write_archives(pages(spark, ROWS))
    warcs = W.normalise(W.revisits(records))
    for r in warcs.collect():
        fs, path = filesystem(r["warc"])
        with fs.open_input_stream(path, compression=None) as f:
            data = f.read()
        with fs.open_input_stream(filesystem(r["index"])[1]) as f:
            index = [x.split("\t") for x in f.read().decode().splitlines()]
        assert sum(int(n) for _, n, _, _ in index) == len(data)
        for at, n, kind, name in index:
            member = zlib.decompress(data[int(at):int(at) + int(n)], 31)
            assert member.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and name.encode() in member
    texts = sorted(bytes(r.payload) for r in W.read_archives(warcs).collect() if r.payload is not None)
    assert b"z" * 3_000_000 in texts and "é\r\n\r\nWARC/1.1\r\n".encode() in texts


def test_normaliser_takes_members_too():
    record = W.response_record(1, "u", b"payload")
    for raw in (gzip.compress(record + record), gzip.compress(record) + gzip.compress(record)):
        out = io.BytesIO()
        index = W.rewrite(gzip.GzipFile(fileobj=io.BytesIO(raw)), out, {1: 8})
        assert [x[2] for x in index] == ["response", "revisit"]
        assert gzip.decompress(out.getvalue()[:index[0][1]]) == record


def test_no_pages(spark):
    assert W.archived(pages(spark, [])).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, most in ((1, 1), (1, 2**60), (5, 3), (1000, 10**6), (300, 2**62), (20000, 20000), (3000, 200)):
        v = np.sort(rng.integers(0, most, n, dtype=np.uint64))
        about, blob = S.EliasFano.of(v).parts()
        e = S.EliasFano.read(about, blob)
        assert (e.all() == v).all() and [e[i] for i in range(0, n, max(1, n // 300))] == v[::max(1, n // 300)].tolist()
    about, blob = S.EliasFano.of(np.arange(0, 10**6 * 100, 100)).parts()
    assert 8 * len(blob) / 10**6 < 10  # 7 low bits, 2 high bits and the marks; 64-bit offsets would take 64


def test_token_shards(spark):
    rng = random.Random(3)
    rows = [(5, "Hello wörld"), (5, "Again"), (None, "null id"), (-3, None), (2, ""), (10**12, "x " * 30000), (7, "é 　 a\x1cb ﬁ ſ İ'll")]
    rows += [(1000 + i, " ".join(rng.choice(["Der", "the", "año", "😀!", "1234", "d'un"]) for _ in range(rng.randint(0, 40)))) for i in range(200)]
    df = spark.createDataFrame([(d, t, "p", 1) for d, t in rows], "doc_id long, text string, path string, base int")
    got = [tuple(r) for r in S.stored(df, WORDS).collect()]
    library = Tokenizer.from_file(WORDS)
    want, at = [], 0
    for d, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, (x[1] or "").encode())):
        own = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((d, at, len(own), zlib.crc32(own.tobytes())))
        at += len(own)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert S.stored(df.limit(0), WORDS).count() == 0


def test_random_access(spark):
    df = spark.createDataFrame([(i, f"word{i} " * (i % 7)) for i in range(500)], "doc_id long, text string")
    for r in S.write_shards(df, WORDS).collect():
        fs, path = filesystem(r.path)
        with fs.open_input_file(path) as f:
            reader = S.ShardReader(f)
            every = list(reader.documents())
            assert len(reader) == r.n_docs
            for i in random.Random(1).sample(range(len(reader)), min(50, len(reader))):
                begin, end = reader.span(i)
                assert begin == every[i][1] and (reader.ids(begin, end) == every[i][2]).all()
