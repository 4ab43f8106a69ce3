"""The whole pipeline against its stages in plain Python."""
import hashlib
import random

import numpy as np
import public_tokenizers as P
import tiktoken

from feedlens.llm import bpe, quality

from .test_near_dedup import brute
from .test_quality_and_mix import mix_brute, prose

import corpus_pipeline as C


def documents():
    rng = random.Random(12)
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "too short", "de", None, 9)]
    for i in range(10, 130):
        t = prose(rng, rng.randint(60, 160))
        rows.append((i, t, "en", rng.choice(["a", "a", "b", "ö", None]), len(t)))
    for i in range(130, 200):  # exact and near copies
        _, t, lang, s, _ = rng.choice(rows[3:60])
        if i % 3:
            w = t.split(" ")
            w[rng.randrange(len(w))] = "changed"
            t = " ".join(w)
        rows.append((i, t, lang, s, len(t)))
    rows.append((300, "### $$$ " * 50 + prose(rng, 40), "en", "b", 1))
    return rows


def brute_pipeline(rows):
    kept = []
    for r in rows:
        p = quality.Page((r[1] or "").encode())
        if not any(rule(p) for rule in quality.RULES.values()):
            kept.append(r)
    last = {}
    for r in kept:
        last[r[1]] = max(last.get(r[1], r[0]), r[0])
    kept = [r for r in kept if last[r[1]] == r[0]]
    stay = {d for d, _, _, k in brute([(r[0], r[1]) for r in kept]) if k}
    kept = [r for r in kept if r[0] in stay]
    copies = {d: taken // size for d, size, _, _, taken in mix_brute([(r[0], r[1], r[3]) for r in kept])}
    tok = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    out = []
    for r in kept:
        ids = np.array(tok.encode_ordinary(r[1]), "<u4")
        out += [(r[0], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(r[1].encode()).hexdigest())] * copies[r[0]]
    return sorted(out)


def test_pipeline_equals_its_stages_in_python(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in C.run(spark, str(tmp_path)).collect())
    want = brute_pipeline(rows)
    assert got == want and len({r[0] for r in want}) < len(rows) - 40


def test_stages_keep_the_columns(spark):
    df = spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long")
    assert 4 <= len(C.STAGES) <= 5
    for _, stage in C.STAGES[:-1]:
        assert stage(spark, df, "").columns == df.columns
        assert stage(spark, df.limit(0), "").count() == 0


def test_rows_without_an_id_and_no_rows(spark, tmp_path):
    rng = random.Random(3)
    base = prose(rng, 90)
    rows = [(None, base, "en", "a", 1), (None, base + " more", "en", "a", 1), (None, prose(rng, 80), "de", None, 2), (4, None, None, "a", None),
            (7, base + " end", "en", "a", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "some" / "documents.parquet"))
    got = [r.doc_id for r in C.run(spark, str(tmp_path / "some")).collect()]
    assert set(got) == {7, None}  # one of the near copies, and the text that has none
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert C.run(spark, str(tmp_path / "none")).collect() == []
