"""Distributed global row index against a sorted Python list."""
import random

from pyspark.sql import functions as F


def test_row_index_matches_sorted_positions(spark):
    from feedlens.operators.order import row_index

    rng = random.Random(7)
    rows = [(i, rng.randint(0, 40)) for i in range(3000)]  # many ties on n
    df = spark.createDataFrame(rows, "id long, n long").repartition(13)
    got = {r["id"]: r["idx"] for r in row_index(df, [F.col("n").desc(), F.col("id")]).collect()}
    want = {i: pos for pos, (i, _) in enumerate(sorted(rows, key=lambda t: (-t[1], t[0])))}
    assert got == want


def test_row_index_empty(spark):
    from feedlens.operators.order import row_index

    df = spark.createDataFrame([], "id long")
    assert row_index(df, ["id"]).count() == 0


def test_hashed_vectors_keep_documents_without_tokens(spark):
    import math

    from feedlens.operators.embed import encode_hashed

    docs = spark.createDataFrame([(1, "alpha beta beta"), (2, "!! ?"), (3, "beta gamma")], "doc_id long, clean string")
    vecs = {r.doc_id: r.vec for r in encode_hashed(docs, 16).collect()}
    assert sorted(vecs) == [1, 2, 3]
    assert vecs[2] == [0.0] * 16
    for i in (1, 3):
        assert len(vecs[i]) == 16 and math.isclose(math.sqrt(sum(x * x for x in vecs[i])), 1.0)
