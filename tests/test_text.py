"""Hand-derived fixtures for cleaning, stopwords, length filter, dedup."""
from pyspark.sql import functions as F

from feedlens.functions.text import clean_text
from feedlens.operators import text as T


def _one(spark, rows, schema, fn):
    return fn(spark.createDataFrame(rows, schema)).collect()


def test_clean(spark):
    cases = [("  Chất\t LƯỢNG \n", True, "chất lượng"), ("A\u00a0\u2003B\u3000", True, "a b"),
             ("a\u001cb", True, "a b"), (" A  B ", False, "A B"), ("", True, "")]
    for text, lower, want in cases:
        got = spark.createDataFrame([(text,)], "t string").select(clean_text("t", lower)).first()[0]
        assert got == want, (text, got)


def test_stopwords(spark):
    stop = ["shop", "có", "thể", "cụ"]
    cases = [("shop có size m", "size m"), ("cụ_thể shop", "cụ_thể"), ("shop, size", "shop, size"), ("shop có", "")]
    for text, want in cases:
        df = spark.createDataFrame([(1, text)], "doc_id long, clean string")
        assert T.remove_stopwords(df, stop).first()["clean"] == want
        # large-list path (anti join) gives the same result
        big = stop + [f"w{i}" for i in range(2500)]
        assert T.remove_stopwords(df, big).first()["clean"] == want
        # a caller's table (size checked before any broadcast) as well
        table = spark.createDataFrame([(w,) for w in big], "word string")
        assert T.remove_stopwords(df, table).first()["clean"] == want


def test_min_chars(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "abc"), (3, "a_b"), (4, ""), (5, "   ")], "doc_id long, clean string")
    assert sorted(r.doc_id for r in T.filter_min_chars(df, 3).collect()) == [2, 3]
    assert sorted(r.doc_id for r in T.filter_min_chars(df, 0).collect()) == [1, 2, 3]


def test_dedup_keeps_min_id(spark):
    df = spark.createDataFrame([(5, "x", "same"), (2, "y", "same"), (9, "z", "same"), (1, "w", "other")],
                               "doc_id long, text string, clean string")
    out = sorted((r.doc_id, r.text) for r in T.dedup_first(df).collect())
    assert out == [(1, "w"), (2, "y")]
    # idempotent and independent of partitioning
    again = sorted((r.doc_id, r.text) for r in T.dedup_first(T.dedup_first(df.repartition(3))).collect())
    assert again == out


def test_preprocess_matches_python(spark):
    import re
    rows = [(i, t) for i, t in enumerate(["Shop  có hàng ĐẸP", "shop có hàng đẹp", "ab", "  ", "Giao hàng nhanh!"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.clean) for r in T.preprocess(df).collect())
    stop = set(T.DEFAULT_STOPWORDS)
    seen, want = set(), []
    for i, t in rows:
        c = re.sub(r"\s+", " ", t.strip().lower())
        c = " ".join(w for w in c.split() if w not in stop)
        if c.strip() == "" or len(c) < 3 or c in seen:
            continue
        seen.add(c)
        want.append((i, c))
    assert got == want


def test_preprocess_with_lexicon_segments_before_stopwords(spark):
    lex = spark.createDataFrame([("cụ", "thể"), ("chất", "lượng")], "a string, b string")
    df = spark.createDataFrame([(1, "Cụ thể chất lượng shop tốt"), (2, "cụ thể")], "doc_id long, text string")
    got = {r.doc_id: r.clean for r in T.preprocess(df, lexicon=lex).collect()}
    # "cụ thể" becomes one unit before stopword removal, so the single-word stopwords cụ/thể do not apply
    assert got == {1: "cụ_thể chất_lượng tốt", 2: "cụ_thể"}
