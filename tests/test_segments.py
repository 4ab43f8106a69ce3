"""Longest-match segmentation against a loop over tokens, and spikes of a stream that stops and starts."""
import datetime as dt
import random
import re

from pyspark.sql import functions as F

from feedlens.operators import phrases as PH
from feedlens.operators import trends as TR
from feedlens.streaming import negative_spikes_stream


def tokens(text):
    return re.findall(r"\w+|[^\w\s]", text or "")


def greedy(toks, lexicon, most, glue):
    out, i = [], 0
    while i < len(toks):
        k = next((k for k in range(min(most, len(toks) - i), 1, -1) if " ".join(toks[i:i + k]).lower() in lexicon), 1)
        out.append(glue.join(toks[i:i + k]))
        i += k
    return out


def test_longest_match_and_marks(spark):
    lexicon = {"a b", "a b c", "a b c d", "b c", "d e", "c d e f"}
    texts = ["A b c d e", "a b, c d e f!", "a a b b c d", "", None, "?", "x", "a b c d a b c d e", "x a b", "c d e"]
    rng = random.Random(2)
    texts += [" ".join(rng.choice("abcdefx,.") for _ in range(rng.randrange(40))) for _ in range(120)]
    df = spark.createDataFrame([(i // 2, t, "k", i) for i, t in enumerate(texts)], "doc_id long, clean string, phrase string, n long")
    lex = spark.createDataFrame([(p,) for p in lexicon], "phrase string")
    for most in (2, 4):
        got = {r.n: r.clean for r in PH.segment_words(df, lex, max_len=most).collect()}
        few = {p for p in lexicon if len(p.split()) <= most}
        assert got == {i: " ".join(greedy(tokens(t), few, most, "_")) for i, t in enumerate(texts)}
    assert PH.segment_words(df, lex).columns == df.columns
    assert PH.segment_words(df.limit(0), lex).collect() == []


def test_pairs_of_learn_phrases_are_a_lexicon(spark):
    df = spark.createDataFrame([(1, "new york is big", "s")], "doc_id long, clean string, source string")
    lex = spark.createDataFrame([("new", "york", "new_york")], "a string, b string, phrase string")
    assert PH.segment_words(df, lex, out="seg").first().seg == "new_york is big"


def test_lexicon_reaches_four_tokens_but_not_over_marks(spark):
    rng = random.Random(4)
    filler = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        w = [rng.choice(filler) for _ in range(12)]
        w[3:3] = ["cong", "hoa", "xa", "hoi"]
        w[9:9] = ["so", ",", "what"]
        rows.append((i, " ".join(w)))
    lex = {r.phrase: r.n_tokens for r in PH.learn_lexicon(spark.createDataFrame(rows, "doc_id long, clean string")).collect()}
    assert lex.get("cong hoa xa hoi") == 4 and lex.get("cong hoa") == 2
    assert "so what" not in lex and "hoa xa" in lex
    assert max(lex.values()) <= 4
    assert PH.learn_lexicon(spark.createDataFrame([], "doc_id long, clean string")).collect() == []


def events(spark, folder, n, rows):
    spark.createDataFrame(rows, "topic int, ts timestamp").coalesce(1).write.mode("overwrite").parquet(f"{folder}/part={n}")


def test_stream_spikes_equal_batch_over_a_restart(spark, tmp_path):
    rng = random.Random(1)
    start, rows = dt.datetime(2024, 1, 1), []
    for week in range(14):
        for topic in (1, 2, 3):
            if (topic, week) == (3, 5):
                continue  # a week without events
            for _ in range(rng.choice([2, 3, 12])):
                rows.append((topic, start + dt.timedelta(days=7 * week + rng.random() * 6.9)))
    summ = spark.createDataFrame([(1, "NEGATIVE"), (2, "POSITIVE"), (3, "NEGATIVE")], "topic int, sentiment string")
    summ = summ.withColumn("sentiment", F.when(F.col("sentiment") == "NEGATIVE", F.lit(TR.NEGATIVE)).otherwise(F.lit("other")))
    src, out, state, ckpt = (str(tmp_path / x) for x in ("src", "out", "state", "ckpt"))
    stream = lambda: spark.readStream.schema("topic int, ts timestamp").option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true").parquet(src)
    rows.sort(key=lambda r: r[1])
    cut = [0, len(rows) // 3, 2 * len(rows) // 3, len(rows)]
    for k in range(3):  # three runs of the query, each goes on where the one before stopped
        events(spark, src, k, rows[cut[k]: cut[k + 1]])
        negative_spikes_stream(stream(), summ, out, state, ckpt, 1.5, 2, watermark="7 days").awaitTermination()
    got = sorted((r.topic, r.period, r["count"], r.trailing_mean, r.spike) for r in spark.read.parquet(out).collect())
    df = spark.createDataFrame(rows, "topic int, ts timestamp")
    closed = max(r[1] for r in rows) - dt.timedelta(days=7)
    trend = TR.topic_trend(df)
    want = sorted((r.topic, r.period, r["count"], r.trailing_mean, r.spike) for r in TR.negative_spikes(trend, summ, 1.5, 2).collect()
                  if r.period + dt.timedelta(days=7) <= closed)
    assert got == want and any(x[4] for x in got) and {x[0] for x in got} == {1, 3}


def test_a_lexicon_that_tasks_can_hold_shuffles_no_text(spark, monkeypatch):
    """n-grams and tokens used to be shuffled whatever the size of the lexicon; both ways give the same units."""
    texts = ["Éa b C d e, a b. c d", "ΟΔΟΣ b c", "x", "", None, "a b a b c a", "b c D e f g . a  b c d e f g"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, clean string")
    lex = spark.createDataFrame([(p,) for p in ("a b", "a b c", "c d e", "b c", "d e f g", "οδος b", "a b c d e", "x", "éa b", None)], "phrase string")
    done = PH.segment_words(df, lex)
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()
    got = sorted(done.collect())
    assert got[0].clean == "Éa_b C_d_e , a_b . c d" and got[1].clean == "ΟΔΟΣ_b c"
    monkeypatch.setattr(PH, "LEXICON_BYTES", 0)
    assert sorted(PH.segment_words(df, lex).collect()) == got
