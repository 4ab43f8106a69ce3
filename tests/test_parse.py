"""Reply parsing and priority fixtures."""
from feedlens.operators import summarize as S


def _parse(spark, text):
    from feedlens.functions.parse import parse_response

    df = spark.createDataFrame([(1, text)], "topic int, response string")
    r = S.parse_replies(df).first()
    one = df.select(parse_response("response").alias("p")).first().p
    assert (one.sentiment, one.summary) == (r.sentiment, r.summary)
    return r.sentiment, r.summary


def test_parse_cases(spark):
    cases = [
        ("CẢM XÚC: tích cực\nTÓM TẮT: A\nB", "Tích cực", "A B"),
        ("CẢM XÚC: tích cực | tiêu cực\nTÓM TẮT: A", "Tiêu cực", "A"),
        ("Sentiment: positive\nSentiment: neutral\nSummary: A: b", "Trung lập", "A: b"),
        ("xin chào", "Trung lập", "xin chào"),
        ("CẢM XÚC: tiêu cực", "Tiêu cực", "CẢM XÚC: tiêu cực"),
        ("cam xuc tieu cuc", "Trung lập", "cam xuc tieu cuc"),
        ("TÓM TẮT:\n\n  dòng hai  ", "Trung lập", "dòng hai"),
        ("", "Trung lập", ""),
    ]
    for text, sent, summ in cases:
        assert _parse(spark, text) == (sent, summ), text


def test_priority(spark):
    def prio(rows):
        df = spark.createDataFrame(rows, "topic int, count long, sentiment string")
        return {r.topic: r.priority for r in S.add_priority(df).collect()}
    p = prio([(0, 10, "Tiêu cực"), (1, 4, "Tiêu cực"), (2, 4, "Tích cực")])
    assert p == {0: "Cao", 1: "Trung bình", 2: "Thấp"}
    assert prio([(0, 6, "Tiêu cực"), (1, 6, "Tiêu cực")]) == {0: "Cao", 1: "Cao"}
    p = prio([(0, 10, "Tiêu cực"), (1, 4, "Tích cực"), (2, 4, "Tích cực"), (-1, 100, "Tiêu cực")])
    assert p[0] == "Cao"


def test_prompt_substitution_order(spark):
    words = spark.createDataFrame([(0, 1, "a"), (0, 2, "b")], "topic int, rank int, word string")
    docs = spark.createDataFrame([(0, 1, "x"), (0, 2, "y [KEYWORDS]")], "topic int, rank int, clean string")
    p = S.build_prompts(words, docs, "D:[DOCUMENTS] K:[KEYWORDS]", answer_format="").first()
    assert p.prompt == "D:x\ny a, b K:a, b"


def test_generate_errors_do_not_fail(spark):
    prompts = spark.createDataFrame([(0, "ok"), (1, "bad")], "topic int, prompt string")

    def backend(p):
        if p == "bad":
            raise RuntimeError("boom")
        return "CẢM XÚC: tiêu cực\nTÓM TẮT: fine"
    out = {r.topic: (r.response, r.ok) for r in S.generate(prompts, backend, pause=0.0).collect()}
    assert out[0] == ("CẢM XÚC: tiêu cực\nTÓM TẮT: fine", True)
    assert out[1][0] == "[ERROR: boom]" and out[1][1] is False


def _topic_tables(spark):
    """Topic 1 has documents but no word of its own (its words are too short for the tokens)."""
    info = spark.createDataFrame([(-1, 2, "-1_"), (0, 6, "0_size"), (1, 4, "1_")], "topic int, count long, name string")
    words = spark.createDataFrame([(0, 1, "size"), (0, 2, "fit")], "topic int, rank int, word string")
    docs = spark.createDataFrame([(0, 1, "size fit"), (1, 1, "k m")], "topic int, rank int, clean string")
    return info, words, docs


def test_topic_without_keywords_stays(spark):
    info, words, docs = _topic_tables(spark)
    prompts = S.build_prompts(words, docs, "D:[DOCUMENTS] K:[KEYWORDS]", answer_format="", topics=info)
    assert {r.topic: r.prompt for r in prompts.collect()} == {0: "D:size fit K:size, fit", 1: "D:k m K:"}
    replies = spark.createDataFrame([(0, "CẢM XÚC: tiêu cực\nTÓM TẮT: A")], "topic int, response string")
    got = {r.topic: (r.keywords, r.summary, r.sentiment, r.priority) for r in S.summarize_topics(info, words, replies).collect()}
    assert got == {0: ("size | fit", "A", "Tiêu cực", "Cao"), 1: ("", "", "Trung lập", "Thấp")}


def test_backend_runs_once_a_prompt_and_the_cache_fills(spark, tmp_path):
    info, words, docs = _topic_tables(spark)
    prompts = S.build_prompts(words, docs, topics=info)
    seen, path = str(tmp_path / "calls"), str(tmp_path / "cache")

    def backend(p):
        with open(seen, "a") as f:
            f.write("call\n")
        return "CẢM XÚC: tiêu cực\nTÓM TẮT: once"

    def calls():
        return sum(1 for _ in open(seen))

    responses, new = S.respond_cached(prompts, backend, None, "b")
    for _ in range(2):
        assert S.summarize_topics(info, words, responses).count() == 2
    S.append_cache(new, path)
    assert calls() == 2
    again, new = S.respond_cached(prompts, backend, S.read_cache(spark, path), "b")
    assert all(r.cached and r.response.endswith("once") for r in again.collect()) and new.count() == 0 and calls() == 2


def test_retries_pause_between_tries():
    tries = []

    def backend(p):
        tries.append(p)
        if len(tries) < 3:
            raise ValueError("not yet")
        return " done "
    assert S.ask(backend, "p", [0, 0]) == ("done", True) and len(tries) == 3
    tries.clear()
    assert S.ask(backend, "p", [0]) == ("[ERROR: not yet]", False) and len(tries) == 2
