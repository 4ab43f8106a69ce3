"""Registered queries: one per operator of the inventory.

``QUERIES[name] = fn(spark, sf_dir) -> DataFrame`` and, where the operator is
expressible in SQL, ``ORACLE[name]`` holds the DuckDB statement that must give
the same rows (doubles rounded to 6 places on both sides).
"""
from __future__ import annotations

import re

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..session import cut_lineage
from ..operators import text as T
from ..operators import topics as TP
from . import fixtures as FX
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- sources
@register("ingest_project", f"WITH {O.FEEDBACK} SELECT doc_id, text FROM fb")
def q_ingest_project(spark, sf):
    return FX.feedback(spark, sf)


# ---------------------------------------------------------------- text prep
@register("clean_text", f"SELECT doc_id::BIGINT AS doc_id, {O.clean('text')} AS clean FROM documents")
def q_clean_text(spark, sf):
    return FX.feedback(spark, sf).select("doc_id", clean_text("text").alias("clean"))


@register("remove_stopwords", f"SELECT doc_id::BIGINT AS doc_id, {O.stop(O.clean('text'))} AS clean FROM documents")
def q_remove_stopwords(spark, sf):
    df = FX.feedback(spark, sf).select("doc_id", clean_text("text").alias("clean"))
    return T.remove_stopwords(df)


@register("stopwords_word_tokens",
          "SELECT doc_id::BIGINT AS doc_id, array_to_string(list_filter("
          f"{O.tokens('text', O.WORD_ANY)}, lambda t: NOT list_contains({O.STOP_LIST}, t)), ' ') AS clean FROM documents")
def q_stopwords_word_tokens(spark, sf):
    return T.remove_stopwords_words(FX.feedback(spark, sf)).select("doc_id", "clean")


@register("filter_min_chars",
          f"WITH c AS (SELECT doc_id::BIGINT AS doc_id, {O.stop(O.clean('text'))} AS clean FROM documents) "
          f"SELECT doc_id FROM c WHERE {O.min_chars('clean', 300)}")
def q_filter_min_chars(spark, sf):
    df = T.remove_stopwords(FX.feedback(spark, sf).select("doc_id", clean_text("text").alias("clean")))
    return T.filter_min_chars(df, 300).select("doc_id")


@register("dedup_first",
          f"WITH c AS (SELECT doc_id::BIGINT AS doc_id, {O.clean('text')} AS clean FROM documents) "
          "SELECT doc_id, clean FROM (SELECT *, row_number() OVER (PARTITION BY clean ORDER BY doc_id) AS rn FROM c) WHERE rn = 1")
def q_dedup_first(spark, sf):
    df = FX.feedback(spark, sf).select("doc_id", clean_text("text").alias("clean"))
    return T.dedup_first(df, "clean", "doc_id")


@register("preprocess", f"WITH {O.PREPARED} SELECT doc_id, text, clean FROM pre")
def q_preprocess(spark, sf):
    return FX.prepared(spark, sf)


# ---------------------------------------------------------------- topic words
def _term_counts(spark, sf, docs=None):
    """Topic-term counts written once: c-TF-IDF reads them three times (scores,
    topic totals, word totals).  Exchange reuse cannot be relied on to share
    the tokenising pass -- the optimizer infers a null filter on the join key
    of one consumer only, so the branches no longer match."""
    if docs is None:
        docs = FX.prepared_with_topics(spark, sf)
    return cut_lineage(TP.term_counts(docs))


def _parts(spark, sf):
    """Shared subplans written once: the prepared documents (read again by
    the joins that fetch text), the documents' words in chunks (term counts,
    weights) and the topic-term counts (see ``_term_counts``)."""
    docs = cut_lineage(FX.prepared_with_topics(spark, sf, keep_text=False))
    dt = TP.topic_terms(docs)
    tc = cut_lineage(TP.term_counts_from(dt))
    idf = TP.idf_table(tc)
    scores = TP.ctfidf(tc, idf)
    words = TP.top_words(scores, 10)
    return docs, dt, tc, scores, idf, words


@register("term_counts", f"WITH {O.CTFIDF} SELECT topic, word, n FROM tc")
def q_term_counts(spark, sf):
    return TP.term_counts(FX.prepared_with_topics(spark, sf))


@register("ctfidf", f"WITH {O.CTFIDF} SELECT topic, word, n, round(score, 6) AS score FROM sc")
def q_ctfidf(spark, sf):
    tc = _term_counts(spark, sf)
    return TP.ctfidf(tc).withColumn("score", r6("score"))


@register("top_words",
          f"WITH {O.CTFIDF} SELECT topic, rank::INTEGER AS rank, word, round(score, 6) AS score FROM tw WHERE rank <= 10")
def q_top_words(spark, sf):
    tc = _term_counts(spark, sf)
    return TP.top_words(TP.ctfidf(tc), 10).withColumn("score", r6("score"))


@register("topic_info",
          f"WITH {O.CTFIDF}, cnt AS (SELECT topic, count(*)::BIGINT AS count FROM pt0 GROUP BY topic), "
          f"nm AS ({O.words_joined('tw', 4, '_', 'w')}) "
          "SELECT topic, count, concat_ws('_', topic::VARCHAR, w) AS name FROM cnt LEFT JOIN nm USING (topic)")
def q_topic_info(spark, sf):
    docs = cut_lineage(FX.prepared_with_topics(spark, sf))
    words = TP.top_words(TP.ctfidf(_term_counts(spark, sf, docs)), 10)
    return TP.topic_info(docs.select("doc_id", "topic"), words)


REP_DOCS_SQL = (
    f"WITH {O.CTFIDF},\n"
    f"dt AS (SELECT doc_id, topic, word, count(*) AS tf FROM (SELECT doc_id, topic, unnest({O.tokens('clean')}) AS word FROM pt0) GROUP BY ALL),\n"
    "dl AS (SELECT doc_id, sum(tf) AS len FROM dt GROUP BY doc_id),\n"
    "dw AS (SELECT doc_id, topic, word, tf / len * idf AS wd FROM dt JOIN dl USING (doc_id) JOIN idf USING (word)),\n"
    "tn AS (SELECT topic, sqrt(sum(score * score)) AS tn FROM sc GROUP BY topic),\n"
    "pd AS (SELECT dw.doc_id, dw.topic, sum(coalesce(wd * score, 0.0)) AS dot, sqrt(sum(wd * wd)) AS dn "
    "FROM dw LEFT JOIN sc ON dw.topic = sc.topic AND dw.word = sc.word GROUP BY dw.doc_id, dw.topic),\n"
    "sim AS (SELECT doc_id, topic, dot / (dn * tn) AS similarity FROM pd JOIN tn USING (topic)),\n"
    "rk AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(similarity, 9) DESC, doc_id) AS rank FROM sim)\n"
)


@register("representative_docs",
          REP_DOCS_SQL + "SELECT topic, rank::INTEGER AS rank, doc_id, round(similarity, 6) AS similarity FROM rk WHERE rank <= 5")
def q_representative_docs(spark, sf):
    docs, dt, _, scores, idf, _ = _parts(spark, sf)
    return (TP.representative_docs(docs, scores, idf, 5, terms=dt)
              .select("topic", "rank", "doc_id", r6("similarity").alias("similarity")))


@register("topic_differences",
          f"WITH {O.CTFIDF}, "
          "fr AS (SELECT topic, word, row_number() OVER (PARTITION BY topic ORDER BY n DESC, word) AS rank FROM tc), "
          f"b AS ({O.words_joined('tw', 5, ' | ', 'original')}), a AS ({O.words_joined('fr', 5, ' | ', 'updated')}) "
          "SELECT topic, original, updated FROM b JOIN a USING (topic) WHERE topic >= 0 AND topic < 5")
def q_topic_differences(spark, sf):
    """c-TF-IDF keywords against plain frequency keywords for topics 0..4."""
    tc = _term_counts(spark, sf)
    before = TP.top_words(TP.ctfidf(tc), 10)
    after = TP.top_words(tc.withColumn("score", F.col("n").cast("double")), 10)
    return TP.topic_differences(before, after, 5)


RAW_LABELS = (
    "WITH raw AS (SELECT doc_id::BIGINT AS doc_id, (CASE WHEN n_chars < 200 THEN -1 "
    "ELSE CAST(substr(source, 4) AS INTEGER) END)::INTEGER AS topic FROM documents)"
)


def _raw_labels(spark, sf):
    d = FX.documents(spark, sf)
    return d.select("doc_id", F.when(F.col("n_chars") < 200, F.lit(-1))
                    .otherwise(F.substring("source", 4, 10).cast("int")).cast("int").alias("topic"))


@register("relabel_by_size",
          RAW_LABELS + ", sz AS (SELECT topic, count(*) AS n, min(doc_id) AS first FROM raw WHERE topic <> -1 GROUP BY topic), "
          "mp AS (SELECT topic, (row_number() OVER (ORDER BY n DESC, first) - 1)::INTEGER AS new FROM sz) "
          "SELECT doc_id, coalesce(new, -1)::INTEGER AS topic FROM raw LEFT JOIN mp USING (topic)")
def q_relabel_by_size(spark, sf):
    """Clusters labelled by source id (noise under 200 chars) renumbered by size."""
    return TP.relabel_by_size(_raw_labels(spark, sf))


@register("run_stats",
          RAW_LABELS + " SELECT count(*)::BIGINT AS total, count(DISTINCT CASE WHEN topic <> -1 THEN topic END)::BIGINT AS n_topics, "
          "count(*) FILTER (WHERE topic = -1)::BIGINT AS n_noise FROM raw")
def q_run_stats(spark, sf):
    return TP.run_stats(_raw_labels(spark, sf))


# ---------------------------------------------------------------- summaries and triage
from ..operators import report as R  # noqa: E402
from ..operators import summarize as S  # noqa: E402


def _topic_parts(spark, sf, rep: bool = True):
    """Topic-level tables checkpointed once (bounded by topics x vocabulary);
    representative documents, the dearest part, only where ``rep`` asks for them."""
    docs, dt, tc, scores, idf, words = _parts(spark, sf)
    idf = cut_lineage(idf)
    scores = cut_lineage(TP.ctfidf(tc, idf))
    words = cut_lineage(TP.top_words(scores, 10))
    info = cut_lineage(TP.topic_info(docs.select("doc_id", "topic"), words))
    reps = cut_lineage(TP.representative_docs(docs, scores, idf, 5, terms=dt)) if rep else None
    return docs, tc, scores, words, info, reps


def _canned(words):
    kw = TP.ordered_words(words, 5, ", ", "kw")
    return kw.filter(F.col("topic") != TP.NOISE).select("topic", FX.canned_reply("topic", "kw").alias("response"))


_TPL, _FMT = O.template_sql()
PROMPTS_SQL = (
    REP_DOCS_SQL.rstrip("\n") + ",\n"
    f"kw10 AS ({O.words_joined('tw', 10, ', ', 'kw')}),\n"
    "dd AS (SELECT topic, string_agg(clean, chr(10) ORDER BY rank) AS docs FROM rk JOIN pre USING (doc_id) WHERE rank <= 5 GROUP BY topic),\n"
    f"pr AS (SELECT topic, replace(replace({_TPL}, '[DOCUMENTS]', coalesce(docs, '')), '[KEYWORDS]', kw) || {_FMT} AS prompt "
    "FROM kw10 LEFT JOIN dd USING (topic) WHERE topic <> -1),\n"
    "prompts AS (SELECT topic, prompt, md5(prompt) AS prompt_hash FROM pr),\n"
    "cnt AS (SELECT topic, count(*)::BIGINT AS count FROM pt0 GROUP BY topic),\n"
    f"kw5 AS ({O.words_joined('tw', 5, ', ', 'kw')}),\n"
    f"canned AS (SELECT topic, {O.CANNED_REPLY} AS response FROM kw5 WHERE topic <> -1),\n"
    f"kwp AS ({O.words_joined('tw', 5, ' | ', 'keywords')}),\n"
)
_SENT, _SUMM = O.parse_sql("response")
SUMMARY_SQL = (
    PROMPTS_SQL +
    f"parsed AS (SELECT topic, {_SENT} AS sentiment, {_SUMM} AS summary FROM canned),\n"
    "mean AS (SELECT coalesce(avg(count), 0.0) AS m FROM cnt WHERE topic <> -1),\n"
    "summ AS (SELECT topic::INTEGER AS topic, coalesce(keywords, '') AS keywords, summary, sentiment, "
    "CASE WHEN sentiment = 'Tiêu cực' AND count >= m THEN 'Cao' WHEN sentiment = 'Tiêu cực' THEN 'Trung bình' ELSE 'Thấp' END AS priority, "
    "count FROM cnt JOIN parsed USING (topic) LEFT JOIN kwp USING (topic), mean WHERE topic <> -1)\n"
)


@register("build_prompts", PROMPTS_SQL.rstrip(",\n") + "\nSELECT topic::INTEGER AS topic, prompt, prompt_hash FROM prompts")
def q_build_prompts(spark, sf):
    _, _, _, words, _, rep = _topic_parts(spark, sf)
    return S.build_prompts(words, rep).select("topic", "prompt", "prompt_hash")


@register("prompt_cache_split",
          PROMPTS_SQL.rstrip(",\n") + ",\nbig AS (SELECT topic FROM cnt WHERE topic <> -1 AND count >= (SELECT avg(count) FROM cnt WHERE topic <> -1))\n"
          "SELECT topic::INTEGER AS topic, prompt_hash, CASE WHEN topic IN (SELECT topic FROM big) THEN 'hit' ELSE 'miss' END AS status FROM prompts")
def q_prompt_cache_split(spark, sf):
    """Cache = responses stored earlier for the topics at or above the mean size."""
    docs, _, _, words, info, rep = _topic_parts(spark, sf)
    prompts = S.build_prompts(words, rep)
    big = S.add_priority(info.filter("topic <> -1").withColumn("sentiment", F.lit("Tiêu cực"))).filter("priority = 'Cao'")
    cache = (prompts.join(big.select("topic"), "topic", "left_semi")
                    .select("prompt_hash", "prompt", F.lit("cached").alias("response"), F.lit(None).cast("string").alias("backend_id")))
    hits, misses = S.cache_split(prompts, cache)
    return (hits.select("topic", "prompt_hash", F.lit("hit").alias("status"))
                .unionByName(misses.select("topic", "prompt_hash", F.lit("miss").alias("status"))))


_RAW = ("(CASE doc_id % 8 WHEN 0 THEN 'CẢM XÚC: tích cực' || chr(10) || 'TÓM TẮT: ' || text "
        "WHEN 1 THEN 'cảm xúc: tích cực | tiêu cực' || chr(10) || text "
        "WHEN 2 THEN 'Sentiment: positive' || chr(10) || 'Sentiment: neutral' || chr(10) || 'Summary: ' || text "
        "WHEN 3 THEN 'TÓM TẮT:' || chr(10) || chr(10) || text "
        "WHEN 4 THEN 'cam xuc tieu cuc' || chr(10) || text "
        "WHEN 5 THEN 'CAM XUC: Negative' "
        "WHEN 6 THEN chr(13) || chr(10) || ' tom tat : ' || text || chr(8232) || 'sentiment:' "
        "ELSE text END)")
_PSENT, _PSUMM = O.parse_sql("raw")


@register("parse_response",
          f"WITH r AS (SELECT doc_id::BIGINT AS doc_id, {_RAW} AS raw FROM documents) "
          f"SELECT doc_id, {_PSENT} AS sentiment, {_PSUMM} AS summary FROM r")
def q_parse_response(spark, sf):
    """Replies wrapping each whole document in one of eight reply shapes."""
    from ..session import spread
    d = spread(FX.documents(spark, sf).select("doc_id", "text"))
    k = F.col("doc_id") % 8
    t = F.col("text")
    nl = F.lit("\n")
    raw = (F.when(k == 0, F.concat(F.lit("CẢM XÚC: tích cực\nTÓM TẮT: "), t))
            .when(k == 1, F.concat(F.lit("cảm xúc: tích cực | tiêu cực"), nl, t))
            .when(k == 2, F.concat(F.lit("Sentiment: positive\nSentiment: neutral\nSummary: "), t))
            .when(k == 3, F.concat(F.lit("TÓM TẮT:\n\n"), t))
            .when(k == 4, F.concat(F.lit("cam xuc tieu cuc\n"), t))
            .when(k == 5, F.lit("CAM XUC: Negative"))
            .when(k == 6, F.concat(F.lit("\r\n tom tat : "), t, F.lit("\u2028sentiment:")))
            .otherwise(t))
    p = S.parse_replies(d.select("doc_id", raw.alias("response")))
    return p.select("doc_id", "sentiment", "summary")


@register("priority_label", SUMMARY_SQL + "SELECT topic, count, sentiment, priority FROM summ")
def q_priority_label(spark, sf):
    _, _, _, words, info, _ = _topic_parts(spark, sf, rep=False)
    parsed = S.parse_replies(_canned(words))
    base = info.filter("topic <> -1").select("topic", "count").join(parsed.select("topic", "sentiment"), "topic")
    return S.add_priority(base).select("topic", "count", "sentiment", "priority")


@register("summarize_topics", SUMMARY_SQL + "SELECT topic, keywords, summary, sentiment, priority FROM summ")
def q_summarize_topics(spark, sf):
    _, _, _, words, info, _ = _topic_parts(spark, sf, rep=False)
    return S.summarize_topics(info, words, _canned(words))


@register("topics_only",
          f"WITH {O.CTFIDF}, cnt AS (SELECT topic, count(*)::BIGINT AS count FROM pt0 GROUP BY topic), "
          f"nm AS ({O.words_joined('tw', 4, '_', 'w')}) "
          "SELECT topic, concat_ws('_', topic::VARCHAR, w) AS keywords FROM cnt LEFT JOIN nm USING (topic) WHERE topic <> -1")
def q_topics_only(spark, sf):
    _, _, _, _, info, _ = _topic_parts(spark, sf, rep=False)
    return S.topics_only(info)


@register("topic_representations",
          PROMPTS_SQL.rstrip(",\n") + f"\nSELECT topic::INTEGER AS topic, coalesce(keywords, '') AS original_keywords, "
          f"{O.strip('response')} AS text_representation FROM canned LEFT JOIN kwp USING (topic)")
def q_topic_representations(spark, sf):
    _, _, _, words, _, _ = _topic_parts(spark, sf, rep=False)
    return S.topic_representations(words, _canned(words))


EXTRACT_SQL = (
    PROMPTS_SQL +
    "top1 AS (SELECT topic, clean FROM rk JOIN pre USING (doc_id) WHERE rank = 1),\n"
    f"sl AS (SELECT topic, list_filter(list_transform(regexp_extract_all(clean, '[^.!?\\n]+[.!?]*'), lambda s: {O.strip('s')}), lambda s: s <> '') AS ss FROM top1),\n"
    "sn AS (SELECT topic, unnest(ss) AS sentence, generate_subscripts(ss, 1) AS pos FROM sl),\n"
    f"tk AS (SELECT topic, pos, unnest({O.tokens('sentence')}) AS word FROM sn),\n"
    "ts AS (SELECT tk.topic, tk.pos, avg(coalesce(sc.score, 0.0)) AS w FROM tk LEFT JOIN sc ON tk.topic = sc.topic AND tk.word = sc.word GROUP BY ALL),\n"
    "sw AS (SELECT sn.topic, sn.pos, sn.sentence, coalesce(ts.w, 0.0) AS w FROM sn LEFT JOIN ts ON sn.topic = ts.topic AND sn.pos = ts.pos),\n"
    "best AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(w, 12) DESC, pos) AS r FROM sw)\n"
)


@register("extractive_summary",
          EXTRACT_SQL + "SELECT topic::INTEGER AS topic, 'CẢM XÚC: trung lập' || chr(10) || 'TÓM TẮT: ' || sentence AS response "
          "FROM best WHERE r = 1 AND topic IN (SELECT topic FROM prompts)")
def q_extractive_summary(spark, sf):
    _, _, scores, words, _, rep = _topic_parts(spark, sf)
    prompts = S.build_prompts(words, rep)
    backend = S.extractive_backend(rep, scores)
    return backend(prompts).select(F.col("topic").cast("int").alias("topic"), "response")


def _flaky_backend(prompt: str) -> str:
    """Deterministic stand-in for a remote model: fails on prompts of odd length."""
    if len(prompt) % 2:
        raise RuntimeError("backend unavailable")
    return "CẢM XÚC: trung lập\nTÓM TẮT: " + prompt.split("\n", 2)[1][:0] + "ok"


@register("generate_with_errors",
          PROMPTS_SQL.rstrip(",\n") + "\nSELECT topic::INTEGER AS topic, "
          "CASE WHEN length(prompt) % 2 = 1 THEN '[ERROR: backend unavailable]' "
          "ELSE 'CẢM XÚC: trung lập' || chr(10) || 'TÓM TẮT: ok' END AS response, "
          "length(prompt) % 2 = 0 AS ok FROM prompts")
def q_generate_with_errors(spark, sf):
    """Python backend on executors with retries; failures become [ERROR: ...] rows."""
    _, _, _, words, _, rep = _topic_parts(spark, sf)
    prompts = S.build_prompts(words, rep)
    out = S.generate(prompts, _flaky_backend, batch_size=2, max_retries=2, pause=0.0)
    return out.select("topic", "response", "ok")


@register("generate_resumable",
          PROMPTS_SQL.rstrip(",\n") + "\nSELECT topic::INTEGER AS topic, "
          "CASE WHEN length(prompt) % 2 = 1 THEN '[ERROR: backend unavailable]' "
          "ELSE 'CẢM XÚC: trung lập' || chr(10) || 'TÓM TẮT: ok' END AS response, "
          "length(prompt) % 2 = 0 AS ok, length(prompt) % 2 = 0 AND topic % 2 = 0 AS cached FROM prompts")
def q_generate_resumable(spark, sf):
    """Replies stored as they arrive: a first run over the even topics, then one over all, which asks for the rest."""
    from ..operators import replies as RP
    _, _, _, words, _, rep = _topic_parts(spark, sf)
    prompts = cut_lineage(S.build_prompts(words, rep))
    store = scratch_path(spark, "replies")
    cut_lineage(RP.generate_resumable(prompts.where("topic % 2 = 0"), _flaky_backend, store, batch_size=2, max_retries=1, pause=0.0))
    out = cut_lineage(RP.generate_resumable(prompts, _flaky_backend, store, batch_size=2, max_retries=1, pause=0.0))
    return out.select("topic", "response", "ok", "cached")


REPORT_SQL = (
    SUMMARY_SQL.rstrip("\n") + ",\n"
    f"kw6 AS ({O.words_joined('tw', 6, ' · ', 'keywords')}),\n"
    "dd5 AS (SELECT topic, string_agg(clean, chr(10) ORDER BY rank) AS docs FROM rk JOIN pre USING (doc_id) WHERE rank <= 5 GROUP BY topic),\n"
    "big AS (SELECT topic FROM cnt, mean WHERE topic <> -1 AND count >= m),\n"
    "rep AS (SELECT c.topic::INTEGER AS topic, c.count, coalesce(k.keywords, '') AS keywords, "
    "coalesce(s.summary, '') AS summary, coalesce(s.sentiment, '') AS sentiment, coalesce(s.priority, '') AS priority, "
    "coalesce(d.docs, '') AS docs FROM cnt c LEFT JOIN kw6 k USING (topic) LEFT JOIN dd5 d USING (topic) "
    "LEFT JOIN (SELECT * FROM summ WHERE topic IN (SELECT topic FROM big)) s USING (topic) WHERE c.topic <> -1)\n"
)


def _report(spark, sf):
    """Report where only topics at or above the mean size have a summary."""
    _, _, _, words, info, rep = _topic_parts(spark, sf)
    summ = S.summarize_topics(info, words, _canned(words))
    big = S.add_priority(info.filter("topic <> -1").withColumn("sentiment", F.lit("Tiêu cực"))).filter("priority = 'Cao'")
    return R.topic_report(info, words, rep, summ.join(big.select("topic"), "topic", "left_semi"))


@register("topic_report", REPORT_SQL + "SELECT * FROM rep")
def q_topic_report(spark, sf):
    return _report(spark, sf).withColumn("docs", F.array_join("docs", "\n"))


@register("topic_sizes",
          REPORT_SQL + "SELECT topic, count, keywords, '#' || topic::VARCHAR || '  ' || split_part(keywords, ' · ', 1) AS label FROM rep")
def q_topic_sizes(spark, sf):
    return R.topic_sizes(_report(spark, sf))


@register("localize_report",
          REPORT_SQL + "SELECT topic AS \"Topic\", count AS \"Feedback count\", "
          "CASE priority WHEN 'Cao' THEN 'High' WHEN 'Trung bình' THEN 'Medium' WHEN 'Thấp' THEN 'Low' ELSE '' END AS \"Priority\", "
          "CASE sentiment WHEN 'Tích cực' THEN 'Positive' WHEN 'Tiêu cực' THEN 'Negative' WHEN 'Trung lập' THEN 'Neutral' ELSE '' END AS \"Sentiment\", "
          "keywords AS \"Keywords\", summary AS \"Summary\" FROM rep")
def q_localize_report(spark, sf):
    return R.localize(_report(spark, sf), "en")


# ---------------------------------------------------------------- vectors, neighbours, clusters
from ..operators import cluster as CL  # noqa: E402
from ..operators import lists as LS  # noqa: E402
from ..operators import embed as EM  # noqa: E402
from ..operators import neighbors as NB  # noqa: E402
from ..operators import reduce as RD  # noqa: E402
from ..operators.terms import chunked_terms  # noqa: E402
from ..session import table as _table  # noqa: E402

HASH_DIM = 64
HV_SQL = f"WITH {O.PREPARED},\n{O.hashed_vectors(HASH_DIM)}\n"


def _hashed(spark, sf):
    """Hashed vectors of the prepared documents.  The encoder reads the
    documents twice (tokens, document count), so they are written once instead
    of being cleaned and deduplicated twice."""
    return EM.encode_hashed(cut_lineage(FX.prepared(spark, sf, keep_text=False)), HASH_DIM)


def _embeddings(spark, sf):
    return _table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"),
                                                   F.col("embedding").cast("array<double>").alias("vec"))


@register("embed_hashed", HV_SQL + "SELECT doc_id, dim, round(value, 6) AS value FROM hv")
def q_embed_hashed(spark, sf):
    return EM.vector_long(_hashed(spark, sf)).withColumn("value", r6("value"))


@register("embed_cache_misses",
          f"WITH {O.PREPARED}, cached AS (SELECT sha256(p.clean) AS k FROM pre p JOIN labels l ON p.doc_id = l.doc_id) "
          "SELECT doc_id, CASE WHEN sha256(clean) IN (SELECT k FROM cached) THEN 'hit' ELSE 'miss' END AS status FROM pre")
def q_embed_cache_misses(spark, sf):
    """Cache = vectors of the labelled documents from an earlier run; encode the rest."""
    pre = cut_lineage(FX.prepared(spark, sf))
    labelled = pre.join(_table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    cache = EM.encode_hashed(labelled, HASH_DIM).join(labelled, "doc_id").select(EM.text_key("clean").alias("text_key"), "vec")
    vecs, _ = EM.embed_cached(pre, cache, lambda m: EM.encode_hashed(m, HASH_DIM))
    return vecs.select("doc_id", F.when(F.col("cached"), F.lit("hit")).otherwise(F.lit("miss")).alias("status"))


def _rp_sql(src: str, idc: str, vcol: str, k: int, dim: int, seed: int = 42) -> str:
    sign = (f"CASE WHEN (({O.md5_int(f"'{seed}:' || d.i::VARCHAR || ':' || c.i::VARCHAR")} >> 16) & 1) = 1 "
            "THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END")
    return (f"rm AS (SELECT d.i AS d, c.i AS c, {sign} / sqrt({k}) AS r FROM range({dim}) d(i), range({k}) c(i)),\n"
            f"ux AS (SELECT {idc} AS id, unnest({vcol}) AS x, generate_subscripts({vcol}, 1) - 1 AS d FROM {src}),\n"
            "rp AS (SELECT id, c::INTEGER AS comp, sum(x * r) AS value FROM ux JOIN rm USING (d) GROUP BY id, c)")


@register("reduce_random",
          f"WITH {O.EMB},\n" + _rp_sql("ev", "id", "v", 5, 64) + "\nSELECT id AS doc_id, comp, round(value, 6) AS value FROM rp")
def q_reduce_random(spark, sf):
    r = RD.reduce_random(_embeddings(spark, sf), 64, 5)
    return EM.vector_long(r, vec="rvec", name="comp").withColumn("value", r6("value"))


@register("reduce_pca")
def q_reduce_pca(spark, sf):
    r = RD.reduce_pca(_embeddings(spark, sf), 5)
    return EM.vector_long(r, vec="rvec", name="comp")


@register("document_map",
          HV_SQL + ",\n" + O.FIXTURE_TOPICS + ",\n" + _rp_sql("dv", "doc_id", "v", 2, HASH_DIM) +
          "\nSELECT p.id AS doc_id, round(max(CASE WHEN comp = 0 THEN value END), 6) AS x, round(max(CASE WHEN comp = 1 THEN value END), 6) AS y, "
          "coalesce(max(f.topic), -1)::INTEGER AS topic FROM rp p LEFT JOIN ft f ON p.id = f.doc_id GROUP BY p.id")
def q_document_map(spark, sf):
    m = RD.document_map(_hashed(spark, sf), FX.fixture_topics(spark, sf), HASH_DIM)
    return m.select("doc_id", r6("x").alias("x"), r6("y").alias("y"), "topic")


@register("knn_exact", f"WITH {O.EMB_PAIRS} SELECT src, dst, rank::INTEGER AS rank, round(dist, 6) AS dist FROM ek WHERE rank <= 4")
def q_knn_exact(spark, sf):
    return NB.knn(_embeddings(spark, sf), 4, 64).withColumn("dist", r6("dist"))


@register("core_distance",
          f"WITH {O.EMB_PAIRS} SELECT src AS id, round(dist, 6) AS core FROM ek WHERE rank = 3")
def q_core_distance(spark, sf):
    return CL.core_distance(NB.knn(_embeddings(spark, sf), 3, 64), 3).withColumn("core", r6("core"))


@register("mutual_reachability",
          f"WITH {O.EMB_PAIRS}, core AS (SELECT src AS id, dist AS core FROM ek WHERE rank = 3) "
          "SELECT e.src, e.dst, round(greatest(c1.core, c2.core, e.dist), 6) AS mreach FROM ek e "
          "JOIN core c1 ON e.src = c1.id JOIN core c2 ON e.dst = c2.id WHERE e.rank <= 4")
def q_mutual_reachability(spark, sf):
    emb = _embeddings(spark, sf)
    nn = NB.knn(emb, 4, 64)
    core = CL.core_distance(nn, 3)
    return CL.mutual_reachability(nn, core).select("src", "dst", r6("mreach").alias("mreach"))


DENSITY_SQL = (
    HV_SQL + ",\n"
    "pr AS (SELECT a.doc_id AS src, b.doc_id AS dst, "
    "sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS dist "
    "FROM dv a, dv b WHERE a.doc_id <> b.doc_id),\n"
    "e AS (SELECT * FROM pr WHERE dist <= 1.0),\n"
    "core AS (SELECT src AS id, dist AS core FROM (SELECT src, dist, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS r FROM e) WHERE r = 3),\n"
    "mr AS (SELECT e.src, e.dst FROM e JOIN core c1 ON e.src = c1.id JOIN core c2 ON e.dst = c2.id WHERE greatest(c1.core, c2.core, e.dist) <= 1.0),\n"
    "cc AS (SELECT id, min(comp) AS comp FROM (WITH RECURSIVE reach(id, comp) AS (SELECT doc_id, doc_id FROM pre UNION "
    "SELECT m.dst, reach.comp FROM reach JOIN mr m ON reach.id = m.src) SELECT * FROM reach) GROUP BY id),\n"
    "sz AS (SELECT comp, count(*) AS n FROM cc GROUP BY comp)\n"
)


@register("density_cluster_at",
          DENSITY_SQL + "SELECT id AS doc_id, (CASE WHEN n >= 5 THEN comp ELSE -1 END)::BIGINT AS cluster FROM cc JOIN sz USING (comp)")
def q_density_cluster_at(spark, sf):
    """Hashed document vectors clustered at mutual reachability 1.0 (min_samples 3, min size 5)."""
    return CL.density_cluster_at(_hashed(spark, sf), 1.0, HASH_DIM, 3, 5)


@register("spanning_forest",
          f"WITH RECURSIVE {O.EMB_PAIRS}, core AS (SELECT src AS id, dist AS core FROM ek WHERE rank = 3), "
          "mr AS (SELECT least(e.src, e.dst) AS a, greatest(e.src, e.dst) AS b, min(greatest(c1.core, c2.core, e.dist)) AS w FROM ek e "
          "JOIN core c1 ON e.src = c1.id JOIN core c2 ON e.dst = c2.id WHERE e.rank <= 4 GROUP BY 1, 2), "
          "ke AS (SELECT *, row_number() OVER (ORDER BY w, a, b) AS k FROM mr), "
          "und AS (SELECT a AS x, b AS y, k FROM ke UNION ALL SELECT b, a, k FROM ke), "
          "reach(k, n) AS (SELECT k, a FROM ke UNION SELECT r.k, u.y FROM reach r JOIN und u ON u.x = r.n AND u.k < r.k) "
          "SELECT a AS src, b AS dst, round(w, 6) AS w FROM ke WHERE NOT EXISTS (SELECT 1 FROM reach r WHERE r.k = ke.k AND r.n = ke.b)")
def q_spanning_forest(spark, sf):
    """Minimum spanning forest of the mutual-reachability kNN graph of the embeddings."""
    emb = _embeddings(spark, sf)
    nn = NB.knn(emb, 4, 64)
    mr = CL.mutual_reachability(nn, CL.core_distance(nn, 3))
    return CL.spanning_forest(emb.select(F.col("doc_id").alias("id")), mr.select("src", "dst", F.col("mreach").alias("w"))).withColumn("w", r6("w"))


@register("analyze_topics")
def q_analyze_topics(spark, sf):
    """End-to-end: documents -> clusters -> keywords -> extractive summaries -> report."""
    from .analyze import analyze
    rep = analyze(FX.documents(spark, sf)).report
    return rep.withColumn("docs", F.array_join("docs", "\n"))


# ---------------------------------------------------------------- incremental and time-based
from ..operators import trends as TR  # noqa: E402

MIN_SIM = 0.1


def _model(spark, sf):
    """Topic model learned on the documents: vocabulary, vectors, language-topic centroids."""
    pre = cut_lineage(FX.prepared(spark, sf, keep_text=False))
    terms = chunked_terms(pre)
    vocab = cut_lineage(EM.hashed_vocab(pre, HASH_DIM, terms=terms))
    vecs = cut_lineage(EM.encode_hashed(pre, HASH_DIM, vocab=vocab, terms=terms))
    cen = cut_lineage(TR.topic_centroids(vecs, FX.fixture_topics(spark, sf), HASH_DIM))
    return pre, vocab, vecs, cen


def _conversations(spark, sf):
    c = _table(spark, sf, "conversations")
    return c.select(F.concat_ws(":", "conv_id", "turn").alias("doc_id"), "conv_id", "turn", "text")


def _conv_vectors(spark, sf, vocab):
    c = _conversations(spark, sf)
    docs = c.select("doc_id", T.remove_stopwords_col(clean_text("text"), T.DEFAULT_STOPWORDS, True).alias("clean"))
    return EM.encode_hashed(docs, HASH_DIM, vocab=vocab)


MODEL_SQL = (
    HV_SQL + ",\n" + O.FIXTURE_TOPICS + ",\n"
    "cen0 AS (SELECT f.topic, h.dim, avg(h.value) AS v FROM hv h JOIN ft f USING (doc_id) WHERE f.topic <> -1 GROUP BY ALL),\n"
    "cnr AS (SELECT topic, sqrt(sum(v * v)) AS nr FROM cen0 GROUP BY topic),\n"
    "cen AS (SELECT topic, list(CASE WHEN nr > 0 THEN v / nr ELSE 0.0 END ORDER BY dim) AS c FROM cen0 JOIN cnr USING (topic) GROUP BY topic),\n"
    f"cv AS (SELECT concat_ws(':', conv_id, turn) AS id, conv_id, turn, {O.stop(O.clean('text'))} AS clean FROM conversations),\n"
    f"ct AS (SELECT id, word, count(*) AS tf FROM (SELECT id, unnest({O.tokens('clean')}) AS word FROM cv) GROUP BY ALL),\n"
    "cb AS (SELECT id, bucket, sum(sign * tf * idf) AS v FROM ct JOIN voc USING (word) GROUP BY ALL),\n"
    "cbn AS (SELECT id, sqrt(sum(v * v)) AS nr FROM cb GROUP BY id),\n"
    f"cdims AS (SELECT c.id, g.i::INTEGER AS dim FROM cv c, range({HASH_DIM}) g(i)),\n"
    "cdense AS (SELECT d.id, d.dim, CASE WHEN n.nr > 0 THEN coalesce(b.v, 0.0) / n.nr ELSE 0.0 END AS v FROM cdims d "
    "LEFT JOIN cb b ON d.id = b.id AND d.dim = b.bucket LEFT JOIN cbn n ON d.id = n.id),\n"
    "cvec AS (SELECT id, list(v ORDER BY dim) AS x FROM cdense GROUP BY id),\n"
    "csim AS (SELECT v.id, c.topic, 1.0 - list_sum(list_transform(list_zip(v.x, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) / 2.0 AS sim "
    "FROM cvec v, cen c WHERE list_sum(list_transform(v.x, lambda t: abs(t))) > 0),\n"
    "cbest AS (SELECT id, topic, sim FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(sim, 9) DESC, topic) AS r FROM csim) WHERE r = 1),\n"
    f"assigned AS (SELECT c.conv_id, c.turn, (CASE WHEN b.topic IS NOT NULL AND coalesce(b.sim, 0.0) >= {MIN_SIM} THEN b.topic ELSE -1 END)::INTEGER AS topic, "
    "coalesce(b.sim, 0.0) AS sim FROM cv c LEFT JOIN cbest b ON c.id = b.id)\n"
)


@register("assign_topics", MODEL_SQL + "SELECT conv_id, turn, topic, round(sim, 6) AS sim FROM assigned")
def q_assign_topics(spark, sf):
    """New feedback (conversation turns) assigned to the topics learned on documents."""
    _, vocab, _, cen = _model(spark, sf)
    a = TR.assign_topics(_conv_vectors(spark, sf, vocab), cen, HASH_DIM, MIN_SIM)
    return (_conversations(spark, sf).select("doc_id", "conv_id", "turn").join(a, "doc_id")
            .select("conv_id", "turn", "topic", r6("sim").alias("sim")))


@register("assign_stream", MODEL_SQL + "SELECT conv_id, turn, topic, round(sim, 6) AS sim FROM assigned")
def q_assign_stream(spark, sf):
    """The same assignment as a Structured Streaming query over the conversations file or files."""
    from ..session import scratch_path
    from ..streaming import assign_topics_stream
    _, vocab, _, cen = _model(spark, sf)
    schema = _table(spark, sf, "conversations").schema
    # a stream reads a folder or a pattern: this one names the table, be it one file or a folder of files
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf.rstrip('/')}/conversations.parque[t]")
    out = scratch_path(spark, "assign-out")
    q = assign_topics_stream(stream, cen, vocab, HASH_DIM, out, scratch_path(spark, "assign-ckpt"), MIN_SIM,
                             id_cols=["conv_id", "turn"])
    q.awaitTermination()
    return spark.read.parquet(out).select("conv_id", "turn", "topic", r6("sim").alias("sim"))


TREND_SQL = (
    f"WITH {O.FIXTURE_TOPICS},\n"
    "tt AS (SELECT f.topic, date_trunc('week', e.ts) AS period FROM ft f JOIN events e ON e.event_id % (SELECT max(doc_id) + 1 FROM documents) = f.doc_id),\n"
    "per AS (SELECT topic, period, count(*)::BIGINT AS count FROM tt GROUP BY ALL),\n"
    "tr AS (SELECT topic, period, count, lag(count) OVER (PARTITION BY topic ORDER BY period) AS prev_count FROM per)\n"
)


def _event_doc(spark, sf):
    """The document an event is about: event ids go round the document ids, so every event counts."""
    n = FX.documents(spark, sf).agg(F.max("doc_id") + 1).first()[0]
    return F.col("event_id") % F.lit(n)


def _trend(spark, sf):
    ev = _table(spark, sf, "events").select(_event_doc(spark, sf).alias("doc_id"), "ts")
    return TR.topic_trend(ev.join(FX.fixture_topics(spark, sf), "doc_id"))


@register("topic_trend",
          TREND_SQL + "SELECT topic, period::DATE::VARCHAR AS period, count, prev_count, (count - coalesce(prev_count, 0))::BIGINT AS change FROM tr")
def q_topic_trend(spark, sf):
    return _trend(spark, sf).withColumn("period", F.to_date("period").cast("string"))


@register("negative_spikes",
          TREND_SQL + ", sm AS (SELECT DISTINCT topic FROM ft WHERE topic % 4 IN (0, 1) AND topic <> -1)\n"
          "SELECT topic, period::DATE::VARCHAR AS period, count, round(tm, 6) AS trailing_mean, "
          "(tm IS NOT NULL AND count >= 1.5 * tm) AS spike FROM (SELECT *, avg(count) OVER (PARTITION BY topic ORDER BY period "
          "ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS tm FROM tr WHERE topic IN (SELECT topic FROM sm))")
def q_negative_spikes(spark, sf):
    """Weekly counts of negative topics against the mean of the two weeks before."""
    trend = _trend(spark, sf)
    topics = trend.select("topic").distinct().filter(F.col("topic") != TP.NOISE)
    summ = S.parse_replies(topics.select("topic", FX.canned_reply_topic("topic").alias("response")))
    return (TR.negative_spikes(trend, summ, 1.5, 2)
              .select("topic", F.to_date("period").cast("string").alias("period"), "count",
                      r6("trailing_mean").alias("trailing_mean"), "spike"))


def _source_topics(spark, sf):
    d = FX.documents(spark, sf)
    return d.select("doc_id", F.when(F.col("n_chars") < 200, F.lit(-1))
                    .otherwise(F.substring("source", 4, 10).cast("int")).cast("int").alias("topic"))


@register("topic_drift",
          MODEL_SQL.rstrip("\n") + ",\n"
          "st AS (SELECT doc_id, (CASE WHEN n_chars < 200 THEN -1 ELSE CAST(substr(source, 4) AS INTEGER) END)::INTEGER AS topic FROM documents),\n"
          "n0 AS (SELECT s.topic, h.dim, avg(h.value) AS v FROM hv h JOIN st s USING (doc_id) WHERE s.topic <> -1 GROUP BY ALL),\n"
          "nnr AS (SELECT topic, sqrt(sum(v * v)) AS nr FROM n0 GROUP BY topic),\n"
          "nc AS (SELECT topic, list(CASE WHEN nr > 0 THEN v / nr ELSE 0.0 END ORDER BY dim) AS c FROM n0 JOIN nnr USING (topic) GROUP BY topic),\n"
          "ds AS (SELECT n.topic, o.topic AS old, 1.0 - list_sum(list_transform(list_zip(n.c, o.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) / 2.0 AS sim FROM nc n, cen o),\n"
          "db AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(sim, 9) DESC, old) AS r FROM ds) WHERE r = 1)\n"
          "SELECT topic::INTEGER AS topic, old::INTEGER AS closest_old, round(sim, 6) AS sim, sim < 0.97 AS drifted FROM db")
def q_topic_drift(spark, sf):
    """Topics of a source-based run against the language topics of the previous run."""
    _, _, vecs, old = _model(spark, sf)
    new = TR.topic_centroids(vecs, _source_topics(spark, sf), HASH_DIM)
    return TR.topic_drift(old, new, HASH_DIM, 0.97).select("topic", "closest_old", r6("sim").alias("sim"), "drifted")


def _names(spark, sf, threshold):
    pre = FX.prepared(spark, sf)
    d = FX.documents(spark, sf)
    t = F.when(F.col("n_chars") < threshold, F.lit(-1))
    for lang, tid in FX.LANG_TOPIC.items():
        t = t.when(F.col("lang") == lang, F.lit(tid))
    topics = d.select("doc_id", t.otherwise(F.lit(-1)).cast("int").alias("topic"))
    docs = cut_lineage(pre.join(topics, "doc_id"))
    words = TP.top_words(TP.ctfidf(_term_counts(spark, sf, docs)), 10)
    info = TP.topic_info(docs.select("doc_id", "topic"), words)
    return info.select("topic", F.col("name").alias("keywords"), F.lit("").alias("docs"))


@register("changed_topics",
          f"WITH {O.PREPARED},\n{O.fixture_topics('fta', 200)},\n{O.fixture_topics('ftb', 2000)},\n"
          f"{O.ctfidf_ctes('a', 'fta')},\n{O.ctfidf_ctes('b', 'ftb')},\n"
          f"na AS (SELECT c.topic, concat_ws('_', c.topic::VARCHAR, w.w) AS k FROM (SELECT DISTINCT topic FROM pt0a) c LEFT JOIN ({O.words_joined('twa', 4, '_', 'w')}) w USING (topic)),\n"
          f"nb AS (SELECT c.topic, concat_ws('_', c.topic::VARCHAR, w.w) AS k FROM (SELECT DISTINCT topic FROM pt0b) c LEFT JOIN ({O.words_joined('twb', 4, '_', 'w')}) w USING (topic))\n"
          "SELECT coalesce(na.topic, nb.topic)::INTEGER AS topic, CASE WHEN na.topic IS NULL THEN 'new' WHEN nb.topic IS NULL THEN 'removed' "
          "WHEN na.k = nb.k THEN 'unchanged' ELSE 'changed' END AS status FROM na FULL OUTER JOIN nb ON na.topic = nb.topic")
def q_changed_topics(spark, sf):
    """Last run: noise under 200 characters; this run: noise under 2,000."""
    return TR.changed_topics(_names(spark, sf, 200), _names(spark, sf, 2000))


# ---------------------------------------------------------------- sources and sinks
from ..session import scratch_path  # noqa: E402
from ..sources import sinks as SK  # noqa: E402
from ..sources.feedback import PANDAS_NA_VALUES, read_feedback_csv, require_min_docs  # noqa: E402
from ..sources.workbooks import read_feedback_workbooks, write_feedback_workbooks  # noqa: E402

_NA_SQL = ", ".join(O.q(v) for v in PANDAS_NA_VALUES)
NA_FEEDBACK_SQL = (f"SELECT doc_id::BIGINT AS doc_id, CASE WHEN text IS NULL OR text IN ({_NA_SQL}) THEN '' ELSE text END AS text "
                   "FROM documents")


@register("ingest_csv", NA_FEEDBACK_SQL)
def q_ingest_csv(spark, sf):
    """Documents written as RFC-4180 CSV (multi-line quoted cells) and read back as feedback."""
    path = scratch_path(spark, "csv")
    SK.write_feedback_csv(FX.documents(spark, sf).select("doc_id", "text"), path)
    return read_feedback_csv(spark, path, "text", id_column="doc_id")


@register("ingest_xlsx", NA_FEEDBACK_SQL)
def q_ingest_xlsx(spark, sf):
    """Documents written as a folder of .xlsx workbooks and read back, one task per workbook."""
    path = scratch_path(spark, "xlsx")
    write_feedback_workbooks(FX.documents(spark, sf).select("doc_id", "text").repartition(4), path)
    return read_feedback_workbooks(spark, f"{path}/*.xlsx", "text", id_column="doc_id")


@register("min_docs_guard", f"WITH {O.PREPARED} SELECT doc_id, text, clean FROM pre")
def q_min_docs_guard(spark, sf):
    return require_min_docs(FX.prepared(spark, sf), 5)


@register("sink_topics_csv", SUMMARY_SQL + "SELECT topic, keywords, summary, sentiment, priority FROM summ")
def q_sink_topics_csv(spark, sf):
    _, _, _, words, info, _ = _topic_parts(spark, sf, rep=False)
    path = scratch_path(spark, "topics-csv")
    SK.write_topics(S.summarize_topics(info, words, _canned(words)), path)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return back.select(F.col("topic").cast("int").alias("topic"),
                       *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("keywords", "summary", "sentiment", "priority")])


@register("snapshot_roundtrip",
          REPORT_SQL.rstrip("\n") + ",\nst AS (SELECT count(*)::BIGINT AS total, count(DISTINCT CASE WHEN topic <> -1 THEN topic END)::BIGINT AS n_topics, "
          "count(*) FILTER (WHERE topic = -1)::BIGINT AS n_noise FROM pt0)\nSELECT st.total, st.n_topics, st.n_noise, rep.* FROM rep, st")
def q_snapshot_roundtrip(spark, sf):
    """Report + run totals saved as a nested JSON snapshot and loaded back."""
    docs = FX.prepared_with_topics(spark, sf)
    path = scratch_path(spark, "snapshot")
    SK.save_snapshot(_report(spark, sf), TP.run_stats(docs.select("doc_id", "topic")), path)
    snap = SK.load_snapshot(spark, path)
    return (snap.select("total", "n_topics", "n_noise", F.explode("results").alias("r"))
                .select("total", "n_topics", "n_noise", "r.topic", "r.count", "r.keywords", "r.summary", "r.sentiment",
                        "r.priority", F.array_join("r.docs", "\n").alias("docs")))


@register("model_roundtrip", MODEL_SQL + "SELECT conv_id, turn, topic, round(sim, 6) AS sim FROM assigned")
def q_model_roundtrip(spark, sf):
    """Topic model (centroids + vocabulary) saved, loaded, and used to assign new feedback."""
    _, vocab, _, cen = _model(spark, sf)
    path = scratch_path(spark, "model")
    SK.save_topic_model({"centroids": cen, "vocabulary": vocab}, {"dim": HASH_DIM, "min_sim": MIN_SIM}, path)
    parts, params = SK.load_topic_model(spark, path, ["centroids", "vocabulary"])
    a = TR.assign_topics(_conv_vectors(spark, sf, parts["vocabulary"]), parts["centroids"], params["dim"], params["min_sim"])
    return (_conversations(spark, sf).select("doc_id", "conv_id", "turn").join(a, "doc_id")
            .select("conv_id", "turn", "topic", r6("sim").alias("sim")))


# ---------------------------------------------------------------- hierarchy, strength, silhouette
#: The condensed tree in SQL.  In the order in which Prim's algorithm reaches the points, the components below
#: any weight are runs; a run is cut at its largest weights, and runs of 5 points or more are clusters.
TREE_SQL = (
    HV_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + ",\n"
    "nm AS MATERIALIZED (SELECT doc_id, v, row_number() OVER (ORDER BY doc_id) AS k FROM dv @where@),\n"
    "ds AS MATERIALIZED (SELECT a.k AS i, b.k AS j, sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d "
    "FROM nm a, nm b WHERE a.k <> b.k),\n"
    "co AS MATERIALIZED (SELECT i, (list(d ORDER BY d))[3] AS core FROM ds GROUP BY i),\n"
    "mr AS MATERIALIZED (SELECT i, list(w ORDER BY j) AS r FROM (SELECT i, j, round(greatest(d, c1.core, c2.core), 9) AS w FROM ds "
    "JOIN co c1 USING (i) JOIN co c2 ON c2.i = ds.j UNION ALL SELECT k, k, 1e308 FROM nm) GROUP BY i),\n"
    "prim(step, nxt, ord, ws, best) AS (SELECT 1, list_position(r, list_min(r)), [1::BIGINT], [0.0::DOUBLE], r FROM mr WHERE i = 1 UNION ALL "
    "SELECT step + 1, list_position(nb, list_min(nb)), o, wl, nb FROM (SELECT p.step, list_append(p.ord, p.nxt) AS o, list_append(p.ws, list_min(p.best)) AS wl, "
    "list_transform(p.best, lambda x, j: CASE WHEN x = 1e308 OR j = p.nxt THEN 1e308 ELSE least(x, m.r[j]) END) AS nb "
    "FROM prim p JOIN mr m ON m.i = p.nxt WHERE p.step < (SELECT count(*) FROM nm))),\n"
    "pr AS MATERIALIZED (SELECT ord, ws FROM prim WHERE step = (SELECT count(*) FROM nm)),\n"
    "run(c, level, l, r) AS (SELECT '1', 0, 1, len(ord) FROM pr WHERE len(ord) >= 5 UNION ALL "
    "SELECT CASE WHEN n_big = 1 THEN c ELSE c || '/' || s[1] END, level + (n_big > 1)::INT, s[1], s[2] FROM ("
    "SELECT c, level, unnest(big) AS s, len(big) AS n_big FROM (SELECT c, level, list_filter(sg, lambda x: x[2] - x[1] >= 4) AS big FROM ("
    "SELECT run.c, run.level, list_zip(list_concat([l], cut), list_concat(list_transform(cut, lambda x: x - 1), [r])) AS sg FROM ("
    "SELECT run.*, list_filter(range(l + 1, r + 1), lambda x: ws[x] = list_max(ws[l + 1:r])) AS cut FROM run, pr) run)))),\n"
    "cuts AS MATERIALIZED (SELECT c, level, l, r, list_max(ws[l + 1:r]) AS w, list_filter(range(l + 1, r + 1), lambda x: ws[x] = list_max(ws[l + 1:r])) AS cut FROM run, pr),\n"
    "sg AS MATERIALIZED (SELECT c, level, w, l, r, unnest(list_zip(list_concat([l], cut), list_concat(list_transform(cut, lambda x: x - 1), [r]))) AS s FROM cuts),\n"
    "spl AS (SELECT c, max(w) FILTER (WHERE n > 1) AS split FROM (SELECT c, l, r, any_value(w) AS w, count(*) FILTER (WHERE s[2] - s[1] >= 4) AS n FROM sg GROUP BY c, l, r) GROUP BY c),\n"
    "lv AS (SELECT c, level, w, unnest(range(s[1], s[2] + 1)) AS at FROM sg WHERE s[2] - s[1] < 4),\n"
    "lf AS (SELECT c, level, nm.doc_id, 1 / greatest(w, 1e-300) AS lam FROM lv JOIN spl USING (c) CROSS JOIN pr JOIN nm ON nm.k = pr.ord[lv.at] WHERE split IS NULL),\n"
    "lc AS (SELECT *, min(doc_id) OVER (PARTITION BY c) AS cluster, max(lam) OVER (PARTITION BY c) AS most FROM lf)\n")


@register("density_cluster", TREE_SQL.replace("@where@", "") +
          "SELECT nm.doc_id, coalesce(lc.cluster, -1)::BIGINT AS cluster, lc.level::INTEGER AS level FROM nm LEFT JOIN lc USING (doc_id)")
def q_density_cluster(spark, sf):
    """Hierarchical density clusters (leaf selection) of the hashed document vectors."""
    return CL.density_cluster_tree(_hashed(spark, sf), 5, 3).drop("strength")


@register("membership_strength_tree", TREE_SQL.replace("@where@", "") +
          "SELECT nm.doc_id, coalesce(lc.cluster, -1)::BIGINT AS cluster, round(coalesce(lc.lam / lc.most, 0.0), 6) AS strength FROM nm LEFT JOIN lc USING (doc_id)")
def q_membership_strength_tree(spark, sf):
    """Strength of each document in its cluster of the hierarchy."""
    return CL.density_cluster_tree(_hashed(spark, sf), 5, 3).drop("level").withColumn("strength", r6("strength"))


ANALYZE_TREE_SQL = (
    TREE_SQL.replace("nm AS MATERIALIZED", _rp_sql("dv", "doc_id", "v", 5, HASH_DIM) + ",\n"
                     "rv AS (SELECT id AS doc_id, list(value ORDER BY comp) AS v FROM rp GROUP BY id),\nnm AS MATERIALIZED", 1)
    .replace("FROM dv @where@", "FROM rv") + ",\n"
    "raw AS (SELECT nm.doc_id, coalesce(lc.cluster, -1) AS topic FROM nm LEFT JOIN lc USING (doc_id)),\n"
    "sz AS (SELECT topic, count(*) AS n, min(doc_id) AS first FROM raw WHERE topic <> -1 GROUP BY topic),\n"
    "mp AS (SELECT topic, (row_number() OVER (ORDER BY n DESC, first) - 1)::INTEGER AS new FROM sz),\n"
    "tf AS (SELECT doc_id, coalesce(new, -1)::INTEGER AS topic FROM raw LEFT JOIN mp USING (topic)),\n"
    + O.ctfidf_ctes("", "tf") + ",\n"
    "cnt AS (SELECT topic, count(*)::BIGINT AS count FROM pt0 GROUP BY topic),\n"
    "names AS (" + O.words_joined("tw", 4, "_", "w") + ")\n")


@register("analyze_tree", ANALYZE_TREE_SQL + "SELECT topic, count, concat_ws('_', topic::VARCHAR, w) AS name FROM cnt LEFT JOIN names USING (topic)")
def q_analyze_tree(spark, sf):
    """End to end in the order reduce, hierarchy, keywords: topics with their size and name."""
    from .analyze import Options, analyze
    return analyze(FX.documents(spark, sf), Options(summarize=False, reduce_dim=5, clustering="leaf")).info


@register("assign_by_tree", TREE_SQL.replace("@where@", "WHERE doc_id % 10 <> 0") + ",\n"
          "nw AS (SELECT doc_id AS src, v FROM dv WHERE doc_id % 10 = 0),\n"
          "nn AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(d, 12), doc_id) AS rank FROM (SELECT nw.src, nm.doc_id, nm.k, "
          "sqrt(list_sum(list_transform(list_zip(nw.v, nm.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d FROM nw, nm)),\n"
          "rc AS (SELECT src, nn.doc_id, greatest(d, core, max(d) FILTER (WHERE rank <= 3) OVER (PARTITION BY src)) AS reach FROM nn JOIN co ON co.i = nn.k WHERE rank <= 6),\n"
          "ft AS (SELECT src, doc_id, reach FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY round(reach, 12), doc_id) AS f FROM rc) WHERE f = 1),\n"
          "bt AS (SELECT lc.c, any_value(cluster) AS cluster, any_value(most) AS most, coalesce(max(1 / up.w), 0) AS birth FROM lc "
          "LEFT JOIN (SELECT c, w, s[1] AS b FROM sg JOIN spl USING (c) WHERE s[2] - s[1] >= 4 AND w = split) up ON lc.c = up.c || '/' || up.b GROUP BY lc.c),\n"
          "jn AS (SELECT src, bt.cluster, least(1 / greatest(reach, 1e-300), bt.most) / bt.most AS strength FROM ft JOIN lc USING (doc_id) JOIN bt USING (c) "
          "WHERE 1 / greatest(reach, 1e-300) >= birth - 1e-9)\n"
          "SELECT nw.src AS doc_id, coalesce(cluster, -1)::BIGINT AS cluster, round(coalesce(strength, 0.0), 6) AS strength FROM nw LEFT JOIN jn USING (src)")
def q_assign_by_tree(spark, sf):
    """Every tenth document as a new one, against the hierarchy of the others."""
    vecs = cut_lineage(_hashed(spark, sf))
    tree = CL.density_tree(vecs.where("doc_id % 10 <> 0"), 5, 3)
    return CL.assign_by_tree(tree, vecs.where("doc_id % 10 = 0")).withColumn("strength", r6("strength"))


@register("membership_strength",
          DENSITY_SQL + ", cls AS (SELECT id, (CASE WHEN n >= 5 THEN comp ELSE -1 END)::BIGINT AS cluster FROM cc JOIN sz USING (comp)),\n"
          "cm AS (SELECT cls.cluster, min(core.core) AS m FROM cls JOIN core USING (id) WHERE cls.cluster <> -1 GROUP BY cls.cluster)\n"
          "SELECT cls.id AS doc_id, cls.cluster, round(CASE WHEN cls.cluster = -1 OR core.core IS NULL THEN 0.0 "
          "WHEN core.core = 0 THEN 1.0 ELSE cm.m / core.core END, 6) AS strength FROM cls LEFT JOIN core USING (id) LEFT JOIN cm USING (cluster)")
def q_membership_strength(spark, sf):
    from ..operators.neighbors import _prepare
    vecs = cut_lineage(_hashed(spark, sf))
    core = CL.core_distances(_prepare(vecs, "doc_id", "vec", "euclidean", HASH_DIM, 2, 7), 3, 1.0, 2)
    clusters = CL.density_cluster_at(vecs, 1.0, HASH_DIM, 3, 5)
    return CL.membership_strength(clusters, core).withColumn("strength", r6("strength"))


@register("silhouette",
          f"WITH {O.EMB_PAIRS}, lab AS (SELECT vec_id::BIGINT AS id, label::BIGINT AS label FROM embeddings),\n"
          "ps AS (SELECT ep.src, lb.label, sum(ep.dist) AS s, count(*) AS c FROM ep JOIN lab lb ON ep.dst = lb.id GROUP BY ALL),\n"
          "pp AS (SELECT ps.src, max(CASE WHEN ps.label = la.label THEN s / c END) AS a, max(CASE WHEN ps.label = la.label THEN c END) AS own_c, "
          "min(CASE WHEN ps.label <> la.label THEN s / c END) AS b FROM ps JOIN lab la ON ps.src = la.id GROUP BY ps.src),\n"
          "all_pts AS (SELECT l.id, coalesce(pp.own_c, 0) AS own_c, a, b FROM lab l LEFT JOIN pp ON l.id = pp.src)\n"
          "SELECT round(avg(CASE WHEN own_c = 0 THEN 0.0 WHEN greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM all_pts")
def q_silhouette(spark, sf):
    """Euclidean silhouette of the embeddings grouped by their label."""
    emb = _embeddings(spark, sf)
    lab = _table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("topic"))
    return CL.silhouette(emb, lab, 64).select(r6("silhouette").alias("silhouette"))


@register("silhouette_sq",
          HV_SQL.rstrip("\n") + ",\n" + O.fixture_topics() + ",\n"
          # per-cluster count, sum of squared norms and feature sums; a point's mean
          # squared distance to a cluster is |x|^2 + Q/N - 2 x.S/N (own cluster: * N/(N-1))
          "pts AS (SELECT doc_id, topic AS label FROM ft WHERE doc_id IN (SELECT doc_id FROM pre)),\n"
          "pn AS (SELECT doc_id, sum(value * value) AS sq FROM hv GROUP BY doc_id),\n"
          "cs AS (SELECT label, count(*) AS n, sum(sq) AS q FROM pts JOIN pn USING (doc_id) GROUP BY label),\n"
          "cf AS (SELECT label, dim, sum(value) AS s FROM hv JOIN pts USING (doc_id) GROUP BY ALL),\n"
          "dt AS (SELECT h.doc_id, cf.label, sum(h.value * cf.s) AS d FROM hv h JOIN cf ON h.dim = cf.dim GROUP BY ALL),\n"
          "md AS (SELECT dt.doc_id, dt.label, pn.sq + cs.q / cs.n - 2 * dt.d / cs.n AS m FROM dt JOIN pn USING (doc_id) JOIN cs USING (label)),\n"
          "per AS (SELECT p.doc_id, c.n AS own_n, max(CASE WHEN md.label = p.label THEN m END) * c.n / greatest(c.n - 1, 1) AS a, "
          "min(CASE WHEN md.label <> p.label THEN m END) AS b FROM pts p JOIN cs c USING (label) JOIN md USING (doc_id) GROUP BY p.doc_id, c.n)\n"
          "SELECT CASE WHEN (SELECT count(*) FROM cs) < 2 OR (SELECT count(*) FROM cs) >= (SELECT count(*) FROM pts) THEN NULL "
          "ELSE round(avg(CASE WHEN own_n = 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END), 6) END "
          "AS silhouette FROM per")
def q_silhouette_sq(spark, sf):
    """Squared-Euclidean silhouette in linear time (MLlib evaluator), hashed vectors by language topic."""
    val = CL.silhouette_sq(_hashed(spark, sf), FX.fixture_topics(spark, sf))
    return spark.createDataFrame([(None if val is None else round(val, 6),)], "silhouette double")


# ---------------------------------------------------------------- keywords, phrases, encoders
from ..operators import keywords as KW  # noqa: E402
from ..operators import phrases as PH  # noqa: E402


@register("embedding_keywords",
          REP_DOCS_SQL.rstrip("\n") + ",\n" + O.hashed_vectors(HASH_DIM) + ",\n"
          "tv AS (SELECT r.topic, h.dim, avg(h.value) AS v FROM rk r JOIN hv h USING (doc_id) WHERE r.rank <= 5 GROUP BY ALL),\n"
          "tvn AS (SELECT topic, sqrt(sum(v * v)) AS nr FROM tv GROUP BY topic),\n"
          "cand AS (SELECT topic, word FROM tw WHERE rank <= 100),\n"
          "ks AS (SELECT c.topic, c.word, CASE WHEN tvn.nr > 0 THEN voc.sign * tv.v / tvn.nr ELSE 0.0 END AS score FROM cand c "
          "JOIN voc USING (word) JOIN tv ON tv.topic = c.topic AND tv.dim = voc.bucket JOIN tvn ON tvn.topic = c.topic),\n"
          "kr AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(score, 9) DESC, word) AS rank FROM ks)\n"
          "SELECT topic, rank::INTEGER AS rank, word, round(score, 6) AS score FROM kr WHERE rank <= 10")
def q_embedding_keywords(spark, sf):
    """Top-100 c-TF-IDF candidates re-ranked by similarity to the mean representative-doc vector."""
    docs, _, scores, _, _, rep = _topic_parts(spark, sf)
    pre = docs.select("doc_id", "clean")
    terms = chunked_terms(pre)
    vocab = cut_lineage(EM.hashed_vocab(pre, HASH_DIM, terms=terms))
    vecs = EM.encode_hashed(pre, HASH_DIM, vocab=vocab, terms=terms)
    tv = KW.topic_vectors(rep, vecs, HASH_DIM, 5)
    kw = KW.embedding_keywords(scores, tv, KW.hashed_word_vectors(vocab, HASH_DIM), 100, 10)
    return kw.withColumn("score", r6("score"))


@register("embed_word2vec")
def q_embed_word2vec(spark, sf):
    """Documents and words in one Word2Vec space (document = mean of its word vectors)."""
    doc_vecs, _ = EM.encode_word2vec(cut_lineage(FX.prepared(spark, sf)), size=32, min_count=5, seed=42)
    return EM.vector_long(doc_vecs)


def bigram_encoder(dim: int = 64):
    """A user encoder for ``embed_texts``: character bigrams by code point, L2-normalised (NumPy)."""
    def make():
        import numpy as np

        def encode(texts):
            out = np.zeros((len(texts), dim))
            for i, t in enumerate(texts):
                c = np.frombuffer(t.encode("utf-32-le"), dtype="<u4").astype(np.int64)
                out[i] = np.bincount((c[:-1] * 31 + c[1:]) % dim, minlength=dim)
            n = np.linalg.norm(out, axis=1, keepdims=True)
            return np.divide(out, n, out=np.zeros_like(out), where=n > 0)
        return encode
    return make


@register("embed_texts",
          f"WITH {O.PREPARED},\n"
          "ch AS (SELECT doc_id, list_transform(regexp_extract_all(clean, '(?s).'), lambda c: unicode(c)) AS c FROM pre),\n"
          "bg AS (SELECT doc_id, unnest(list_transform(range(1, len(c)), lambda i: (c[i] * 31 + c[i + 1]) % 64)) AS dim FROM ch),\n"
          "bc AS (SELECT doc_id, dim, count(*) AS n FROM bg GROUP BY ALL),\n"
          "bn AS (SELECT doc_id, sqrt(sum(n * n)) AS nr FROM bc GROUP BY doc_id)\n"
          "SELECT p.doc_id, g.i::INTEGER AS dim, round(coalesce(bc.n / bn.nr, 0.0), 6) AS value FROM pre p CROSS JOIN range(64) g(i) "
          "LEFT JOIN bc ON bc.doc_id = p.doc_id AND bc.dim = g.i LEFT JOIN bn ON bn.doc_id = p.doc_id")
def q_embed_texts(spark, sf):
    """Pluggable encoder run on executors in Arrow batches (here: character bigrams)."""
    return EM.vector_long(EM.embed_texts(FX.prepared(spark, sf), bigram_encoder(64), 64, batch_size=32)).withColumn("value", r6("value"))


RANDOM_INDEX_SQL = (
    f"WITH {O.PREPARED},\n"
    f"wt AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest({O.tokens('clean')}) AS word FROM pre) GROUP BY ALL),\n"
    "kn AS (SELECT word FROM wt GROUP BY word HAVING sum(tf) >= 5),\n"
    "dt AS (SELECT wt.* FROM wt JOIN kn USING (word)),\n"
    f"mk AS (SELECT doc_id, ({O.md5_int("doc_id::VARCHAR || ':' || e.i::VARCHAR")} % 32)::INTEGER AS bucket, "
    f"CASE WHEN (({O.md5_int("doc_id::VARCHAR || ':' || e.i::VARCHAR")} >> 16) & 1) = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS sign "
    "FROM pre, range(4) e(i)),\n"
    "wv AS (SELECT word, bucket, sum(tf * sign) AS v FROM dt JOIN mk USING (doc_id) GROUP BY ALL),\n"
    "dn AS (SELECT doc_id, sum(tf) AS n FROM dt GROUP BY doc_id),\n"
    "dm AS (SELECT doc_id, bucket, sum(tf * v) / max(dn.n) AS v FROM dt JOIN wv USING (word) JOIN dn USING (doc_id) GROUP BY ALL)\n"
)


@register("embed_random_index",
          RANDOM_INDEX_SQL + "SELECT p.doc_id, g.i::INTEGER AS dim, round(coalesce(dm.v, 0.0), 6) AS value FROM pre p "
          "CROSS JOIN range(32) g(i) LEFT JOIN dm ON dm.doc_id = p.doc_id AND dm.bucket = g.i")
def q_embed_random_index(spark, sf):
    """Documents in the word space of random indexing (document = mean of its word vectors)."""
    vecs, _ = EM.random_index(cut_lineage(FX.prepared(spark, sf, keep_text=False)), 32, 5)
    return EM.vector_long(vecs).withColumn("value", r6("value"))


MMR_SQL = (
    REP_DOCS_SQL.rstrip("\n").replace("WITH ", "WITH RECURSIVE ", 1) + ",\n"
    + re.sub(r"\b(wt|kn|dt|mk|wv|dn|dm)\b", r"ri_\1", RANDOM_INDEX_SQL.split(O.PREPARED + ",\n", 1)[1]).rstrip("\n") + ",\n"
    "tvl AS (SELECT r.topic, g.i AS dim, sum(coalesce(ri_dm.v, 0.0)) / count(*) AS v FROM rk r CROSS JOIN range(32) g(i) "
    "LEFT JOIN ri_dm ON ri_dm.doc_id = r.doc_id AND ri_dm.bucket = g.i WHERE r.rank <= 5 GROUP BY r.topic, g.i),\n"
    "tvu AS (SELECT topic, list(v / nr ORDER BY dim) AS t FROM (SELECT *, sqrt(sum(v * v) OVER (PARTITION BY topic)) AS nr FROM tvl) WHERE nr > 0 GROUP BY topic),\n"
    "wvl AS (SELECT w.word, g.i AS dim, coalesce(ri_wv.v, 0.0) AS v FROM (SELECT DISTINCT word FROM ri_wv) w CROSS JOIN range(32) g(i) "
    "LEFT JOIN ri_wv ON ri_wv.word = w.word AND ri_wv.bucket = g.i),\n"
    "wvu AS (SELECT word, list(CASE WHEN nr > 0 THEN v / nr ELSE 0.0 END ORDER BY dim) AS u FROM (SELECT *, sqrt(sum(v * v) OVER (PARTITION BY word)) AS nr FROM wvl) GROUP BY word),\n"
    "cw AS MATERIALIZED (SELECT topic, word, u, t, row_number() OVER (PARTITION BY topic ORDER BY word) AS k FROM tw JOIN wvu USING (word) JOIN tvu USING (topic) "
    "WHERE rank <= 30 AND topic <> -1),\n"
    "rl AS (SELECT topic, list(list_sum(list_transform(list_zip(u, t), lambda z: z[1] * z[2])) ORDER BY k) AS rel, list(word ORDER BY k) AS words FROM cw GROUP BY topic),\n"
    "sm AS MATERIALIZED (SELECT a.topic, a.k, list(list_sum(list_transform(list_zip(a.u, b.u), lambda z: z[1] * z[2])) ORDER BY b.k) AS s FROM cw a JOIN cw b USING (topic) GROUP BY a.topic, a.k),\n"
    "mmr(topic, rank, pick, got, red, rel, words) AS (SELECT rl.topic, 1, list_position(rel, list_max(rel)), [list_position(rel, list_max(rel))], s, rel, words "
    "FROM rl JOIN sm ON sm.topic = rl.topic AND sm.k = list_position(rel, list_max(rel)) UNION ALL "
    "SELECT n.topic, rank + 1, n.p, list_append(got, n.p), list_transform(red, lambda x, i: greatest(x, sm.s[i])), rel, words FROM ("
    "SELECT q.*, list_position(sc, list_max(sc)) AS p FROM (SELECT m.*, list_transform(rel, lambda x, i: CASE WHEN list_contains(got, i) THEN -1e308 "
    "ELSE 0.9::DOUBLE * x - 0.1::DOUBLE * red[i] END) AS sc FROM mmr m WHERE rank < least(10, len(rel))) q) n JOIN sm ON sm.topic = n.topic AND sm.k = n.p)\n"
    "SELECT topic::INTEGER AS topic, rank::INTEGER AS rank, words[pick] AS word FROM mmr")


@register("mmr_keywords", MMR_SQL)
def q_mmr_keywords(spark, sf):
    """MMR (diversity 0.1) over the top-30 c-TF-IDF words in the space of random indexing."""
    docs, _, scores, _, _, rep = _topic_parts(spark, sf)
    doc_vecs, word_vecs = EM.random_index(docs.select("doc_id", "clean"), 32, 5)
    cands = TP.top_words(scores, 30).filter(F.col("topic") != TP.NOISE)
    tv = KW.topic_vectors(rep, cut_lineage(doc_vecs), 32, 5)
    return KW.mmr_keywords(cands, tv, cut_lineage(word_vecs), 0.1, 10)


@register("knn_lists", f"WITH {O.EMB_PAIRS} SELECT src, dst, rank::INTEGER AS rank, round(dist, 6) AS dist FROM ek WHERE rank <= 4")
def q_knn_lists(spark, sf):
    """Neighbours by inverted lists, every list probed that can hold one."""
    return LS.knn_lists(_embeddings(spark, sf), 4, exact=True, id_col="doc_id").withColumn("dist", r6("dist"))


PHRASES_SQL = (
    f"WITH {O.PREPARED},\n"
    f"tk AS (SELECT doc_id, {O.tokens('clean', O.WORD_ANY)} AS t FROM pre),\n"
    "uni AS (SELECT w, count(*) AS n FROM (SELECT unnest(t) AS w FROM tk) GROUP BY w),\n"
    "tot AS (SELECT sum(n) AS nn FROM uni),\n"
    "bp AS (SELECT p.a, p.b FROM (SELECT unnest(list_transform(range(0, len(t) - 1), lambda i: {'a': t[i + 1], 'b': t[i + 2]})) AS p FROM tk WHERE len(t) >= 2)),\n"
    "bi AS (SELECT a, b, count(*) AS n_ab FROM bp GROUP BY a, b HAVING count(*) >= 5),\n"
    "ph AS (SELECT bi.a, bi.b, bi.a || '_' || bi.b AS phrase, bi.n_ab::BIGINT AS n_ab, "
    "(bi.n_ab - 5.0::DOUBLE) * tot.nn / (ua.n * ub.n) AS score FROM bi JOIN uni ua ON ua.w = bi.a JOIN uni ub ON ub.w = bi.b, tot)\n"
)


@register("learn_phrases", PHRASES_SQL + "SELECT a, b, phrase, n_ab, round(score, 6) AS score FROM ph WHERE score > 10.0")
def q_learn_phrases(spark, sf):
    return PH.learn_phrases(FX.prepared(spark, sf), 5, 5.0, 10.0).withColumn("score", r6("score"))


_UNIT_WORD = r"[\p{L}\p{M}\p{N}_]"


def _scored_sql(units: str, p: str) -> str:
    """The pairs of side-by-side units that make a phrase, as ``{p}lex``."""
    return (f"{p}uni AS (SELECT w, count(*) AS n FROM (SELECT unnest(t) AS w FROM {units}) WHERE regexp_matches(w, '^{_UNIT_WORD}') GROUP BY w),\n"
            f"{p}bp AS (SELECT p.a, p.b FROM (SELECT unnest(list_transform(range(0, len(t) - 1), lambda i: {{'a': t[i + 1], 'b': t[i + 2]}})) AS p "
            f"FROM {units} WHERE len(t) >= 2) WHERE regexp_matches(p.a, '^{_UNIT_WORD}') AND regexp_matches(p.b, '^{_UNIT_WORD}')),\n"
            f"{p}lex AS MATERIALIZED (SELECT a || ' ' || b AS phrase FROM (SELECT a, b, count(*) AS n_ab FROM {p}bp GROUP BY a, b HAVING count(*) >= 5) "
            f"JOIN {p}uni ua ON ua.w = a JOIN {p}uni ub ON ub.w = b, (SELECT sum(n) AS nn FROM {p}uni) "
            "WHERE (n_ab - 5.0::DOUBLE) * nn / (ua.n * ub.n) > 10.0 AND len(string_split(a || ' ' || b, ' ')) <= 4)")


def _units_sql(lex: str, p: str, glue: str) -> str:
    """The units of every document by longest match, as ``{p}un(doc_id, t)``."""
    return (f"{p}hit AS (SELECT g.doc_id, i, max(k) AS k FROM (SELECT doc_id, i, k, array_to_string(t[i + 1:i + k], ' ') AS phrase FROM "
            f"(SELECT *, unnest(range(0, len(t))) AS i FROM tk), range(2, 5) r(k) WHERE i + k <= len(t)) g WHERE phrase IN (SELECT phrase FROM {lex}) GROUP BY g.doc_id, i),\n"
            f"{p}got AS (SELECT doc_id, unnest(list_reduce(list({{'i': i, 'next': i + k, 'got': [[i, k]]}} ORDER BY i), lambda a, b: CASE WHEN b.i >= a.next "
            f"THEN {{'i': b.i, 'next': b.next, 'got': list_concat(a.got, b.got)}} ELSE a END).got) AS x FROM {p}hit GROUP BY doc_id),\n"
            f"{p}of AS (SELECT doc_id, x[1] AS first, unnest(range(x[1], x[1] + x[2])) AS i FROM {p}got),\n"
            f"{p}un AS MATERIALIZED (SELECT doc_id, list(u ORDER BY first) AS t FROM (SELECT w.doc_id, coalesce(o.first, w.i) AS first, string_agg(tok, '{glue}' ORDER BY w.i) AS u "
            f"FROM (SELECT doc_id, unnest(t) AS tok, unnest(range(0, len(t))) AS i FROM tk) w LEFT JOIN {p}of o ON o.doc_id = w.doc_id AND o.i = w.i "
            "GROUP BY w.doc_id, coalesce(o.first, w.i)) GROUP BY doc_id)")


SEGMENT_SQL = (
    f"WITH {O.PREPARED},\n"
    f"tk AS MATERIALIZED (SELECT doc_id, regexp_extract_all(clean, '{_UNIT_WORD}+|[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s]') AS t FROM pre),\n"
    + _scored_sql("tk", "p1") + ",\n" + _units_sql("p1lex", "p1", " ") + ",\n" + _scored_sql("p1un", "p2") + ",\n"
    "lx AS (SELECT phrase FROM p1lex UNION SELECT phrase FROM p2lex)")


@register("learn_lexicon", SEGMENT_SQL + " SELECT phrase, len(string_split(phrase, ' '))::INTEGER AS n_tokens FROM lx")
def q_learn_lexicon(spark, sf):
    """Units of two to four tokens, learned in two passes."""
    return PH.learn_lexicon(FX.prepared(spark, sf))


@register("segment_words", SEGMENT_SQL + ",\n" + _units_sql("lx", "p3", "_") +
          " SELECT pre.doc_id, coalesce(array_to_string(p3un.t, ' '), '') AS clean FROM pre LEFT JOIN p3un ON pre.doc_id = p3un.doc_id")
def q_segment_words(spark, sf):
    """Documents as tokens, units of up to four of them joined by "_", punctuation kept."""
    pre = cut_lineage(FX.prepared(spark, sf))
    return PH.segment_words(pre, PH.learn_lexicon(pre)).select("doc_id", "clean")


@register("fuzzy_graph")
def q_fuzzy_graph(spark, sf):
    """Fuzzy neighbour graph of the embeddings (k = 4, cosine)."""
    return NB.fuzzy_graph(NB.knn(_embeddings(spark, sf), 4, 64, metric="cosine"))


def _event_stream(spark, sf, tz):
    """The events as a stream of doc_id and ts."""
    ev_schema = _table(spark, sf, "events").schema
    # wall-clock (NTZ) -> the instant of that wall-clock in UTC, so 7-day windows align to Mondays
    return (spark.readStream.schema(ev_schema).option("pathGlobFilter", "events.parquet").parquet(sf.rstrip("/"))
                 .select(_event_doc(spark, sf).alias("doc_id"), F.to_utc_timestamp(F.col("ts").cast("timestamp"), tz).alias("ts")))


@register("negative_spikes_stream",
          TREND_SQL + ", sm AS (SELECT DISTINCT topic FROM ft WHERE topic % 4 IN (0, 1) AND topic <> -1)\n"
          "SELECT topic, period::DATE::VARCHAR AS period, count, round(tm, 6) AS trailing_mean, "
          "(tm IS NOT NULL AND count >= 1.5 * tm) AS spike FROM (SELECT *, avg(count) OVER (PARTITION BY topic ORDER BY period "
          "ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS tm FROM tr WHERE topic IN (SELECT topic FROM sm)) "
          "WHERE period + INTERVAL 7 DAY <= (SELECT max(ts) FROM events) - INTERVAL 14 DAY")
def q_negative_spikes_stream(spark, sf):
    """Negative spikes of the weeks that the watermark has passed, found as they close."""
    from ..streaming import negative_spikes_stream
    tz = spark.conf.get("spark.sql.session.timeZone")
    topics = cut_lineage(FX.fixture_topics(spark, sf))
    joined = _event_stream(spark, sf, tz).join(topics, "doc_id")
    some = topics.select("topic").distinct().filter(F.col("topic") != TP.NOISE)
    summ = cut_lineage(S.parse_replies(some.select("topic", FX.canned_reply_topic("topic").alias("response"))))
    out = scratch_path(spark, "spikes")
    negative_spikes_stream(joined, summ, out, scratch_path(spark, "spikes-state"), scratch_path(spark, "spikes-ckpt"), 1.5, 2).awaitTermination()
    period = F.to_date(F.from_utc_timestamp("period", tz)).cast("string")
    return spark.read.parquet(out).select("topic", period.alias("period"), "count", r6("trailing_mean").alias("trailing_mean"), "spike")


@register("weekly_counts_stream",
          TREND_SQL + "SELECT topic, period::DATE::VARCHAR AS period, count FROM per "
          "WHERE period + INTERVAL 7 DAY <= (SELECT max(ts) FROM events) - INTERVAL 14 DAY")
def q_weekly_counts_stream(spark, sf):
    """Weekly topic counts as a streaming aggregation: events stream joined with
    the static topic table, 7-day windows aligned to Mondays, event-time watermark.
    Append mode: a week is written once, when the watermark has passed it."""
    from ..streaming import weekly_counts_stream
    tz = spark.conf.get("spark.sql.session.timeZone")
    joined = _event_stream(spark, sf, tz).join(FX.fixture_topics(spark, sf), "doc_id")
    out = scratch_path(spark, "weekly")
    counts = weekly_counts_stream(joined, "ts", "topic", "14 days")

    def sink(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={epoch}")
    q = (counts.writeStream.outputMode("append").foreachBatch(sink)
               .option("checkpointLocation", scratch_path(spark, "weekly-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    period = F.to_date(F.from_utc_timestamp("period", tz)).cast("string")
    return spark.read.parquet(out).select("topic", period.alias("period"), "count")


@register("density_cluster_eom")
def q_density_cluster_eom(spark, sf):
    """Hierarchical density clusters with excess-of-mass selection."""
    return CL.density_cluster_tree(_hashed(spark, sf), 5, 3, method="eom").drop("strength")
