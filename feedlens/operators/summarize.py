"""Topic summaries and triage.

The flow is topic-level (dozens of rows), so the only document-level work is
upstream (representative docs).  Generation is pluggable:

- a *Python backend* ``fn(prompt: str) -> str`` runs inside ``mapInPandas`` on
  executors, one batch of topics per task, with retries; one failing topic
  yields ``[ERROR: ...]`` and does not fail the job;
- a *column backend* ``fn(prompts_df) -> DataFrame(topic, response)`` stays in
  the JVM (the offline extractive backend and SQL-made replies are of this kind).

Responses are cached in a table keyed by md5 of the UTF-8 prompt (optionally
plus a backend id); failures are never stored.
"""
from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import (
    NEGATIVE,
    NEUTRAL,
    PRIORITY_HIGH,
    PRIORITY_LOW,
    PRIORITY_MEDIUM,
    reply_lines,
    sentiment_label,
    sentiment_value,
    summary_or_reply,
    summary_text,
)
from ..session import cut_lineage
from ..functions.text import WORD_TOKEN, strip_ws, word_tokens
from .topics import NOISE, ordered_words

# The default prompt template and the two-line answer format
# appended to every prompt.
DEFAULT_TEMPLATE = (
    "Tôi có một chủ đề bao gồm các tài liệu sau:\n"
    "[DOCUMENTS]\n"
    "Chủ đề này được mô tả bởi các từ khóa sau: '[KEYWORDS]'.\n"
    "Dựa trên các tài liệu và từ khóa, hãy mô tả ngắn gọn chủ đề này nói về điều gì?\n"
)
ANSWER_FORMAT = (
    "\n\nTrả lời CHÍNH XÁC theo hai dòng:\n"
    "CẢM XÚC: tích cực | tiêu cực | trung lập\n"
    "TÓM TẮT: <một đoạn ngắn mô tả chủ đề>"
)

CACHE_SCHEMA = "prompt_hash string, prompt string, response string, backend_id string"


def prompt_hash(c) -> F.Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.md5(F.encode(x, "utf-8"))


def build_prompts(words: DataFrame, docs: DataFrame, template: str = DEFAULT_TEMPLATE,
                  n_keywords: int = 10, n_docs: int = 5, doc_col: str = "clean",
                  answer_format: str = ANSWER_FORMAT, topics: DataFrame | None = None) -> DataFrame:
    """(topic, prompt, prompt_hash) for every non-noise topic.

    ``topics`` lists them (topic info); without it, those that have keywords.
    A topic without keywords or documents keeps its prompt, with nothing in
    their place.  Documents are substituted first, then keywords (literal
    replacement, so a document containing ``[KEYWORDS]`` is substituted too).
    """
    kw = ordered_words(words, n_keywords, ", ", "__kw")
    dd = (docs.filter(F.col("rank") <= n_docs).groupBy("topic")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", doc_col))),
                                            lambda s: s[doc_col]), "\n").alias("__docs")))
    body = F.replace(F.replace(F.lit(template), F.lit("[DOCUMENTS]"), F.coalesce(F.col("__docs"), F.lit(""))),
                     F.lit("[KEYWORDS]"), F.coalesce(F.col("__kw"), F.lit("")))
    prompt = F.concat(body, F.lit(answer_format))
    every = kw if topics is None else topics.select("topic").join(kw, "topic", "left")
    return (every.join(dd, "topic", "left").filter(F.col("topic") != NOISE)
              .select(F.col("topic").cast("int").alias("topic"), prompt.alias("prompt"))
              .withColumn("prompt_hash", prompt_hash("prompt")))


def _cache_key(df: DataFrame, backend_id: str | None) -> DataFrame:
    return df.withColumn("__bid", F.lit(backend_id or ""))


def cache_split(prompts: DataFrame, cache: DataFrame | None, backend_id: str | None = None):
    """(hits, misses): hits carry the cached response.  Keyed by prompt hash and backend id."""
    if cache is None:
        return None, prompts
    c = (cache.select("prompt_hash", "response", F.coalesce(F.col("backend_id"), F.lit("")).alias("__bid"))
              .dropDuplicates(["prompt_hash", "__bid"]))
    p = _cache_key(prompts, backend_id)
    hits = p.join(c, ["prompt_hash", "__bid"], "inner").drop("__bid")
    misses = p.join(c, ["prompt_hash", "__bid"], "left_anti").drop("__bid")
    return hits, misses


def ask(backend: Callable[[str], str], prompt: str, waits: list[float]) -> tuple[str, bool]:
    """The backend's reply and True; once it has failed and no wait is left, the error marker and False."""
    try:
        return str(backend(prompt)).strip(), True
    except Exception as problem:  # noqa: BLE001 - one topic must not fail the job
        if not waits:
            return f"[ERROR: {problem}]", False
    time.sleep(waits[0])
    return ask(backend, prompt, waits[1:])


def generate(prompts: DataFrame, backend: Callable[[str], str], batch_size: int = 5,
             max_retries: int = 2, pause: float = 1.0) -> DataFrame:
    """Run a Python backend on executors: ``prompts`` -> + (response, ok).

    Topics are spread over ``ceil(topics / batch_size)`` tasks by hash of the
    topic id; each prompt is tried ``1 + max_retries`` times.
    """
    fields = prompts.columns
    schema = ", ".join(f"`{f}` {prompts.schema[f].dataType.simpleString()}" for f in fields)
    schema += ", response string, ok boolean"

    def run(batches):
        for rows in batches:
            answers = [ask(backend, p, [pause] * max_retries) for p in rows["prompt"]]
            yield rows.assign(response=[text for text, _ in answers], ok=[good for _, good in answers])

    n = prompts.select("topic").distinct().count()  # topic-level scalar
    parts = max(1, -(-n // max(1, batch_size)))
    return prompts.repartition(parts, "topic").mapInPandas(run, schema)


def respond_cached(prompts: DataFrame, backend, cache: DataFrame | None = None,
                   backend_id: str | None = None, **gen_kw):
    """Answer every prompt, reusing cached responses.

    Returns ``(responses(topic, prompt_hash, prompt, response, ok, cached), new_entries)``;
    ``new_entries`` holds only successful fresh responses, ready to append to the cache.
    Fresh responses are written once, so the backend sees each prompt once
    however often the results are read.
    """
    hits, misses = cache_split(prompts, cache, backend_id)
    if callable(backend) and not getattr(backend, "is_column_backend", False):
        fresh = generate(misses, backend, **gen_kw)
    else:
        fresh = misses.join(backend(misses), "topic").withColumn("ok", F.lit(True))
    fresh = cut_lineage(fresh.withColumn("cached", F.lit(False)))
    out = fresh
    if hits is not None:
        out = hits.withColumn("ok", F.lit(True)).withColumn("cached", F.lit(True)).unionByName(fresh)
    new_entries = (fresh.filter("ok")
                        .select("prompt_hash", "prompt", "response", F.lit(backend_id).cast("string").alias("backend_id")))
    return out, new_entries


def append_cache(new_entries: DataFrame, path: str) -> None:
    new_entries.write.mode("append").parquet(path)


def read_cache(spark, path: str) -> DataFrame | None:
    """The stored replies; None before the first is stored.  Lost storage or rights are errors, as paid replies would be asked for again."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def column_backend(fn):
    """Mark ``fn(prompts_df) -> DataFrame(topic, response)`` as a JVM-side backend."""
    fn.is_column_backend = True
    return fn


def extractive_backend(docs: DataFrame, scores: DataFrame, doc_col: str = "clean"):
    """Offline backend: the top representative document's best sentence.

    Sentences are scored by the mean c-TF-IDF weight (within the topic) of
    their word tokens; ties go to the earlier sentence.  The reply uses the
    two-line format with a neutral sentiment.
    """
    @column_backend
    def backend(prompts: DataFrame) -> DataFrame:
        top = docs.filter(F.col("rank") == 1).select("topic", doc_col)
        sent = top.select("topic", F.posexplode(F.split(F.col(doc_col), r"(?<=[.!?])\s+|\n")).alias("pos", "sentence"))
        toks = sent.select("topic", "pos", "sentence", F.explode_outer(word_tokens("sentence", WORD_TOKEN)).alias("word"))
        scored = (toks.join(scores.select("topic", "word", "score"), ["topic", "word"], "left")
                      .groupBy("topic", "pos", "sentence")
                      .agg(F.avg(F.coalesce(F.col("score"), F.lit(0.0))).alias("w")))
        w = Window.partitionBy("topic").orderBy(F.round("w", 12).desc(), F.col("pos"))
        best = scored.withColumn("__r", F.row_number().over(w)).filter("__r = 1")
        reply = F.concat(F.lit("CẢM XÚC: trung lập\nTÓM TẮT: "), strip_ws("sentence"))
        answer = prompts.select("topic").join(best.select("topic", reply.alias("response")), "topic", "left")
        return answer.withColumn("response", F.coalesce("response", F.lit("")))
    return backend


def parse_replies(df: DataFrame, col: str = "response") -> DataFrame:
    """``df`` + (sentiment, summary) parsed from ``col``.

    Three projections, each reading its input column more than once, so
    Catalyst keeps them apart and the reply is split into lines once, the
    last sentiment line is found once, and the labels come from that value.
    """
    cols = df.columns
    return (df.withColumn("__lines", reply_lines(col))
              .withColumn("__val", sentiment_value("__lines"))
              .withColumn("__joined", summary_text("__lines"))
              .select(*cols, sentiment_label("__val").alias("sentiment"),
                      summary_or_reply("__joined", col).alias("summary")))


def add_priority(df: DataFrame, info: DataFrame | None = None) -> DataFrame:
    """Priority from (count, sentiment): negative and count >= mean -> high,
    negative otherwise -> medium, else low.  Mean over the non-noise topics of
    ``info`` (of ``df`` without it), 0 if none."""
    mean = (df if info is None else info).filter(F.col("topic") != NOISE).agg(
        F.coalesce(F.avg("count"), F.lit(0.0))).scalar()
    pr = (F.when((F.col("sentiment") == NEGATIVE) & (F.col("count") >= mean), F.lit(PRIORITY_HIGH))
           .when(F.col("sentiment") == NEGATIVE, F.lit(PRIORITY_MEDIUM))
           .otherwise(F.lit(PRIORITY_LOW)))
    return df.withColumn("priority", pr)


def summarize_topics(info: DataFrame, words: DataFrame, responses: DataFrame) -> DataFrame:
    """(topic, keywords, summary, sentiment, priority) for non-noise topics.

    ``responses(topic, response[, ok])``: a failed response (ok = false) keeps
    its ``[ERROR: ...]`` text as the summary with a neutral sentiment.  Every
    topic of ``info`` has a row; one without a response has an empty summary
    and a neutral sentiment.
    """
    kw = ordered_words(words, 5, " | ", "keywords")
    r = responses if "ok" in responses.columns else responses.withColumn("ok", F.lit(True))
    r = parse_replies(r.select("topic", "response", "ok"))
    r = r.select("topic",
                 F.when(F.col("ok"), F.col("sentiment")).otherwise(F.lit(NEUTRAL)).alias("sentiment"),
                 F.when(F.col("ok"), F.col("summary")).otherwise(F.col("response")).alias("summary"))
    base = (info.filter(F.col("topic") != NOISE).select("topic", "count")
                .join(kw, "topic", "left").join(r, "topic", "left")
                .withColumn("sentiment", F.coalesce("sentiment", F.lit(NEUTRAL)))
                .withColumn("summary", F.coalesce("summary", F.lit(""))))
    return add_priority(base, info).select(F.col("topic").cast("int").alias("topic"),
                                     F.coalesce(F.col("keywords"), F.lit("")).alias("keywords"),
                                     "summary", "sentiment", "priority")


def topics_only(info: DataFrame) -> DataFrame:
    """Keyword-only output when summaries are off: (topic, keywords = name)."""
    return info.filter(F.col("topic") != NOISE).select("topic", F.col("name").alias("keywords"))


def topic_representations(words: DataFrame, responses: DataFrame) -> DataFrame:
    """(topic, original_keywords, text_representation) for non-noise topics."""
    kw = ordered_words(words, 5, " | ", "original_keywords")
    return (responses.filter(F.col("topic") != NOISE)
                     .join(kw, "topic", "left")
                     .select(F.col("topic").cast("int").alias("topic"),
                             F.coalesce(F.col("original_keywords"), F.lit("")).alias("original_keywords"),
                             strip_ws("response").alias("text_representation")))
