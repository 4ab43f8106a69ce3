"""Data-derived fixtures used by the registered queries.

Everything here is computed by Spark from the given tables, so the work grows
with them.  The topic fixture stands in for a clustering result where an exact
oracle is wanted: ``-1`` for documents under 200 characters, else the language
(en 0, fr 1, de 2, es 3).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.text import preprocess
from ..session import spread, table
from ..sources.feedback import to_feedback

LANG_TOPIC = {"en": 0, "fr": 1, "de": 2, "es": 3}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(to_feedback(documents(spark, sf_dir), "text", id_column="doc_id"))


def prepared(spark: SparkSession, sf_dir: str, keep_text: bool = True) -> DataFrame:
    return preprocess(feedback(spark, sf_dir), keep_text=keep_text)


def fixture_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    t = F.when(F.col("n_chars") < 200, F.lit(-1))
    for lang, tid in LANG_TOPIC.items():
        t = t.when(F.col("lang") == lang, F.lit(tid))
    return d.select("doc_id", t.otherwise(F.lit(-1)).cast("int").alias("topic"))


def prepared_with_topics(spark: SparkSession, sf_dir: str, keep_text: bool = True) -> DataFrame:
    return prepared(spark, sf_dir, keep_text).join(fixture_topics(spark, sf_dir), "doc_id")


def canned_reply(topic_col, kw_col):
    """A reply per topic made from its keywords; the four variants cover the
    parsing branches (negative, last-line-wins, positive with blank lines and a
    bare summary prefix, unformatted text)."""
    t = F.col(topic_col) % 4
    kw = F.col(kw_col)
    return (F.when(t == 0, F.concat(F.lit("CẢM XÚC: tiêu cực\nTÓM TẮT: Khách hàng nói về "), kw))
             .when(t == 1, F.concat(F.lit("Sentiment: positive\nSentiment: negative\nSummary: "), kw, F.lit(": chi tiết")))
             .when(t == 2, F.concat(F.lit("cam xuc: tich cuc\n\n  "), kw, F.lit("  \nTÓM TẮT:")))
             .otherwise(kw))


def canned_reply_topic(topic_col):
    """A keyword-free reply per topic (sentiment fixture for trends): topics
    0 and 1 (mod 4) come out negative."""
    t = F.col(topic_col) % 4
    return (F.when(t == 0, F.lit("CẢM XÚC: tiêu cực"))
             .when(t == 1, F.lit("Sentiment: positive\nSentiment: negative"))
             .when(t == 2, F.lit("cam xuc: tich cuc"))
             .otherwise(F.lit("")))
