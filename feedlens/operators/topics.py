"""Topic representation: term counts, class-based tf-idf, top words, topic
info, representative documents, keyword comparisons, relabelling and run stats.

Shapes are long-form (``topic, word, ...``) so every step is a hash aggregate,
an equi join or a per-topic ranked window; documents are rows of ``terms``.
Per-topic top-k windows are written as ``row_number() <= k`` so Spark inserts a
partial ``WindowGroupLimit`` before the shuffle: a topic holding a third of all
documents ships only k rows per map task.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WORD_TOKEN, word_tokens
from ..session import cut_lineage
from . import terms as TM
from .order import row_index

NOISE = -1


def attach_topics(docs: DataFrame, topics: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs(id, ...) + topics(id, topic) -> docs with ``topic`` (inner join on id)."""
    return docs.join(topics.select(id_col, F.col("topic").cast("int").alias("topic")), id_col)


def topic_terms(docs: DataFrame, col: str = "clean", id_col: str = "doc_id", pattern: str = WORD_TOKEN) -> TM.Terms:
    """Written: the word tokens of each document with its ``topic``, in chunks."""
    return TM.chunked_terms(docs, col, id_col, pattern, ("topic",))


def term_counts(docs: DataFrame, col: str = "clean", pattern: str = WORD_TOKEN) -> DataFrame:
    """(topic, word, n): word tokens per topic, noise topic included."""
    return (docs.select("topic", F.explode(word_tokens(col, pattern)).alias("word"))
                .groupBy("topic", "word").agg(F.count(F.lit(1)).alias("n")))


def term_counts_from(terms: TM.Terms) -> DataFrame:
    """(topic, word, n) from :func:`topic_terms` (re-aggregates, no re-tokenising)."""
    return terms.words.groupBy("topic", "word").agg(F.sum("n").alias("n"))


def idf_table(tc: DataFrame) -> DataFrame:
    """(word, idf) with idf = ``ln(1 + A / f_word)``, ``A`` = int(mean words per topic),
    ``f_word`` the word's count over all topics.

    ``A`` is a scalar subquery over the topic totals: one value, no join.
    """
    per_topic = tc.groupBy("topic").agg(F.sum("n").alias("topic_total"))
    per_word = tc.groupBy("word").agg(F.sum("n").alias("word_total"))
    avg_words = per_topic.agg(F.floor(F.sum("topic_total") / F.count(F.lit(1))).cast("bigint")).scalar()
    return per_word.select("word", F.log(1.0 + avg_words / F.col("word_total")).alias("idf"))


def ctfidf(tc: DataFrame, idf: DataFrame | None = None) -> DataFrame:
    """(topic, word, n, score): class-based tf-idf ``n / sum_topic(n) * idf(word)``."""
    if idf is None:
        idf = idf_table(tc)
    per_topic = tc.groupBy("topic").agg(F.sum("n").alias("topic_total"))
    return (tc.join(per_topic, "topic").join(idf, "word")
              .select("topic", "word", "n", (F.col("n") / F.col("topic_total") * F.col("idf")).alias("score")))


def top_words(scores: DataFrame, n: int = 10, score_col: str = "score") -> DataFrame:
    """(topic, rank, word, score): top ``n`` words per topic, ties by word."""
    w = Window.partitionBy("topic").orderBy(F.col(score_col).desc(), F.col("word"))
    return (scores.withColumn("rank", F.row_number().over(w))
                  .filter(F.col("rank") <= n)
                  .select("topic", F.col("rank").cast("int").alias("rank"), "word",
                          F.col(score_col).alias("score")))


def ordered_words(words: DataFrame, n: int, sep: str, name: str = "keywords") -> DataFrame:
    """(topic, name): first ``n`` ranked words joined by ``sep``."""
    return (words.filter(F.col("rank") <= n)
                 .groupBy("topic")
                 .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))),
                                               lambda s: s["word"]), sep).alias(name)))


def topic_counts(topics: DataFrame) -> DataFrame:
    return topics.groupBy("topic").agg(F.count(F.lit(1)).alias("count"))


def topic_info(topics: DataFrame, words: DataFrame) -> DataFrame:
    """(topic, count, name) with name ``"{topic}_{w1}_{w2}_{w3}_{w4}"``."""
    names = ordered_words(words, 4, "_", "__w")
    return (topic_counts(topics).join(names, "topic", "left")
              .select(F.col("topic").cast("int").alias("topic"), F.col("count").cast("bigint").alias("count"),
                      F.concat_ws("_", F.col("topic").cast("string"), F.col("__w")).alias("name")))


def representative_docs(docs: DataFrame, scores: DataFrame, idf: DataFrame, n: int = 5, col: str = "clean",
                        id_col: str = "doc_id", terms: TM.Terms | None = None) -> DataFrame:
    """(topic, rank, doc_id, clean, similarity): a topic's documents ranked by
    cosine(doc c-TF-IDF, topic c-TF-IDF); ties by id.

    ``scores``/``idf`` are the outputs of :func:`ctfidf`/:func:`idf_table`, ``terms``
    the documents' words by topic (:func:`topic_terms`).  Weights move once per
    chunk of documents, topic and word and meet the documents there; nothing is
    collected per topic; the top-n window gets a partial group limit before its
    shuffle.
    """
    if terms is None:
        terms = topic_terms(docs, col, id_col)
    tw = scores.select("topic", "word", F.col("score").alias("wt"))
    tnorm = tw.groupBy("topic").agg(F.sqrt(F.sum(F.col("wt") * F.col("wt"))).alias("tn"))
    weights = (terms.words.select("chunk", "topic", "word", "code").join(idf.select("word", "idf"), "word")
                    .join(tw, ["topic", "word"], "left").select("chunk", "topic", "code", "idf", F.coalesce("wt", F.lit(0.0)).alias("wt")))

    def sums(d: pa.Table, w: pa.Table) -> pa.Table:
        f = TM.flat(d, w, ("topic",))
        wd = f.tf / f.total[f.doc] * w.column("idf").to_numpy()[f.at]
        seen = np.bincount(f.doc, minlength=f.n) > 0
        out = d.select([id_col, "topic"]).append_column("dot", pa.array(np.bincount(f.doc, wd * w.column("wt").to_numpy()[f.at], f.n)))
        return out.append_column("dn", pa.array(np.sqrt(np.bincount(f.doc, wd * wd, f.n)))).filter(pa.array(seen))

    kept = terms.rows.where("topic is not null")
    names = kept.select(id_col, "topic").schema
    per_doc = TM.with_weights(kept, weights, sums, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in names) + ", dot double, dn double")
    sim = (per_doc.join(tnorm, "topic")
                  .withColumn("similarity", F.col("dot") / (F.col("dn") * F.col("tn"))))
    w = Window.partitionBy("topic").orderBy(F.round("similarity", 9).desc(), F.col(id_col))
    ranked = (sim.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
                 .select("topic", F.col("rank").cast("int").alias("rank"), id_col, "similarity"))
    # written, so that its size is known before the texts would move
    return cut_lineage(ranked).join(docs.select(id_col, col), id_col).select("topic", "rank", id_col, col, "similarity")


def topic_differences(before: DataFrame, after: DataFrame, nr_topics: int = 5) -> DataFrame:
    """(topic, original, updated): top 5 words before/after, topics 0..nr_topics-1."""
    b = ordered_words(before, 5, " | ", "original")
    a = ordered_words(after, 5, " | ", "updated")
    return (b.join(a, "topic").filter((F.col("topic") >= 0) & (F.col("topic") < nr_topics))
             .select(F.col("topic").cast("int").alias("topic"), "original", "updated"))


def relabel_by_size(topics: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Renumber non-noise topics 0.. by size descending (ties: smallest id first)."""
    sizes = (topics.filter(F.col("topic") != NOISE).groupBy("topic")
                   .agg(F.count(F.lit(1)).alias("__n"), F.min(id_col).alias("__first")))
    # The topic count grows with the data: rank by a distributed sort, not a
    # single-partition window.  ``__first`` (a document id) makes the order total.
    mapping = (row_index(sizes, [F.col("__n").desc(), F.col("__first")], "__new")
               .select(F.col("topic").alias("__old"), F.col("__new").cast("int").alias("__new")))
    # noise, the largest group, stays out of the join
    others = [c for c in topics.columns if c != "topic"]
    named = topics.filter(F.col("topic") != NOISE).join(mapping, F.col("topic") == F.col("__old")).select(
        *others, F.col("__new").alias("topic"))
    noise = topics.filter(F.coalesce(F.col("topic") == NOISE, F.lit(True)))
    return named.unionByName(noise.select(*others, F.lit(NOISE).cast("int").alias("topic")))


def run_stats(topics: DataFrame) -> DataFrame:
    """(total, n_topics, n_noise)."""
    return topics.agg(F.count(F.lit(1)).alias("total"),
                      F.count_distinct(F.when(F.col("topic") != NOISE, F.col("topic"))).alias("n_topics"),
                      F.count_if(F.col("topic") == NOISE).alias("n_noise"))
