"""End-to-end composition: feedback table -> topics, keywords, summaries, report."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cluster as CL
from ..operators import embed as EM
from ..operators import keywords as KW
from ..operators import reduce as RD
from ..operators import report as R
from ..operators import summarize as S
from ..operators import terms as TM
from ..operators import topics as TP
from ..operators.text import DEFAULT_STOPWORDS, preprocess
from ..operators.trends import topic_centroids
from ..session import cut_lineage
from ..sources.feedback import require_min_docs, to_feedback
from ..sources.sinks import save_topic_model


CANDIDATES = 100  # c-TF-IDF words of a topic that embedding keywords are chosen from


@dataclass
class Options:
    text_column: str = "text"
    id_column: str | None = "doc_id"
    lowercase: bool = True
    min_chars: int = 3
    dedup: bool = True
    stopwords: tuple = DEFAULT_STOPWORDS
    dim: int = 64
    eps: float = 1.0
    min_samples: int = 3
    min_cluster_size: int = 5
    n_keywords: int = 10
    n_docs: int = 5
    summarize: bool = True
    backend: object = None            # Python callable str -> str; None = offline extractive backend
    cache: DataFrame | None = None    # response cache table, read only
    cache_path: str | None = None     # response cache that is read and then appended to
    backend_id: str | None = None     # keeps the responses of different backends apart
    model_path: str | None = None     # where the topic model is saved
    lexicon: DataFrame | None = None  # phrases for word segmentation
    min_docs: int = 5
    encoder: object = None            # makes an encoder of ``dim`` dimensions (see embed_texts); None = hashed tf-idf
    embed_cache_path: str | None = None   # vectors of an encoder by text, read and then appended to
    reduce_dim: int | None = None     # clusters are sought in so many random projections
    clustering: str = "flat"          # one cut at ``eps``; or the hierarchy's "leaf" or "eom" clusters
    exact: bool = True                # the hierarchy is that of all pairs; else of the lists that meet ...
    recall: float = 0.95              # ... and this is the share of neighbours that they must find
    embedding_keywords: bool = False  # c-TF-IDF candidates ranked by their vectors
    silhouette: bool = False          # one more column of the statistics; compares all pairs


@dataclass
class Result:
    docs: DataFrame
    vectors: DataFrame
    topics: DataFrame
    words: DataFrame
    info: DataFrame
    rep_docs: DataFrame
    summaries: DataFrame | None
    report: DataFrame
    stats: DataFrame


def analyze(df: DataFrame, opts: Options | None = None) -> Result:
    """Ingest -> preprocess (segment) -> guard -> embed (cache) -> (reduce) -> density clusters -> relabel ->
    c-TF-IDF -> representative docs -> keywords -> (summaries) -> report, statistics (silhouette).

    The cleaned documents, the doc-term table and the vectors are written to
    the shared checkpoint folder once (each feeds several consumers, and the
    clustering iterates), so nothing replays the text work and no executor
    memory is pinned between stages.
    """
    o = opts or Options()
    if not o.text_column:
        raise ValueError("text_column must be set")
    fb = to_feedback(df, o.text_column, o.id_column)
    docs = cut_lineage(preprocess(fb, lowercase=o.lowercase, min_chars=o.min_chars, dedup=o.dedup,
                                  stopwords=o.stopwords, lexicon=o.lexicon))
    require_min_docs(docs, o.min_docs)
    vecs, word_vecs = _vectors(docs, o)
    space, dim = vecs, o.dim
    if o.reduce_dim:
        space, dim = cut_lineage(RD.reduce_random(vecs, o.dim, o.reduce_dim).select("doc_id", F.col("rvec").alias("vec"))), o.reduce_dim
    if o.clustering == "flat":
        clusters = CL.density_cluster_at(space, o.eps, dim, o.min_samples, o.min_cluster_size)
    else:
        clusters = CL.density_cluster_tree(space, o.min_cluster_size, o.min_samples, method=o.clustering, recall=o.recall, exact=o.exact)
    topics = cut_lineage(TP.relabel_by_size(clusters.select("doc_id", F.col("cluster").alias("topic"))))
    dtop = docs.join(topics, "doc_id")
    # The documents' words feed both the topic counts and the doc vectors of the
    # representative-document step.  Topic-level tables (bounded by
    # topics x vocabulary) are checkpointed so the many downstream consumers
    # start from short plans instead of re-inlining the whole upstream tree.
    dt = TP.topic_terms(dtop)
    tc = TP.term_counts_from(dt)
    idf = cut_lineage(TP.idf_table(tc))
    scores = cut_lineage(TP.ctfidf(tc, idf))
    rep = cut_lineage(TP.representative_docs(dtop, scores, idf, o.n_docs, terms=dt))
    if o.embedding_keywords:
        cands = cut_lineage(TP.top_words(scores, CANDIDATES))
        words = KW.embedding_keywords(cands, KW.topic_vectors(rep, vecs, o.dim, o.n_docs), word_vecs(cands.select("word").distinct()),
                                      CANDIDATES, o.n_keywords)
    else:
        words = TP.top_words(scores, o.n_keywords)
    words = cut_lineage(words)
    info = cut_lineage(TP.topic_info(topics, words))
    if o.summarize:
        prompts = S.build_prompts(words, rep, n_keywords=o.n_keywords, n_docs=o.n_docs, topics=info)
        backend = o.backend or S.extractive_backend(rep, scores)
        cache = S.read_cache(df.sparkSession, o.cache_path) if o.cache_path else o.cache
        responses, fresh = S.respond_cached(prompts, backend, cache, o.backend_id)
        if o.cache_path:
            S.append_cache(fresh, o.cache_path)
        summaries = S.summarize_topics(info, words, responses)
    else:
        summaries = None
    if o.model_path:
        save_topic_model({"centroids": topic_centroids(vecs, topics, o.dim), "words": words, "idf": idf, "info": info},
                         {"dim": o.dim, "eps": o.eps, "min_samples": o.min_samples,
                          "min_cluster_size": o.min_cluster_size}, o.model_path)
    report = R.topic_report(info, words, rep, summaries, n_docs=o.n_docs)
    stats = TP.run_stats(topics)
    if o.silhouette:
        stats = stats.withColumn("silhouette", CL.silhouette(space, topics, dim).scalar())
    return Result(docs, vecs, topics, words, info, rep, summaries, report, stats)


def _vectors(docs: DataFrame, o: Options):
    """The documents' vectors, and what gives the vectors of a table of words in the same space."""
    if o.encoder is None:
        if o.embed_cache_path:
            raise ValueError("a cache of vectors needs an encoder: hashed vectors depend on the corpus")
        terms = TM.chunked_terms(docs)
        vocab = cut_lineage(EM.hashed_vocab(docs, o.dim, terms=terms))
        vecs = cut_lineage(EM.encode_hashed(docs, o.dim, vocab=vocab, terms=terms))
        return vecs, lambda words: KW.hashed_word_vectors(vocab.join(words, "word", "left_semi"), o.dim)
    encode = lambda m, col="clean", key="doc_id": EM.embed_texts(m, o.encoder, o.dim, col, key)
    if o.embed_cache_path:
        vecs, fresh = EM.embed_cached(docs, _stored(docs.sparkSession, o.embed_cache_path), encode)
        fresh.write.mode("append").parquet(o.embed_cache_path)
        vecs = vecs.drop("cached")
    else:
        vecs = cut_lineage(encode(docs))
    return vecs, lambda words: encode(words.withColumn("text", F.col("word")), "text", "word")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table, None before it is first written."""
    try:
        return spark.read.schema("text_key string, vec array<double>").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic report for the documents table of ``sf_dir``."""
    from ..session import table
    return analyze(table(spark, sf_dir, "documents")).report
