"""Document vectors: the hashed tf-idf encoder, user encoders, and the cache.

``encode_hashed``: tokens -> words of documents in chunks (``terms``) -> document
frequency per word -> md5 bucket and sign per *distinct word* (not per token)
-> weights to the chunks that hold a word -> sums per bucket, L2 normalisation.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import md5_bucket, md5_sign
from ..functions.text import WORD_TOKEN, word_tokens
from ..session import cut_lineage
from . import terms as TM


def dense_from_pairs(pairs: DataFrame, id_col: str, dim: int, idx: str = "bucket", val: str = "v") -> DataFrame:
    """(id, idx, val) long rows -> (id, vec ARRAY<DOUBLE>) of length ``dim`` (bounded per id)."""
    # entries with a NULL index (ids without any entry) are skipped: all zeros
    m = F.map_from_entries(F.collect_list(F.when(F.col(idx).isNotNull(), F.struct(F.col(idx), F.col(val)))))
    return (pairs.groupBy(id_col).agg(m.alias("__m"))
                 .select(id_col, F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                                             lambda i: F.coalesce(F.col("__m")[i], F.lit(0.0))).alias("vec")))


def hashed_vocab(docs: DataFrame, dim: int = 64, col: str = "clean", id_col: str = "doc_id",
                 pattern: str = WORD_TOKEN, sign_bit: int = 16, terms: TM.Terms | None = None) -> DataFrame:
    """(word, idf, bucket, sign) learned from a corpus; reusable to encode new text."""
    return _vocab(terms or TM.chunked_terms(docs, col, id_col, pattern), docs, dim, sign_bit)


def _vocab(terms: TM.Terms, docs: DataFrame, dim: int, sign_bit: int) -> DataFrame:
    n = docs.agg(F.count(F.lit(1))).scalar()
    return (terms.words.groupBy("word").agg(F.sum("df").alias("df"))
                 .select("word", F.log((n + 1.0) / (F.col("df") + 1.0)).alias("idf"),
                         md5_bucket("word", dim).alias("bucket"), md5_sign("word", sign_bit).alias("sign")))


def encode_hashed(docs: DataFrame, dim: int = 64, col: str = "clean", id_col: str = "doc_id",
                  pattern: str = WORD_TOKEN, sign_bit: int = 16, vocab: DataFrame | None = None,
                  terms: TM.Terms | None = None) -> DataFrame:
    """(doc_id, vec): signed feature hashing of tf-idf, L2-normalised.

    weight = tf * ln((n + 1) / (df + 1)); bucket = md5int(word) % dim; sign from
    bit ``sign_bit`` of md5int(word).  Documents without tokens get a zero vector.
    With ``vocab`` (from :func:`hashed_vocab` of a training corpus) new text is
    encoded with the training idf; unknown words are ignored.  ``terms`` are the
    words of ``docs``, where they are at hand.
    """
    terms = terms or TM.chunked_terms(docs, col, id_col, pattern)
    if vocab is None:
        vocab = _vocab(terms, docs, dim, sign_bit)
    weights = terms.words.select("chunk", "word", "code").join(vocab, "word").select(
        "chunk", "code", "bucket", (F.col("sign") * F.col("idf")).alias("w"))

    def vectors(d: pa.Table, w: pa.Table) -> pa.Table:
        f = TM.flat(d, w)
        v = np.bincount(f.doc * dim + w.column("bucket").to_numpy()[f.at], f.tf * w.column("w").to_numpy()[f.at], f.n * dim).reshape(f.n, dim)
        norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
        return _vectors(d.column(id_col), np.divide(v, norm, out=np.zeros_like(v), where=norm > 0), id_col)

    return TM.with_weights(terms.rows, weights, vectors, _vector_schema(terms.rows, id_col))


def _vectors(ids, v: np.ndarray, id_col: str) -> pa.Table:
    ends = pa.array(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1])
    return pa.table([ids, pa.ListArray.from_arrays(ends, pa.array(v.ravel()))], names=[id_col, "vec"])


def _vector_schema(rows: DataFrame, id_col: str) -> str:
    return f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, vec array<double>"


def vector_long(df: DataFrame, id_col: str = "doc_id", vec: str = "vec", name: str = "dim") -> DataFrame:
    """(id, dim, value) long form of a vector column."""
    return df.select(id_col, F.posexplode(vec).alias(name, "value"))


def embed_texts(df: DataFrame, make_encoder: Callable, dim: int, col: str = "clean",
                id_col: str = "doc_id", batch_size: int = 32) -> DataFrame:
    """(doc_id, vec) with a user encoder run on executors in Arrow batches.

    ``make_encoder()`` is called once per Python worker and must return
    ``fn(np.ndarray[str]) -> np.ndarray[float, (n, dim)]`` (e.g. a sentence
    model's ``encode``).
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, DoubleType

    udf = predict_batch_udf(make_encoder, return_type=ArrayType(DoubleType()), batch_size=batch_size,
                            input_tensor_shapes=None)
    return df.select(id_col, udf(F.col(col)).alias("vec"))


def text_key(c) -> F.Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.sha2(F.encode(x, "utf-8"), 256)


def embed_cached(df: DataFrame, cache: DataFrame | None, encoder: Callable[[DataFrame], DataFrame],
                 col: str = "clean", id_col: str = "doc_id"):
    """Reuse cached vectors keyed by sha-256 of the text; encode only the misses.

    ``cache(text_key, vec)``; ``encoder(df(id, col)) -> df(id, vec)``.
    Returns ``(vectors(id, vec, cached), new_entries(text_key, vec))`` -- the
    caller appends ``new_entries`` to the cache table.
    """
    keyed = df.select(id_col, col, text_key(col).alias("text_key"))
    if cache is None:
        hits = None
        misses = keyed
    else:
        c = cache.select("text_key", "vec").dropDuplicates(["text_key"])
        hits = keyed.join(c, "text_key").select(id_col, "vec", F.lit(True).alias("cached"))
        misses = keyed.join(c, "text_key", "left_anti")
    misses = cut_lineage(misses)
    fresh = cut_lineage(encoder(misses.select(id_col, col)).join(misses.select(id_col, "text_key"), id_col))
    out = fresh.select(id_col, "vec", F.lit(False).alias("cached"))
    if hits is not None:
        out = hits.unionByName(out)
    return out, fresh.select("text_key", "vec")


def encode_word2vec(docs: DataFrame, size: int = 32, min_count: int = 5, seed: int = 42,
                    col: str = "clean", id_col: str = "doc_id", window: int = 5, max_iter: int = 1,
                    parts: int | None = None):
    """Words and documents in one space (MLlib Word2Vec; doc = mean of word vectors).

    Trains in ``parts`` tasks whose models MLlib averages (the session's shuffle
    partitions if not given).  The vocabulary's vectors pass through the driver,
    as MLlib has it; :func:`random_index` has no such bound.
    Returns ``(doc_vectors(doc_id, vec), word_vectors(word, vec))``.
    """
    from pyspark.ml.feature import Word2Vec

    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    toks = docs.select(id_col, word_tokens(col).alias("tokens"))
    model = Word2Vec(vectorSize=size, minCount=min_count, seed=seed, inputCol="tokens", outputCol="__v",
                     windowSize=window, maxIter=max_iter, numPartitions=parts).fit(toks)
    from pyspark.ml.functions import vector_to_array
    doc_vecs = model.transform(toks).select(id_col, vector_to_array("__v").alias("vec"))
    word_vecs = model.getVectors().select("word", vector_to_array("vector").alias("vec"))
    return doc_vecs, word_vecs


def random_index(docs: DataFrame, dim: int = 32, min_count: int = 5, entries: int = 4, col: str = "clean",
                 id_col: str = "doc_id", pattern: str = WORD_TOKEN):
    """Words and documents in one space by random indexing.

    Every document has ``entries`` signed places of ``dim``, from md5 of its id;
    a word's vector sums them over the documents it stands in, times its count
    there; a document's vector is the mean of its words' vectors.  Words that
    stand in the corpus fewer than ``min_count`` times are left out.  Both sums
    are taken chunk by chunk of documents.
    Returns ``(doc_vectors(doc_id, vec), word_vectors(word, vec))``; documents
    without an id or a known word have a zero vector.
    """
    terms = TM.chunked_terms(docs, col, id_col, pattern)
    known = terms.words.groupBy("word").agg(F.sum("n").alias("__n")).filter(F.col("__n") >= min_count).select("word")
    held = cut_lineage(terms.words.select("chunk", "code", "word").join(known, "word"))
    place = [F.concat(F.col(id_col).cast("string"), F.lit(f":{e}")) for e in range(entries)]
    marked = terms.rows.where(F.col(id_col).isNotNull()).withColumns({
        "buckets": F.array(*[md5_bucket(x, dim) for x in place]), "signs": F.array(*[md5_sign(x) for x in place])})

    def word_sums(d: pa.Table, w: pa.Table) -> pa.Table:
        f = TM.flat(d, w)
        v = np.zeros(w.num_rows * dim)
        buckets, signs = (np.asarray(d.column(c).combine_chunks().flatten()).reshape(f.n, entries) for c in ("buckets", "signs"))
        for e in range(entries):
            v += np.bincount(f.at * dim + buckets[f.doc, e], f.tf * signs[f.doc, e], len(v))
        return _vectors(w.column("word"), v.reshape(-1, dim), "word")

    parts = TM.with_weights(marked, held, word_sums, "word string, vec array<double>")
    places = [F.col("vec")[i].alias(f"__{i}") for i in range(dim)]
    sums = parts.select("word", *places).groupBy("word").agg(*[F.sum(f"__{i}").alias(f"__{i}") for i in range(dim)])
    words = cut_lineage(sums.select("word", F.array(*[F.col(f"__{i}") for i in range(dim)]).alias("vec")))

    def means(d: pa.Table, w: pa.Table) -> pa.Table:
        f = TM.flat(d, w)
        table = np.asarray(w.column("vec").combine_chunks().flatten()).reshape(-1, dim)
        n, v = np.bincount(f.doc, f.tf, f.n), np.empty((f.n, dim))
        for i in range(dim):
            v[:, i] = np.bincount(f.doc, f.tf * table[f.at, i], f.n)
        v = np.divide(v, n[:, None], out=np.zeros_like(v), where=n[:, None] > 0)
        v[np.asarray(pc.is_null(d.column(id_col)))] = 0.0
        return _vectors(d.column(id_col), v, id_col)

    return TM.with_weights(terms.rows, held.join(words, "word").drop("word"), means, _vector_schema(terms.rows, id_col)), words
