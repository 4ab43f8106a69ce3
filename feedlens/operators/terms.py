"""The words of documents in chunks, and what is known of a word brought to the chunks that hold it.

A long table with a row per document and word is several times the text, and
every join or aggregate over it moves all of it.  Here a document stays one row
(its words and how often it has each), documents stand together in chunks of
about CHUNK_WORDS words, numbered within the chunk, and what moves by word is
one row per chunk and word: weights are joined to those and then meet the
chunk's documents in one Arrow kernel.  A chunk is bounded, whatever the table,
but for its last document.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import WORD_TOKEN, word_tokens
from ..session import cut_lineage

CHUNK_WORDS = 1 << 20


class Terms(NamedTuple):
    """``rows`` (``chunk, id, *by, codes, tf``), written, and ``words`` (``chunk, *by, word, code, n, df``), read from the same table."""

    rows: DataFrame
    words: DataFrame


def chunked_terms(docs: DataFrame, col: str = "clean", id_col: str = "doc_id", pattern: str = WORD_TOKEN,
                  by: tuple[str, ...] = ()) -> Terms:
    """The words of ``col``; rows that share ``id_col`` (null too) and ``by`` count as one document.

    A document without words is a row with empty arrays.
    """
    keys = [id_col, *by]
    dealt = docs.select(*keys, F.col(col).alias("__text")).repartition(*keys).sortWithinPartitions(*keys)
    src = dealt.select(*keys, F.coalesce(word_tokens("__text", pattern), F.array().cast("array<string>")).alias("__t"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 32
        kinds, chunk = None, 0
        ids, doc, held, parts = [], [], 0, []   # of the open chunk: keys, the document of each row, words

        def close():
            sizes = np.concatenate([p[0] for p in parts])
            coded = pa.chunked_array([p[1] for p in parts], pa.string()).combine_chunks().dictionary_encode()
            names, k = coded.dictionary, max(len(coded.dictionary), 1)
            pair, tf = np.unique(np.repeat(np.array(doc), sizes) * k + coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True)
            d, code = pair // k, pair % k
            ends = np.searchsorted(d, np.arange(len(ids) + 1))
            yield table([i for i in ids], ends, code, tf)
            # the words of the chunk, by ``by``
            groups = {g: n for n, g in enumerate(dict.fromkeys(i[1:] for i in ids))}
            of = np.array([groups[i[1:]] for i in ids])
            both, inverse, df = np.unique(of[d] * k + code, return_inverse=True, return_counts=True)
            n = np.bincount(inverse, tf, len(both)).astype(np.int64)
            ends = np.searchsorted(both // k, np.arange(len(groups) + 1))
            yield table([(None, *g) for g in groups], ends, both % k, n, df, names)

        def table(rows, ends, code, n, df=None, names=None):
            lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), x if isinstance(x, pa.Array) else pa.array(x, kind))
            cols = [pa.array([first + chunk] * len(rows), pa.int64()), *(pa.array([r[j] for r in rows], kinds[j]) for j in range(len(keys))),
                    lists(code, pa.int32()), lists(n, pa.int64()),
                    pa.nulls(len(rows), pa.list_(pa.int64())) if df is None else lists(df, pa.int64()),
                    pa.nulls(len(rows), pa.list_(pa.string())) if df is None else lists(names.take(pa.array(code)), None)]
            return pa.RecordBatch.from_arrays(cols, names=["chunk", *keys, "codes", "tf", "df", "names"])

        for batch in batches:
            kinds = [batch.schema.field(k).type for k in keys]
            words = batch.column("__t")
            sizes, at = np.diff(np.asarray(words.offsets)), 0
            for i, key in enumerate(zip(*(batch.column(k).to_pylist() for k in keys))):
                if not ids or ids[-1] != key:
                    if held >= CHUNK_WORDS:
                        parts.append((sizes[at:i], words.slice(at, i - at).flatten()))
                        yield from close()
                        ids, doc, held, parts, at, chunk = [], [], 0, [], i, chunk + 1
                    ids.append(key)
                doc.append(len(ids) - 1)
                held += int(sizes[i])
            parts.append((sizes[at:], words.slice(at).flatten()))
        if ids:
            yield from close()

    kept = src.select(*keys).schema
    schema = ", ".join(["chunk bigint", *(f"`{f.name}` {f.dataType.simpleString()}" for f in kept),
                        "codes array<int>, tf array<bigint>, df array<bigint>, names array<string>"])
    both = cut_lineage(src.mapInArrow(number, schema))
    words = both.where("names is not null").select("chunk", *by, F.explode(F.arrays_zip("names", "codes", "tf", "df")).alias("w"))
    return Terms(both.where("names is null").select("chunk", *keys, "codes", "tf"),
                 words.select("chunk", *by, F.col("w.names").alias("word"), F.col("w.codes").alias("code"), F.col("w.tf").alias("n"), "w.df"))


class Flat(NamedTuple):
    """The words of a chunk's documents that are in its table of weights, flat."""

    doc: np.ndarray     # place of the document ...
    at: np.ndarray      # ... and of the weight
    tf: np.ndarray
    n: int              # documents
    total: np.ndarray   # words of each document, unknown ones too


def flat(docs: pa.Table, weights: pa.Table, by: tuple[str, ...] = ()) -> Flat:
    """``weights`` has a row per ``code`` (and ``by``) that has a weight."""
    n, of = docs.num_rows, lambda t, c: t.column(c).combine_chunks()
    doc = np.repeat(np.arange(n), np.asarray(pc.list_value_length(of(docs, "codes"))))
    code = np.asarray(of(docs, "codes").flatten()).astype(np.int64)
    tf = np.asarray(of(docs, "tf").flatten()).astype(np.float64)
    known = np.asarray(of(weights, "code")).astype(np.int64)
    for c in by:  # one number for a code and its group
        names = pc.unique(of(weights, c))
        mine = np.asarray(pc.fill_null(pc.index_in(of(docs, c), value_set=names), len(names)))
        code, known = code * (len(names) + 1) + mine[doc], known * (len(names) + 1) + np.asarray(pc.index_in(of(weights, c), value_set=names))
    order = np.argsort(known, kind="stable")
    place = np.minimum(np.searchsorted(known[order], code), max(len(known) - 1, 0))
    ok = known[order][place] == code if len(known) else np.zeros(len(code), bool)
    return Flat(doc[ok], order[place[ok]] if len(known) else place[ok], tf[ok], n, np.bincount(doc, tf, n))


def with_weights(rows: DataFrame, weights: DataFrame, kernel: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``kernel(documents, weights)`` of each chunk; ``weights`` has a row per chunk and word."""
    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        return kernel(docs, table)

    fresh = rows.select(*[F.col(c).alias(c) for c in rows.columns])  # both sides may come from one table
    return fresh.groupBy("chunk").cogroup(weights.groupBy("chunk")).applyInArrow(run, schema)
