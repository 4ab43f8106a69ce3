"""Exact dedup by content-defined chunk recipes.

Each text is cut into chunks at places its own bytes choose, so texts that
share passages share chunks.  A chunk's bytes move once, to verify that its
digest stands for one content only; after that a text is its ordered list of
chunk identifiers (its recipe), some 3 % of its size, and two texts are equal
when their recipes are.  Whole texts are never grouped, sorted or joined.

Defined results: a null text counts as empty, and empty texts equal each other;
of rows that repeat both id and text exactly one stays; null ids rank below
all others; an empty table gives an empty result; other columns of the input
may have any name.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_batches, bounded_batches, text_bytes, written

MIN_CHUNK, MAX_CHUNK, MEAN_BITS = 256, 8192, 10


def cut_points(b: bytes, least: int = MIN_CHUNK, most: int = MAX_CHUNK, bits: int = MEAN_BITS) -> list[int]:
    """Ends of the content-defined chunks of ``b``.

    A place may end a chunk when the hash of the 8 bytes before it falls in one
    of 2^bits classes; chunks are at least ``least`` and at most ``most`` long.
    """
    n = len(b)
    if n <= least:
        return [n] if n else []
    window = np.ndarray((n - 7,), dtype="<u8", buffer=b, strides=(1,))
    places = np.flatnonzero((window * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits) == 0) + 8
    ends, at = [], 0
    for p in [*places.tolist(), n]:
        while p - at > most:
            at += most
            ends.append(at)
        if p - at >= least or (p == n and p > at):
            at = p
            ends.append(at)
    return ends


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_row: bool = False,
            digest_bytes: int = 32) -> DataFrame:
    """One written row per document: ``rid, id, text, sha, ends, recipe`` (and ``row`` with all columns).

    ``rid`` numbers the rows of this written table; ``ends`` are the chunk ends
    in bytes and ``recipe`` the chunk digests in order (``digest_bytes`` of
    SHA-256; less than 32 only to test colliding digests).
    """
    bounded_batches(docs.sparkSession)
    cols = [F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text")]
    if keep_row:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    src = docs.select(*cols)
    extra = pa.schema([("sha", pa.string()), ("ends", pa.list_(pa.int32())), ("recipe", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, all_ends, digests = [], [], []
            for b in text_bytes(batch, "text"):
                ends, at, ds = cut_points(b), 0, []
                for e in ends:
                    ds.append(hashlib.sha256(b[at:e]).digest()[:digest_bytes])
                    at = e
                shas.append(hashlib.sha256(b).hexdigest())
                all_ends.append(ends)
                digests.append(ds)
            made = [pa.array(v, f.type) for v, f in zip((shas, all_ends, digests), extra)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *extra.names])

    schema = T.StructType([*src.schema, T.StructField("sha", T.StringType()),
                           T.StructField("ends", T.ArrayType(T.IntegerType())),
                           T.StructField("recipe", T.ArrayType(T.BinaryType()))])
    return written(src.mapInArrow(run, schema), "recipes")


def _chunks(rec: DataFrame) -> DataFrame:
    """Every chunk occurrence: ``rid, pos, digest, bytes``."""
    flat = rec.select("rid", F.col("text").cast("binary").alias("raw"), "ends", "recipe")
    flat = flat.select("rid", "raw", "ends", F.posexplode("recipe").alias("pos", "digest"))
    begin = F.when(F.col("pos") == 0, F.lit(0)).otherwise(F.element_at("ends", F.greatest(F.col("pos"), F.lit(1))))
    end = F.element_at("ends", F.col("pos") + 1)
    return flat.select("rid", "pos", "digest", F.col("raw").substr(begin + 1, end - begin).alias("bytes"))


def verified(rec: DataFrame) -> DataFrame:
    """Recipes whose identifiers are verified: equal identifiers mean equal bytes.

    Chunk contents are deduplicated map-side, then once per content.  A digest
    with one content is its identifier.  Where a digest has several (never seen
    with 32 bytes), the identifier is the digest and the content's rank in it.
    """
    contents = _chunks(rec).groupBy("digest", "bytes").agg(F.lit(1).alias("one"))
    clashing = written(contents.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "clash")
    plain = rec.drop("text", "ends")
    if clashing.isEmpty():
        return plain
    hit = _chunks(rec).join(clashing, "digest", "left_semi")
    ranked = (hit.select("digest", "bytes").distinct()
              .groupBy("digest").agg(F.sort_array(F.collect_list("bytes")).alias("all")))  # contents of one digest
    named = hit.join(ranked, "digest").select(
        "rid", "pos", F.concat("digest", F.array_position("all", F.col("bytes")).cast("string").cast("binary")).alias("ident"))
    fixed = named.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("pos", "ident"))).alias("fixed"))
    swap = F.transform("recipe", lambda x, i: F.coalesce(F.try_element_at(F.col("fixed"), i), x))
    return written(plain.join(fixed, "rid", "left").withColumn(
        "recipe", F.when(F.col("fixed").isNull(), F.col("recipe")).otherwise(swap)).drop("fixed"), "idents")


def groups(rec: DataFrame) -> DataFrame:
    """One row per distinct recipe: ``recipe, keep_id, keep_rid, group_size``.

    Partial aggregates collapse a group of copies in each map task.
    """
    best = F.max(F.struct("id", "rid"))
    g = rec.groupBy("recipe").agg(best.alias("best"), F.count("*").alias("group_size"))
    return g.select("recipe", F.col("best.id").alias("keep_id"), F.col("best.rid").alias("keep_rid"), "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32) -> DataFrame:
    """Per input row: ``doc_id, keep_id, group_size, kept, text_sha256``; see the module for defined results."""
    rec = verified(recipes(docs, id_col, text_col, digest_bytes=digest_bytes))
    g = written(groups(rec), "recipe-groups")  # a table of its own, so that AQE can split a hot recipe's rows
    return rec.join(g, "recipe").select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rec = recipes(docs, id_col, text_col, keep_row=True)
    kept = written(groups(verified(rec)).select(F.col("keep_rid").alias("rid")), "kept-rows")
    return rec.select("rid", "row").join(kept, "rid", "left_semi").select("row.*")
