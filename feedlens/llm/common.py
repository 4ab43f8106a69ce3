"""Helpers shared by the operators: written tables, word rules, bounded Arrow batches."""
from __future__ import annotations

import os
import weakref
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_scratch, scratch_path, table  # noqa: F401  (table is re-exported for the queries)

#: A word: a run of characters other than ASCII white space.  ``bytes.split()``
#: without arguments cuts UTF-8 text at exactly these characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Rows of one Arrow batch that goes to Python.  Texts can be long, so the
#: default of 10,000 rows would be a batch of unknown size.
BATCH_ROWS = 512


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for long texts; a smaller session setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    The files outlive executors, and what follows starts from a plain scan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[id(back)] = (weakref.ref(back), path)
    return back


_paths: dict[int, tuple] = {}


def discard(*tables: DataFrame | None) -> None:
    """Remove the files of tables that came from ``written`` and that nothing reads any more."""
    for t in tables:
        ref, path = _paths.pop(id(t), (None, None))
        if ref is not None and ref() is t:
            drop_scratch(t.sparkSession, [path])


def text_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, null where it is null."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def word_count(text) -> F.Column:
    """Number of words of a text column; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def crc32_remainder(col, m: int) -> F.Column:
    """crc32 of the id as decimal text, modulo ``m``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(m))


def as_batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One Arrow batch from row tuples, nothing for no rows."""
    if rows:
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; the operators take any path instead."""
    import public_tokenizers
    return os.fspath(public_tokenizers.path(name))
