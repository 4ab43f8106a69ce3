"""Generation that can be stopped at any time: a reply is stored under its prompt's key as it arrives.

The store is a folder that the driver and all executors share.  Each reply is
a file of its own, named by the hash of prompt and backend and moved into place
whole, so a task that is run again (or a second one beside it) finds what was
answered before and asks for the rest only; storing a reply twice leaves one.
``pack_replies`` joins the files into one Parquet table a version; the newest
version and the files stored since are the store.

Several requests of a task are in flight at once, and a task begins at most
``per_second`` of them a second.  Failures become ``[ERROR: ...]`` rows and are
not stored.
"""
from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

import pandas as pd
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .summarize import CACHE_SCHEMA, ask

_KEYED = "key string, " + CACHE_SCHEMA
_SCHEMES = {"s3a": "s3", "s3n": "s3"}  # names that Hadoop gives to stores which Arrow knows by another


def _files(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    return pafs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")


def reply_key(prompt_hash: str, backend_id: str | None) -> str:
    return hashlib.sha256(f"{prompt_hash}\n{backend_id or ''}".encode()).hexdigest()


class ReplyFiles:
    """The loose files of a store, as one task sees them."""

    def __init__(self, path: str):
        self.fs, folder = _files(path.rstrip("/"))
        self.folder = folder + "/loose"
        self.fs.create_dir(self.folder, recursive=True)

    def _at(self, key: str) -> str:
        return f"{self.folder}/{key[:2]}/{key}.json"

    def get(self, key: str) -> str | None:
        try:
            with self.fs.open_input_stream(self._at(key)) as f:
                return json.loads(f.read().decode())["response"]
        except FileNotFoundError:
            return None

    def put(self, key: str, row: dict) -> None:
        at = self._at(key)
        self.fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        part = f"{self.folder}/_{uuid.uuid4().hex}"  # Spark passes over names that begin so
        with self.fs.open_output_stream(part) as f:
            f.write(json.dumps({"key": key, **row}).encode())
        self.fs.move(part, at)


class Pace:
    """Lets at most ``per_second`` calls begin a second, from any thread."""

    def __init__(self, per_second: float | None):
        self.gap, self.next, self.lock = (1 / per_second if per_second else 0.0), 0.0, Lock()

    def wait(self) -> None:
        with self.lock:
            now = time.monotonic()
            at = max(now, self.next)
            self.next = at + self.gap
        time.sleep(max(0.0, at - now))


def _table(spark: SparkSession, read: Callable[[], DataFrame]) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _KEYED)


def _versions(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The newest packed table, and its number (0: none)."""
    rows = _table(spark, lambda: spark.read.schema(_KEYED + ", version bigint").parquet(f"{path.rstrip('/')}/packed"))
    if "version" not in rows.columns:
        return rows, 0
    newest = rows.agg(F.max("version")).first()[0] or 0
    return rows.where(F.col("version") == newest).drop("version"), newest


def read_replies(spark: SparkSession, path: str) -> DataFrame:
    """(key, prompt_hash, prompt, response, backend_id): one row a key."""
    packed, _ = _versions(spark, path)
    loose = _table(spark, lambda: spark.read.schema(_KEYED).option("recursiveFileLookup", "true").json(f"{path.rstrip('/')}/loose"))
    return packed.unionByName(loose.where("key is not null")).dropDuplicates(["key"])


def pack_replies(spark: SparkSession, path: str) -> int:
    """Write all replies as the next version; returns its number.  Files and versions before it stay until someone removes them."""
    _, newest = _versions(spark, path)
    read_replies(spark, path).write.mode("overwrite").parquet(f"{path.rstrip('/')}/packed/version={newest + 1}")
    return newest + 1


def generate_resumable(prompts: DataFrame, backend: Callable[[str], str], path: str, backend_id: str | None = None, batch_size: int = 5,
                       max_retries: int = 2, pause: float = 1.0, in_flight: int = 4, per_second: float | None = None) -> DataFrame:
    """``prompts`` (``topic, prompt_hash, prompt, ...``) + (response, ok, cached), asking only for what the store lacks."""
    spark = prompts.sparkSession
    key = F.sha2(F.concat(F.col("prompt_hash"), F.lit("\n" + (backend_id or ""))).cast("binary"), 256)
    known = read_replies(spark, path).select("key", F.col("response").alias("__known"))
    asked = prompts.withColumn("key", key).join(known, "key", "left")
    names = prompts.columns
    fields = [f"`{c}` {prompts.schema[c].dataType.simpleString()}" for c in names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, pace = ReplyFiles(path), Pace(per_second)

        def answer(key: str, digest: str, prompt: str, stored) -> tuple[str, bool, bool]:
            stored = files.get(key) if stored is None or stored != stored else stored
            if stored is not None:
                return stored, True, True
            pace.wait()
            text, ok = ask(backend, prompt, [pause] * max_retries)
            if ok:
                files.put(key, {"prompt_hash": digest, "prompt": prompt, "response": text, "backend_id": backend_id})
            return text, ok, False

        with ThreadPoolExecutor(in_flight) as pool:
            for rows in batches:
                got = list(pool.map(answer, rows["key"], rows["prompt_hash"], rows["prompt"], rows["__known"]))
                yield rows[names].assign(**{c: [x[i] for x in got] for i, c in enumerate(("response", "ok", "cached"))})

    n = prompts.select("topic").distinct().count()
    return asked.repartition(max(1, -(-n // max(1, batch_size))), "topic").mapInPandas(
        run, ", ".join([*fields, "response string, ok boolean, cached boolean"]))
