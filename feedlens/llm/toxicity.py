"""Toxicity by a character n-gram linear classifier on naive Bayes log-count ratios.

Features are the distinct character n-grams of a lower-cased text, hashed.
Each is scaled by its naive Bayes log-count ratio between toxic and other
training texts; a logistic regression on the scaled features gives the score.
The ratios are counted over every labelled training text.  The regression is
fitted on at most FIT_ROWS of them (those with the smallest md5 of id and text),
in one task; its size doesn't depend on the corpus.

Defined results: a null or empty text has no features and gets the score of the
bias alone; rows with a null label or no labelled text aren't learned from; an
id's repeated labels count once, and an id with both labels isn't learned from;
without labels of both kinds every score is the share of toxic labels (0 for
none); an empty table gives an empty result; repeated rows score alike;
n-grams cover whole texts of any length; other columns may have any name.
"""
from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_batches, bounded_batches, text_bytes, written

NGRAMS = (3, 4, 5)
BITS = 18
FIT_ROWS = 6000
LEAST_TEXTS, LEAST_RATIO = 4, 1.0   # features rarer or weaker than these have weight 0
PENALTY, STEPS = 1e-3, 300
_P = np.uint64(0x9E3779B97F4A7C15)


def features(raw: bytes | None, seen: np.ndarray) -> np.ndarray:
    """Sorted distinct feature numbers; ``seen`` is a cleared boolean scratch array of 2^BITS."""
    if not raw:
        return np.empty(0, dtype=np.int64)
    c = np.frombuffer(raw.decode("utf-8").lower().encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    c = np.concatenate(([np.uint64(32)], c, [np.uint64(32)])) * np.uint64(0xBF58476D1CE4E5B9)
    h = c
    for n in range(2, max(NGRAMS) + 1):
        if len(c) < n:
            break
        h = (h[:-1] ^ (h[:-1] >> np.uint64(31))) * _P + c[n - 1:]
        if n in NGRAMS:
            seen[((h ^ (h >> np.uint64(29))) * _P) >> np.uint64(64 - BITS)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def label_counts(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts of each label, and for each feature the texts of each label that have it, over all of ``train``."""
    out = pa.schema([("feature", pa.int32()), ("other", pa.int64()), ("toxic", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, seen = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64), np.zeros(1 << BITS, bool)
        for batch in batches:
            for y, raw in zip(batch.column(0).to_pylist(), text_bytes(batch, "text")):
                held[y, features(raw, seen)] += 1
                rows[y] += 1
        some = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[some, -1], pa.int32()), pa.array(np.r_[held[0, some], rows[0]]),
                                          pa.array(np.r_[held[1, some], rows[1]])], schema=out)

    # at most 2^BITS + 1 rows, whatever the corpus
    got = train.mapInArrow(count, "feature int, other bigint, toxic bigint").groupBy("feature").agg(
        F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toPandas()
    table, rows = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
    for label, name in enumerate(("other", "toxic")):
        some = got["feature"].to_numpy() >= 0
        table[label, got["feature"].to_numpy()[some]] = got[name].to_numpy()[some]
        rows[label] = got[name].to_numpy()[~some].sum()
    return rows, table


def log_count_ratios(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Scaled features: the log ratio of smoothed shares of texts, 0 for rare or weak features."""
    share = (table + 1.0) / (rows[:, None] + 2.0)
    r = np.log(share[1]) - np.log(share[0])
    r[(table.sum(axis=0) < LEAST_TEXTS) | (np.abs(r) < LEAST_RATIO)] = 0.0
    return r


def fit(texts: list[tuple[int, bytes | None]], r: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights (ratios included) and bias of the logistic regression, by gradient steps of Adam's form."""
    seen = np.zeros(1 << BITS, bool)
    rows = [(y, f[r[f] != 0]) for y, raw in texts for f in [features(raw, seen)]]
    y = np.array([x for x, _ in rows], dtype=float)
    cols = np.concatenate([f for _, f in rows]) if rows else np.empty(0, np.int64)
    used, cols = np.unique(cols, return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(f) for _, f in rows])
    x = r[used][cols]
    bias = float(np.log(prior / (1 - prior)))
    w = np.zeros(len(used))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = np.bincount(owner, w[cols] * x, minlength=len(rows)) + bias
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / max(1, len(rows))
        g = np.bincount(cols, d[owner] * x, minlength=len(w)) + PENALTY * w / max(1, len(rows)) * 10
        gb = d.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        size = 0.02 * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        w -= size * m / (np.sqrt(v) + 1e-8)
        bias -= size * mb / (np.sqrt(vb) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[used] = w * r[used]
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          fit_rows: int = FIT_ROWS) -> dict:
    """Learn from every row of ``docs`` that ``labels`` marks 0 or 1: ``{"weights": ..., "bias": ...}``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    y = F.col(label_col).cast("int")
    marked = (labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.min(y).alias("y"), F.max(y).alias("most"))
              .where("y = most").select("id", "y"))
    # the one time that texts move, by the same join at every size
    rows = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(marked.hint("merge"), "id").select(
        "y", "text", F.md5(F.concat_ws(":", F.col("id").cast("string"), F.xxhash64("text")).cast("binary")).alias("turn")), "toxicity-rows")
    counts, table = label_counts(rows.select("y", "text"))
    if not counts.all():
        share = counts[1] / max(1, counts.sum())
        return {"weights": np.zeros(1 << BITS), "bias": float(np.log((share + 1e-12) / (1 - share + 1e-12)))}
    r = log_count_ratios(counts, table)
    prior = float(counts[1] / counts.sum())
    sent = spark.sparkContext.broadcast(r)  # 2^BITS numbers
    # numbers alone decide which texts are learned from; of rows alike in id and text any will do
    last = rows.select("turn").orderBy("turn").limit(fit_rows).agg(F.max("turn")).first()[0]
    sample = rows.where(F.col("turn") <= last).coalesce(1).sortWithinPartitions("turn", "y").limit(fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [x for batch in batches for x in zip(batch.column(0).to_pylist(), text_bytes(batch, "text"))]
        made = pa.schema([("model", pa.binary())])
        yield from as_batches([(pickle.dumps(fit(texts, sent.value, prior)),)], made)

    weights, bias = pickle.loads(bytes(sample.select("y", "text").mapInArrow(run, "model binary").first()[0]))
    return {"weights": weights, "bias": bias}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, score`` from the whole text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)  # 2^BITS numbers
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, seen = sent.value["weights"], sent.value["bias"], np.zeros(1 << BITS, bool)
        for batch in batches:
            z = [float(weights[features(raw, seen)].sum()) + bias for raw in text_bytes(batch, "text")]
            p = 1 / (1 + np.exp(-np.clip(np.array(z, dtype=float), -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=["doc_id", "score"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double")
