"""Streaming topic assignment and windowed counts.

Assignment is stateless per micro-batch: every batch is cleaned, encoded
with the model's vocabulary and matched to the model's centroids inside
``foreachBatch`` (the same batch operators, so the stream equals the batch
result).  Weekly counts use an event-time watermark and tumbling windows;
rows later than the watermark are dropped by Spark.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..operators.embed import encode_hashed
from ..operators.text import DEFAULT_STOPWORDS, remove_stopwords_col
from ..operators.trends import assign_topics


def assign_batch(batch: DataFrame, centroids: DataFrame, vocab: DataFrame, dim: int, min_sim: float,
                 id_cols: list[str], text_col: str = "text") -> DataFrame:
    # the id columns themselves are the key; each text is one row of the batch
    keyed = batch.select(F.struct(*id_cols).alias("__id"), text_col)
    docs = keyed.select("__id", remove_stopwords_col(clean_text(text_col), DEFAULT_STOPWORDS, True).alias("clean"))
    vecs = encode_hashed(docs, dim, id_col="__id", vocab=vocab)
    a = assign_topics(vecs, centroids, dim, min_sim, id_col="__id")
    return a.select(*[F.col("__id")[c].alias(c) for c in id_cols], "topic", "sim")


def assign_topics_stream(stream: DataFrame, centroids: DataFrame, vocab: DataFrame, dim: int, out_path: str,
                         checkpoint: str, min_sim: float = 0.0, id_cols: list[str] | None = None,
                         available_now: bool = True, text_col: str = "text"):
    """Start the streaming assignment; each batch is a folder ``batch_id=<n>`` of Parquet at ``out_path``.

    A batch that is run again after a failure overwrites its own folder, so
    every row is there once.
    ``checkpoint`` must be a folder on shared storage (the session's
    ``spark.checkpoint.dir`` is the natural parent) so a restarted query
    resumes exactly where it stopped.
    """
    ids = id_cols or ["doc_id"]

    def sink(batch: DataFrame, epoch: int) -> None:
        assign_batch(batch, centroids, vocab, dim, min_sim, ids, text_col).write.mode("overwrite").parquet(
            f"{out_path.rstrip('/')}/batch_id={epoch}")

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def weekly_counts_stream(stream: DataFrame, ts_col: str = "ts", key: str = "topic", watermark: str = "14 days"):
    """Streaming weekly counts per key with a watermark (append mode emits closed weeks)."""
    return (stream.withWatermark(ts_col, watermark)
                  .groupBy(key, F.window(ts_col, "7 days", startTime="4 days").alias("w"))
                  .agg(F.count(F.lit(1)).alias("count"))
                  .select(key, F.col("w.start").alias("period"), "count"))
