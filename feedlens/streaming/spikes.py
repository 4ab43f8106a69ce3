"""Negative spikes as weeks close.

Weekly counts are Spark's own windowed aggregate (partial sums before the
shuffle, so a topic with a third of all events is one row a task); a week is
emitted once, when the watermark has passed it.  Each micro-batch joins its
closed weeks to the last ``k`` of every topic, which is all the state there is:
a table of at most ``k`` rows a topic, written as a folder a batch.  A batch
that is run again after a failure reads the folder of the batch before it and
overwrites its own, so a restart repeats nothing and loses nothing.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.trends import negative_spikes
from .assign import weekly_counts_stream

_STATE = "topic {topic}, period timestamp, count bigint"


def _last_state(spark: SparkSession, path: str, epoch: int, schema: str) -> DataFrame:
    """State after the newest batch before ``epoch``; empty before the first."""
    try:
        rows = spark.read.schema(schema + ", batch_id bigint").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    last = rows.where(F.col("batch_id") < epoch)
    return last.where(F.col("batch_id") == last.agg(F.max("batch_id")).scalar()).drop("batch_id")


def negative_spikes_stream(stream: DataFrame, summaries: DataFrame, out_path: str, state_path: str, checkpoint: str,
                           factor: float = 2.0, k: int = 2, ts_col: str = "ts", watermark: str = "14 days", available_now: bool = True):
    """Start the query; each batch is a folder ``batch_id=<n>`` at ``out_path``: topic, period, count, trailing_mean, spike.

    ``stream`` has ``topic`` and ``ts_col``, ``summaries`` topic and sentiment.
    ``out_path``, ``state_path`` and ``checkpoint`` are folders on shared storage.
    A topic without a closed week in a batch keeps its state.
    """
    counts = weekly_counts_stream(stream, ts_col, "topic", watermark)
    schema = _STATE.format(topic=stream.schema["topic"].dataType.simpleString())

    def sink(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = _last_state(spark, state_path, epoch, schema)
        every = before.withColumn("fresh", F.lit(False)).unionByName(
            batch.select("topic", F.col("period").cast("timestamp").alias("period"), "count").withColumn("fresh", F.lit(True)))
        newest = Window.partitionBy("topic").orderBy(F.desc("period"))
        # the state first: a batch that stops between the two is run again and finds the state of the batch before it
        (every.withColumn("r", F.row_number().over(newest)).where(F.col("r") <= k).select("topic", "period", "count")
              .write.mode("overwrite").parquet(f"{state_path.rstrip('/')}/batch_id={epoch}"))
        found = negative_spikes(every.select("topic", "period", "count"), summaries, factor, k)
        (found.join(every.where("fresh").select("topic", "period"), ["topic", "period"], "left_semi")
              .write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={epoch}"))

    w = counts.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
