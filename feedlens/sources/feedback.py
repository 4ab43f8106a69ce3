"""Feedback sources: project any table to (doc_id, text); CSV reader; guards."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

# Cell contents pandas reads as missing by default (its
# ``na_values`` list); they become "".
PANDAS_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


class MissingColumnError(ValueError):
    pass


def _no_column(df: DataFrame, role: str, name: str) -> str:
    return f"the table has no {role} column {name!r}; it has {', '.join(df.columns) or 'no columns'}"


def to_feedback(df: DataFrame, text_column: str, id_column: str | None = None) -> DataFrame:
    """Check the text column exists, then project to (doc_id, text STRING, null -> "").

    Without ``id_column`` rows are numbered with ``monotonically_increasing_id``
    and written once, since that number changes with the input's splits; pass
    an id column where rows must keep their id between runs.
    """
    if text_column not in df.columns:
        raise MissingColumnError(_no_column(df, "text", text_column))
    text = F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    if id_column is None:
        return cut_lineage(df.select(F.monotonically_increasing_id().alias("doc_id"), text))
    if id_column not in df.columns:
        raise MissingColumnError(_no_column(df, "id", id_column))
    return df.select(F.col(id_column).cast("bigint").alias("doc_id"), text)


def read_feedback_csv(spark: SparkSession, path: str, text_column: str, id_column: str | None = None,
                      na_values=PANDAS_NA_VALUES, multi_line: bool = True) -> DataFrame:
    """CSV with a header row and quoted multi-line cells, all columns as strings.

    A file with line breaks inside cells is read by one task; ``multi_line=False``
    says that there are none, and files of any size are split over tasks.

    pandas-style missing markers become "" (pandas reads them as NaN, then the
    projection turns NaN into "").
    """
    raw = (spark.read.option("header", True).option("multiLine", multi_line)
           .option("quote", '"').option("escape", '"').option("inferSchema", False)
           .option("mode", "PERMISSIVE").csv(path))
    return to_feedback(na_to_null(raw, text_column, na_values), text_column, id_column)


def na_to_null(df: DataFrame, col: str, na_values=PANDAS_NA_VALUES) -> DataFrame:
    """Cells spelled like a pandas missing marker become null (then "")."""
    if col not in df.columns or not na_values:
        return df
    nas = F.array(*[F.lit(v) for v in na_values])
    return df.withColumn(col, F.when(F.array_contains(nas, F.col(col)), F.lit(None)).otherwise(F.col(col)))


class TooFewDocuments(ValueError):
    pass


def require_min_docs(df: DataFrame, n: int = 5) -> DataFrame:
    """Stop when fewer than ``n`` rows exist; reads at most ``n`` rows to decide."""
    have = df.limit(n).count()
    if have < n:
        raise TooFewDocuments(f"only {have} rows are left to analyse; {n} are required")
    return df


def load_feedback(spark: SparkSession, path: str, text_column: str, id_column: str | None = None) -> DataFrame:
    """Read a file or folder by its suffix: ``.csv``, ``.xlsx`` or ``.parquet``.

    Raises FileNotFoundError for a path without files and ValueError for any other suffix.
    """
    suffix = os.path.splitext(path.rstrip("/").lower())[1]
    if suffix not in (".csv", ".xlsx", ".parquet"):
        raise ValueError(f"can't read {path!r}: the suffix must be .csv, .xlsx or .parquet")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(conf).globStatus(place):
        raise FileNotFoundError(path)
    if suffix == ".csv":
        return read_feedback_csv(spark, path, text_column, id_column)
    if suffix == ".parquet":
        return to_feedback(spark.read.parquet(path), text_column, id_column)
    from .workbooks import read_feedback_workbooks
    return read_feedback_workbooks(spark, path, text_column, id_column=id_column)
