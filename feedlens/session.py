"""Session and storage helpers."""
from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_spark(master: str | None = None, app: str = "feedlens", partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; the
    shuffle-partition count then stays as the cluster sets it, unless
    ``partitions`` is given (about 128-256 MB of shuffle per partition).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the whole cluster
            b = b.config("spark.driver.memory", os.environ.get("FEEDLENS_DRIVER_MEMORY", "8g"))
            b = b.config("spark.feedlens.spread", str(partitions or os.cpu_count() or 8))
    if partitions or (master or "").startswith("local"):
        b = b.config("spark.sql.shuffle.partitions", str(partitions or os.cpu_count() or 8))
    b = (
        b.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only on a local master with nothing
    configured (tests) do we pick a folder of our own; elsewhere a machine-local
    folder would hold a part of each table, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = os.path.join("/tmp", "feedlens-checkpoints")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/feedlens-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the tables that the block writes to the checkpoint folder when it ends.

    For callers that have used up their results by then: DataFrames made in the
    block read those tables.
    """
    first = len(_SCRATCH)
    try:
        yield
    finally:
        drop_scratch(spark, _SCRATCH[first:])


@contextmanager
def scratch_but_last(spark: SparkSession):
    """As ``scratch_scope``, but the table written last stays."""
    first = len(_SCRATCH)
    yield
    drop_scratch(spark, _SCRATCH[first:-1])


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables that were written under ``scratch_path`` and are read no more."""
    sc = spark.sparkContext
    for path in paths:
        place = sc._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)
        if path in _SCRATCH:
            _SCRATCH.remove(path)


class ScratchOfSteps:
    """Scratch tables of the last of a row of steps, each of whose results is stored before the next begins.

    ``with steps.next(spark): ...`` removes what the step before left.
    """

    def __init__(self) -> None:
        self._left: list[str] = []

    @contextmanager
    def next(self, spark: SparkSession):
        drop_scratch(spark, self._left)
        first = len(_SCRATCH)
        try:
            yield
        finally:
            self._left = _SCRATCH[first:]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and
    continue from a plain scan of it.

    Survives executor loss (the files are on shared storage) and truly ends the
    plan: a ``checkpoint()`` result still carries its origin plan as metadata,
    and loops whose rounds reference the previous round more than once grow
    that metadata exponentially.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per Spark application.

    Python functions are pickled by module name, so workers must be able to
    import the package wherever they run.
    """
    sc = spark.sparkContext
    if getattr(sc, "_feedlens_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="feedlens-modules-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # Spark serves the file while it runs
    path = os.path.join(folder, "feedlens_modules.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for where, _, names in sorted(os.walk(top)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(where, name)
                z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._feedlens_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan round robin to ``spark.feedlens.spread`` partitions; as it is where that isn't set.

    For inputs of one split on one machine, which would otherwise run every
    expression in one task; ``get_spark`` sets it for local masters only.
    """
    parts = df.sparkSession.conf.get("spark.feedlens.spread", None)
    return df.repartition(int(parts)) if parts else df
