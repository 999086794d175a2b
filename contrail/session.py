"""Session helpers: a UTC, AQE-enabled session and the shared work folder.

Everything the library writes outside a user-named table (checkpoints,
staging tables, round-trip scratch data) goes below the folder the cluster
names in ``spark.checkpoint.dir``. Only when that setting is empty and Spark
runs in local mode (tests, benchmarks) do we create one under the system
temp folder; on a cluster an unset checkpoint dir is an error, because a
machine-local folder does not survive the loss of an executor.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "contrail") -> SparkSession:
    """Session used by tests and the benchmark (never by library code)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a folder on shared storage")
    local = tempfile.mkdtemp(prefix="contrail-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the shared checkpoint folder for staging tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "contrail", *parts, uuid.uuid4().hex)


def stage(df: DataFrame, folder: str, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written to ``<folder>/<name>`` as parquet (compressed by ``codec``, or as the session does) and read back.

    For whole tables of wide rows: a checkpoint stores them uncompressed and
    every reader reads all columns. ``folder`` is one of :func:`work_path`,
    which the caller drops when done.
    """
    path = os.path.join(folder, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a staging folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df: DataFrame, max_partitions: int | None = None) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor loss).

    ``max_partitions`` narrows a result with a known small bound (a work
    set, a dimension) so it is not stored as hundreds of near-empty files.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if max_partitions is not None:
        # An exchange, not coalesce(): what is above keeps its own parallelism.
        df = df.repartition(max_partitions)
    return df.checkpoint(eager=True)
