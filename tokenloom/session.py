"""Session helpers for tests and the bench (the library itself takes a session)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tokenloom") -> SparkSession:
    """Local session with the settings the library expects (UTC, AQE, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("tokenloom.spreadSmallScans", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TOKENLOOM_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    try:
        return spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - unset key
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured ``spark.checkpoint.dir``.  Only a single-process
    session (tests, bench) gets a fresh scratch folder where it is unset: on a
    cluster each executor would write its part to its own disk."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:  # already set (setCheckpointDir adds a fresh sub-folder per call)
        return current
    d = checkpoint_dir(spark)
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("stage tables need a folder that all executors share: set spark.checkpoint.dir")
        d = tempfile.mkdtemp(prefix="tokenloom-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def stage_path(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder for a materialised stage under the shared checkpoint
    folder (``spark.checkpoint.dir``)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tokenloom-stages/{name or 'stage'}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str | None = None, compression: str | None = None) -> DataFrame:
    """Materialise a stage as a parquet table in the shared checkpoint folder
    and read it back.

    Used where one stage output feeds several consumers (prepared corpus,
    vocabulary, offsets, block table) and by iterative jobs (BPE rounds,
    generation rounds) so their plans do not grow.  One job writes the table
    (an eager ``checkpoint()`` would compute the input twice), the write is
    committed atomically so a lost executor only retries its tasks, and the
    re-read gets column pruning and filter pushdown.  Never a local
    checkpoint: executor-local blocks are lost with the executor.

    ``compression``: of the files, where not the session's.
    """
    path = stage_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


def drop_stage(*tables: DataFrame) -> None:
    """Remove the files of stage tables (``cut_lineage``) that no plan reads any
    more.  A table that something lazy still reads must stay."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/tokenloom-stages/" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
