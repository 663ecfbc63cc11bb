"""Session helpers: a local session for tests/bench and the shared scratch folder.

Operators never create or stop a session.  Lineage cuts and scratch tables go
to the folder the cluster names in ``spark.checkpoint.dir``; only when that is
unset *and* Spark runs in local mode (tests, bench) a private folder is made.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vidgraph") -> SparkSession:
    """Session for tests and the bench: local mode, AQE on, no web UI."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("VIDGRAPH_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _conf_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        return spark.conf.get("spark.checkpoint.dir", None) or None
    except Exception:  # noqa: BLE001 - key not readable in this session
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Uses ``spark.checkpoint.dir`` when the cluster names one; a local-mode
    session without it gets a fresh folder under /tmp.  A cluster session
    without it is an error: a machine-local folder would not survive the loss
    of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: the server owns the folder
        configured = _conf_checkpoint_dir(spark)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or _conf_checkpoint_dir(spark)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder (e.g. on HDFS/S3) for lineage cuts"
            )
        configured = tempfile.mkdtemp(prefix="vidgraph-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop path of ``path`` and its file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path`` (0 where there is none)."""
    hadoop, fs = hadoop_path(spark, path)
    return int(fs.getContentSummary(hadoop).getLength()) if fs.exists(hadoop) else 0


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    if "/scratch/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    hadoop, fs = hadoop_path(spark, path)
    fs.delete(hadoop, True)
