"""Session and shared-folder helpers.

Intermediate layers are written to the shared folder the cluster names in
``spark.checkpoint.dir``; only when that is unset (local tests) is a folder created.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# An action's shuffle files go when it ends; else they stay until the driver happens to collect its garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "monthlake",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and benches; a cluster job passes its own session instead."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint dir);
    set a local one only when neither is configured and Spark itself runs in this process
    (tests); on a cluster a missing shared folder is an error. A session that does not say
    what becomes of finished actions' shuffle files gets them removed (``FILE_CLEANUP``).
    """
    if spark.conf.get(FILE_CLEANUP, None) is None:
        spark.conf.set(FILE_CLEANUP, "true")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[", 1)[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="monthlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder for one run of one job."""
    return f"{shared_root(spark)}/monthlake/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``scratch_path`` that no later step reads."""
    if not path.startswith(f"{shared_root(spark)}/monthlake/"):
        raise ValueError(f"not a scratch folder: {path}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
