"""Session construction and the shared scratch folder."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on; ``conf`` overrides any of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    }
    for name, value in {**settings, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """This session's folder inside the one that all executors share, as the cluster names it.

    Without ``spark.checkpoint.dir`` a local session uses its warehouse folder; any other is refused, as
    executors would each write to a disk of their own. The folder is removed when the driver ends.
    """
    own = spark.conf.get("spark.tidemark.scratch", None)
    if own:
        return own
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    own = f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    spark.conf.set("spark.tidemark.scratch", own)
    atexit.register(_remove, spark, own)
    return own


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder with the session's own file system settings; one that is not there is no error."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        remove_folder(spark, folder)
    except Exception:  # noqa: BLE001  the JVM may be gone already
        return


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` a folder if the cluster has not set one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(spark))
