"""Shared scratch storage for results that several passes read."""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

_CONF = "spark.checkpoint.dir"
_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    Only a local-mode session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its executor.
    """
    base = spark.sparkContext.getConf().get(_CONF) or spark.conf.get(_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CONF} to a folder that all executors share")
        app = spark.sparkContext.applicationId
        base = _local.setdefault(app, "")
        if not base:
            base = _local[app] = tempfile.mkdtemp(prefix="saleswright-")
    return f"{base.rstrip('/')}/saleswright/{uuid.uuid4().hex}"


def freeing(df: DataFrame, settings: dict[str, str] | None = None) -> DataFrame:
    """The same frame, for one write: what the write shuffles is removed from the executors' disks as soon as it ends.

    Without that, shuffle files stay until the driver happens to collect its garbage, so that those of all passes of a
    query lie side by side. That setting, and any in ``settings``, is made in a copy of the session, so the session that was handed
    in keeps its own; where there is no such setting or copy, the frame is written as it is.
    """
    spark = df.sparkSession
    try:
        own = spark._jsparkSession.cloneSession()
        for key, value in {_FREES: "true", **(settings or {})}.items():
            own.conf().set(key, value)
        return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own, df._jdf.queryExecution().analyzed()), spark)
    except Exception as error:  # another Spark, or none on this side
        log.info("shuffle files are left to Spark's cleaner: %s", str(error).splitlines()[0])
        return df


def stage(df: DataFrame, label: str = "stage", settings: dict[str, str] | None = None) -> DataFrame:
    """Write once, read back: cuts the lineage and keeps column pruning.

    Later passes read only the columns they need and survive lost executors, where
    a cached or checkpointed row set would be read whole or be recomputed. ``settings`` hold for the write only.
    """
    path = f"{work_dir(df.sparkSession)}/{label}"
    freeing(df, settings).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Remove the files of a frame that ``stage`` returned, once nothing reads it any more."""
    spark = staged.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in staged.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
