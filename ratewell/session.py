"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hash instead of sort-merge joins, once every build partition is measured to be this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int = 8, memory: str = "8g", shuffle_partitions: int | None = None) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("ratewell")
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder stands in only when the setting is absent and the session is
    local; on a cluster a missing setting is an error rather than a machine-local path.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not base:
        current = context.getCheckpointDir()
        if current:
            return current
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="ratewell-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so later plans start from stored rows.

    Needed where a value depends on physical placement (row numbers) or where a loop
    would otherwise grow the plan without bound.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def forget(df: DataFrame) -> None:
    """Delete the files of a frame from :func:`cut_lineage` that nothing will read again, as a loop leaves one behind per step."""
    context = df.sparkSession.sparkContext
    file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        path = context._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files that no frame can reach any more; it follows the driver's garbage collection."""
    spark.sparkContext._jvm.System.gc()
