"""Session helper and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def local_session(app: str = "reviewlens", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench. On a cluster the session comes from spark-submit."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(_CHECKPOINT_CONF, tempfile.mkdtemp(prefix="reviewlens-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    configured = context.getConf().get(_CHECKPOINT_CONF) or spark.conf.get(_CHECKPOINT_CONF, None)
    configured = configured or context.getCheckpointDir()
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_CONF} to a folder shared by all executors")
    folder = _local_folders.get(context.applicationId)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="reviewlens-")
        _local_folders[context.applicationId] = folder
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else uses."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Used where several jobs read the same intermediate result. The table survives lost executors,
    cuts the lineage, and later reads get column pruning and true file sizes. Reads that filter on
    ``partition_by`` only open the folders they need.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Deletes what this application has staged. To be called once the results that read it are written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
