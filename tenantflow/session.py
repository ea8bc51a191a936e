"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings the plans are written for. All are plain SQL settings, so
#: they can be applied to a session that already exists.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}

_local_fallback: dict[str, str] = {}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; keyword arguments use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in RUNTIME_SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Where the setting is absent, a local master gets a temporary folder and a
    cluster gets an error: a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if "path" not in _local_fallback:
        _local_fallback["path"] = tempfile.mkdtemp(prefix="tenantflow-")
    return _local_fallback["path"]


def new_location(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/tenantflow/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage and fixes the rows, so that several consumers of one remote
    read all see the same snapshot, also after executors are lost.
    """
    return staged_at(df, new_location(df.sparkSession, label))


def staged_at(df: DataFrame, path: str) -> DataFrame:
    """:func:`staged` at a known path, for a caller that removes it after use."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a whole write to ``path`` has come to its end."""
    return path_exists(spark, f"{path}/_SUCCESS")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
