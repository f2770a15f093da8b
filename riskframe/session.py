"""Session construction and the lineage-cut helpers.

On a cluster the session comes from the platform; ``get_session`` only fills in settings
that are not set yet.  Checkpoints go to the shared folder named by ``spark.checkpoint.dir``;
a fallback folder is used only when that setting is absent (tests, local runs).
"""
from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "riskframe",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", "8g")
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the reliable checkpoint folder, registering it with the SparkContext.

    The cluster's ``spark.checkpoint.dir`` wins.  ``fallback`` is used only when that is
    unset (tests); without either this raises instead of using a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    path = configured or fallback
    if not path:
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared fallback folder")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (survives executor loss); requires ``checkpoint_dir`` first."""
    return df.checkpoint(eager=eager)


def keep(df: DataFrame) -> DataFrame:
    """Persist a frame that several jobs reuse (spills to disk instead of recomputing)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def reuse(df: DataFrame) -> DataFrame:
    """Persist an input that the caller's plan reads more than once (no-op if already
    persisted): the upstream joins and aggregations then run once, not once per read."""
    if not df.storageLevel.useMemory and not df.storageLevel.useDisk:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df
