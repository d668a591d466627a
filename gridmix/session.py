"""SparkSession factory and cluster-safe scratch locations."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every gridmix job relies on. ANSI mode stays on so that bad casts and
# overflows fail loudly; the code guards every division itself (safe_ratio).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def get_session(
    app: str = "gridmix",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
) -> SparkSession:
    """Return (or create) a session configured for gridmix.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset and let the
    submit configuration decide; AQE coalesces small shuffle partitions at
    runtime and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate() may hand back an existing session: apply SQL settings anyway.
    for key, value in settings.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark


def session_key(spark: SparkSession) -> tuple:
    """Identity of a session for per-session memo tables: the application id
    changes when a context is stopped and a new one started, so entries made
    for a stopped session are never handed out again."""
    return (spark.sparkContext.applicationId, id(spark))


def scratch_dir(spark: SparkSession) -> str | None:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir``.

    In local mode an unset folder is replaced by a fresh one under the system
    temp folder (there is only one machine); on a cluster it must be set, and
    None is returned when it is not.
    """
    try:
        return ensure_checkpoint_dir(spark)
    except RuntimeError:
        if not spark.sparkContext.master.startswith("local"):
            return None
        import tempfile
        return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="gridmix-ckpt-"))


def ensure_checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Return the shared checkpoint folder of the cluster.

    The folder named in ``spark.checkpoint.dir`` wins. Only when it is unset
    (local runs, tests) is ``default`` installed; on a cluster that default must
    be a shared file system path, never a machine-local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if default is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no default was given")
    os.makedirs(default, exist_ok=True) if "://" not in default else None
    spark.sparkContext.setCheckpointDir(default)
    spark.conf.set("spark.checkpoint.dir", default)
    return default
