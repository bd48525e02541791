"""Spark session helpers."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Defaults for a local session; a cluster passes its own settings through the builder.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.driver.memory": "8g",
}


def local_session(master: str = "local[8]", app: str = "labelcorpus", **conf: str) -> SparkSession:
    """Build (or reuse) a local session with AQE on and the UI off."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a scratch one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is; without it there
    is no folder that all executors see, so only a local master gets a scratch one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir is unset; {master} needs a folder that all executors share")
    path = os.environ.get("LABELCORPUS_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="lc-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


#: A job's shuffle files go when it has ended (else they stay until the driver collects garbage).
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Methods of more bytes are never compiled by the JVM, so operators that would be fused into one run one by one.
#: Rows that a window has sorted by food are aggregated in that order.
SMALL_METHODS = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.execution.replaceHashWithSortAgg": "true"}


@contextlib.contextmanager
def write_settings(spark: SparkSession, settings: dict[str, str]):
    """``settings`` hold in here."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def materialize(df, how: str = "table", wide: bool = False):
    """Cut a plan at a fan-out point.

    ``checkpoint`` writes the rows to the session's checkpoint folder (shared storage on a
    cluster) and returns a DataFrame whose lineage starts there: later jobs neither recompute
    nor re-optimise the upstream plan, and a lost executor costs a re-read, not a rebuild.
    ``table`` writes Parquet into the same folder and reads it back: the lineage cut of a
    checkpoint, plus columnar storage, so later jobs read only the columns they use.
    ``persist`` keeps them in executor memory/disk; ``none`` returns the input.
    ``wide`` is for projections of very many expressions (see ``SMALL_METHODS``).
    """
    from pyspark import StorageLevel
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        # An eager reliable checkpoint runs one job to count and another to write; keeping
        # the rows for the duration means the upstream plan is computed once, not twice.
        held = df.persist(StorageLevel.MEMORY_AND_DISK)
        out = held.checkpoint(eager=True)
        held.unpersist()
        return out
    if how == "table":
        import uuid
        folder = ensure_checkpoint_dir(df.sparkSession)
        path = f"{folder.rstrip('/')}/lc-table-{uuid.uuid4().hex}"
        with write_settings(df.sparkSession, {**DROP_SHUFFLES, **(SMALL_METHODS if wide else {})}):
            df.write.parquet(path)
        return df.sparkSession.read.parquet(path)
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df
