"""Session defaults and the shared folder for tables that are read several times."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile larger methods, so wide curation projections are better split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def get_session(app_name: str = "surestar", master: str | None = None, **extra: str) -> SparkSession:
    """Build (or reuse) a session with the defaults this package is tested with."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors can read and write.

    It lies in ``spark.checkpoint.dir``. Without that setting it lies beside the tables in the warehouse. On a cluster a
    warehouse folder on local disks (the default) is refused, since each executor would write to its own, unless
    ``spark.surestar.sharedWarehouse`` is ``true``, which says that it is mounted everywhere.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
        local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
        mounted = spark.conf.get("spark.surestar.sharedWarehouse", "false") == "true"
        if not (local or mounted) and _on_local_disk(spark, base):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; {base} is on the disks of each machine")
    return f"{base.rstrip('/')}/surestar-{uuid.uuid4().hex}"


def _on_local_disk(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"


_scratch: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, what :func:`materialise` has written inside. No frame made inside may be used after it."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder once, for plans that read it several times."""
    path = shared_folder(df.sparkSession)
    if _scratch:
        _scratch[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
