"""Session helpers: the test session, table loading, the scratch folder that cuts lineage, and making this package importable by Python workers."""

from __future__ import annotations

import atexit
import contextlib
import gc
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE_ROOT = str(Path(__file__).resolve().parent.parent)
_OWN: dict[str, str] = {}


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return share_package(spark)


def share_package(spark: SparkSession) -> SparkSession:
    """Put the folder of this package on the workers' PYTHONPATH (on a cluster it is installed or sent with --py-files)."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, paths)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A folder of this application below spark.checkpoint.dir, which all executors share.

    Only under a local master, where driver and executors are one process, a temporary folder stands in for a missing setting.
    """
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            base = tempfile.mkdtemp(prefix="corpusloom-")
        _OWN[app] = f"{base.rstrip('/')}/corpusloom/{app}"
        atexit.register(sweep, spark, _OWN[app])
    return _OWN[app]


def sweep(spark: SparkSession, path: str) -> None:
    """Delete a folder at the end of the application; a stopped session leaves it to the cluster's clean-up."""
    with contextlib.suppress(Exception):  # the JVM may be gone by now
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there, by Hadoop's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing for none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [str(f.getPath()) for f in store.listStatus(p)] if store.exists(p) else []


def quoted(name: str, ending: str = "") -> str:
    """A table's name, maybe with its database, quoted for SQL; `ending` is added to its last part."""
    *database, own = name.replace("`", "").split(".")
    return ".".join(f"`{x}`" for x in (*database, own + ending))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the scratch folder and read it back: lineage ends there, so that lost executors cost no recomputation, and
    what isn't the same on every run (order of rows, numbers of partitions) is settled once."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of what finished steps have left: plans that Python no longer holds, and, once the JVM has collected them, by Spark's cleaner
    their shuffle files and broadcasts on all executors. Spark itself does so every half an hour; a job of many steps does well to do so between them.
    Where the driver's JVM is out of reach (Spark Connect) only Python's part is done."""
    gc.collect()
    with contextlib.suppress(AttributeError, NotImplementedError):
        spark.sparkContext._jvm.System.gc()
