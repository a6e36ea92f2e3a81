"""Session helpers: session construction, table access and lineage cuts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "lexigraft", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for (UTC, AQE on)."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str, schema=None) -> DataFrame:
    """One Parquet table of a data directory; ``schema`` narrows nested columns at the scan."""
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. A temporary one stands in for it under a local master only."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return shared or os.path.join(tempfile.gettempdir(), "lexigraft-checkpoints")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder, so that the result outlives any executor."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Cut lineage through a Parquet table in the shared folder: smaller than a checkpoint, read by column."""
    spark = df.sparkSession
    at = scratch(spark)
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def release(spark: SparkSession) -> None:
    """Let the driver drop what written tables were made from: its cleaner removes the shuffle files and broadcasts
    of plans that are garbage, and only a collection tells it so. Both processes of the driver then hand back the
    native memory that compilers, codecs and fits have freed, which the C library keeps for each thread apart
    (where it or the JVM can't, nothing is handed back). For operators of many stages."""
    gc.collect()  # plans that only Python still refers to
    jvm = spark.sparkContext._jvm
    jvm.System.gc()
    call = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
    call[0], call[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    # by reflection: the server's own class is not exported
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    with contextlib.suppress(Py4JJavaError):  # a JVM that has no such command
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), call)
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder that is removed when the driver ends."""
    at = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return at
