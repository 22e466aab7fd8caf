"""Lineage cuts that survive lost executors.

Everything goes to the folder the cluster names in ``spark.checkpoint.dir``, which driver and executors share.
Only where that is unset and the master is local (tests, a laptop) a folder of our own is used; a cluster without one is an error.
"""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; sets a local one if, and only if, the session names none and runs on this machine alone."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="loomgraph-checkpoint-"))
    spark.sparkContext.setCheckpointDir(_own[0])
    return _own[0]


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: the rows are written once and the plan above reads them."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: compressed, and later reads prune columns.

    Where lazily read results depend on it, the folder is left to the cluster's retention of its checkpoint directory;
    what nothing reads any more goes by :func:`discard`.
    """
    spark = df.sparkSession
    path = folder(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes the files of stored tables that no plan will read again; other tables are left alone."""
    for df in tables:
        if path := getattr(df, "_stored_at", None):
            context = df.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Frees the shuffle files and checkpoints of plans that nothing refers to any more. Spark does so only when the
    driver happens to collect its garbage, which in a long chain of small jobs may be never."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trimmed(spark)


def trimmed(spark: SparkSession) -> str | None:
    """Has the driver's JVM return freed native memory to the system: its C library keeps that of each of the hundreds of
    threads that exchanges start. What the JVM says of it; None where it cannot (other C libraries, older releases)."""
    context = spark.sparkContext
    jvm, new = context._jvm, context._gateway.new_array
    call = new(jvm.Object, 4)
    call[0], call[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    call[2], call[3] = new(jvm.Object, 0), new(jvm.String, 0)
    try:  # by the interface: the server's class is not exported
        (invoke,) = (m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        return invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), call)
    except Py4JError:
        return None


#: Least bytes that a task of a chain of small jobs is given, so that its tables are few files.
CHAIN_BYTES = 32 << 20


@contextlib.contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when the query has ended. Chains of jobs that cut their lineage by tables and
    checkpoints never read them again; where a plan is run a second time, Spark computes them anew. Adaptive partitions
    hold ``CHAIN_BYTES`` or more. Descriptions of plans are short: the driver makes one for every change of every plan."""
    parsed = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    advised = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", advised: str(max(CHAIN_BYTES, parsed(spark.conf.get(advised)))), "spark.sql.ui.explainMode": "simple", "spark.sql.maxPlanStringLength": "4096"}
    was = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in was.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
