"""Tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only if it is unset on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="strataflow-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def stored(df: DataFrame, name: str, level: int = 3) -> DataFrame:
    """Write ``df`` once as Parquet, zstd of a ``level``, in the shared folder and return a reader of it.

    Lost executors then cost a re-read, not a recomputation. The files stay until ``discard`` is called
    for the table, which only its maker may do: a DataFrame derived from it may still read them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/strataflow/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = (path,)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``stored`` made and nothing reads any more; other DataFrames are left alone."""
    for table in tables:
        spark = table.sparkSession
        for path in getattr(table, "_stored_at", ()):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def settle(spark: SparkSession) -> None:
    """Have garbage collected, here and in the driver's JVM: shuffles, broadcasts and plans of finished steps go only then. What is free goes back to the system.

    For operators of many jobs, between their steps; a driver that is not pressed for memory would keep it all.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trim(spark)


def trim(spark: SparkSession) -> str:
    """Have the driver's JVM give back native memory that it has freed, as ``jcmd PID System.trim_native_heap`` does; what it says.

    Its compiler threads and libraries leave their arenas to the C library, which keeps what is freed, some more with each job.
    Empty, and nothing done, for a JVM without that command (before 17.0.9, or not on glibc).
    """
    jvm = spark.sparkContext._jvm
    # by reflection: the class of the server is not open to py4j, the interface is
    call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    args = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:
        return call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args) or ""
    except Py4JError:
        return ""
