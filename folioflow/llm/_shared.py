"""Tables that several steps read: written to the shared folder of the cluster, so that lost executors cost nothing."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.  Where it is unset, a local session gets a new local one; a cluster has none to share."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def table(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """df, written as Parquet to the shared folder, partitioned by a column if one is named, and read again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame, part: str = "") -> None:
    """Delete a table (or a part of it, as kind=x) that nothing reads any more, and let Spark drop the shuffle files of finished jobs."""
    spark = df.sparkSession
    for path in {m[1] for f in df.inputFiles() if (m := re.match(r"(.*/[^/]+-[0-9a-f]{32})/", f))}:
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}")
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    for _ in range(2):  # the first makes what finished jobs held unreachable, the second lets its cleaner find it
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
