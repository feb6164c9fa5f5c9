"""Cut the lineage of long or iterative jobs through reliable, shared storage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where nobody names one, a local session (tests, notebooks) uses a folder inside the SQL warehouse; on a cluster that may be a folder of one machine, so it
    is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that every executor reaches")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_soundlake"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/soundlake-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` once and read it back.

    Later steps that use it more than once do not repeat the work behind it, losing executors never
    replays earlier rounds, readers prune columns, and the planner knows the true size.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete tables made by :func:`cut` that nothing reads any more; on whatever file system they lie."""
    for df in tables:
        spark = df.sparkSession
        for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/soundlake-" not in parent:
                raise ValueError(f"{parent} was not made by cut()")
            path = spark._jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
