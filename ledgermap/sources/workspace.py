"""A shared folder for tables written between two steps of one job.

It is the one that ``spark.checkpoint.dir`` names, so that any executor can read it and a lost
executor costs nothing. There is no other: a session without the setting is refused.
"""

from __future__ import annotations

from math import ceil
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get(SETTING, None)
    if not configured:
        raise RuntimeError(f"set {SETTING} to a folder that driver and executors share")
    return f"{configured.rstrip('/')}/ledgermap-{spark.sparkContext.applicationId}"


WORK, LANDED = "work", "landed"


def stage(df: DataFrame, label: str, area: str = WORK) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a frame is read more than once and recomputing it would repeat its joins, or where
    a value that depends on physical placement must be frozen. The copy has exact size
    statistics, so the planner can tell a small side from a large one.
    """
    path = f"{shared_root(df.sparkSession)}/{area}/{label}-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS_PER_TASK = 500_000


def tasks_for(table: DataFrame) -> int | None:
    """How many tasks a stored table should be dealt over, if that is more than a shuffle makes anyway.

    The session's number of shuffle partitions stays the same however many rows there are; what one
    task sorts would grow with them. Counting a stored table reads no column.
    """
    wanted = ceil(table.count() / ROWS_PER_TASK)
    return wanted if wanted > int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def clear(spark: SparkSession, area: str = WORK) -> None:
    """Delete what ``stage`` wrote in this application; call it when its results have been used."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/{area}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
