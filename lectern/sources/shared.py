"""Tables written once to the folder that all machines share, to end lineages and survive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, as in tests, a folder in the warehouse, which all machines share too."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/lectern-shared"


def stash(df: DataFrame, name: str, by: tuple[str, ...] = (), onto: DataFrame | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: what is lost later costs no recomputation. by: columns of which each value gets a folder,
    so that a filter on them reads no other files. onto: a stash that gets the rows too; what is returned has all of them."""
    spark = df.sparkSession
    path = onto._stashed_at if onto is not None else f"{shared_dir(spark)}/lectern-{name}-{uuid.uuid4().hex}"
    df.write.mode("append" if onto is not None else "error").partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stashed_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete stashes of which nothing is read any more: what was made of them is stashed itself."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stashed_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
