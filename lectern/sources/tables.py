"""Parquet tables by name, rows dealt to as many tasks as their tables ask for, and columns computed once."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a table's files for each task that what is made of it is dealt to.
PART_BYTES = 3 << 20


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def n_parts(made_of: DataFrame, part_bytes: int = PART_BYTES) -> int:
    """Number of tasks that grows with the files of made_of, so that none gets more when there is more; no less than there are cores."""
    size = int(str(made_of._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(size // part_bytes + 1, made_of.sparkSession.sparkContext.defaultParallelism)


def dealt(df: DataFrame, by: list[str], made_of: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """df in n_parts(made_of) partitions by columns; windows and aggregates by these and more columns stay within them."""
    return df.repartition(n_parts(made_of, part_bytes), *by)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once for a row. Spark moves filters below projections and computes there, for each use anew, what they
    ask for; below a generator it moves nothing that the generator makes."""
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("__once")
    return df.select("*", made).select("*", *[F.col(f"__once.{n}").alias(n) for n in columns]).drop("__once")
