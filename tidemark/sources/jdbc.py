"""JDBC read of a subquery and JDBC append.

Reads are split over ``num_partitions`` ranges of a numeric column so
the source is scanned in parallel (the reference used one connection).
Credentials come from the caller (e.g. the environment), never config
files in the repository.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, query: str, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None, num_partitions: int | None = None,
              properties: dict | None = None) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) AS q")
    if partition_column and num_partitions:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions)))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None,
               batch_size: int = 10000) -> None:
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", str(batch_size))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.mode(mode).save()
