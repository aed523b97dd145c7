"""JDBC contract: connection options and partitioned or filtered reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Connection contract of the warehouse database.
PROPERTIES = {
    "driver": "org.postgresql.Driver",
    "connectTimeout": "10",
    "socketTimeout": "60",
    "tcpKeepAlive": "true",
    "reWriteBatchedInserts": "true",
}
SENSOR_BATCH = 5000
SMALL_BATCH = 500


def options(url: str, user: str, password: str, **extra: str) -> dict[str, str]:
    return {"url": url, "user": user, "password": password, **PROPERTIES, **extra}


def read_query(spark: SparkSession, query: str, opts: dict[str, str]) -> DataFrame:
    """Subquery scan: the database evaluates filter and projection."""
    return spark.read.format("jdbc").options(**opts).option("query", query).load()


def read_table(
    spark: SparkSession,
    table: str,
    opts: dict[str, str],
    split: tuple[str, int | str, int | str, int] | None = None,
) -> DataFrame:
    """Whole table; ``split`` = (column, lower, upper, tasks) reads ranges in parallel."""
    reader = spark.read.format("jdbc").options(**opts).option("dbtable", table)
    if split:
        column, low, high, tasks = split
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", low)
            .option("upperBound", high)
            .option("numPartitions", tasks)
        )
    return reader.load()


def append(df: DataFrame, table: str, opts: dict[str, str], batch: int = SENSOR_BATCH) -> None:
    df.write.format("jdbc").options(**opts).option("dbtable", table).option("batchsize", batch).mode(
        "append"
    ).save()


def replace_rows(df: DataFrame, table: str, opts: dict[str, str]) -> None:
    """Overwrite the rows and keep the table definition."""
    df.write.format("jdbc").options(**opts).option("dbtable", table).option("truncate", "true").mode(
        "overwrite"
    ).save()
