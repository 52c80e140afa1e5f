"""Reading and writing the core tables as date-partitioned Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auricle import schemas
from auricle.clock import PARTITION_DATE


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A core table with its fixed schema; nothing is inferred from the files.

    The partition day stays in the frame, so time windows prune whole folders.
    """
    schema = schemas.TABLES[name]
    if "created_at" in schema:
        schema = f"{schema.rstrip()}, {PARTITION_DATE} DATE"
    return spark.read.schema(schema).parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    name: str,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    column: str = "id",
    **options: str,
) -> DataFrame:
    """The same table from a database; filters and columns are pushed into the query there.

    With `bounds` of a numeric column the table is read by ranges in parallel.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
    if bounds is not None:
        reader = reader.options(
            partitionColumn=column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=partitions,
        )
    return reader.load()


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    order: str = "id",
    partitions: int | None = None,
) -> None:
    """Write one folder per day. `partitions` defaults to spark.sql.shuffle.partitions.

    Rows are range-partitioned by (day, key): a busy day is split over many tasks, each task
    writes few folders, and the files carry narrow key ranges that scans can skip.
    """
    dated = df.withColumn(PARTITION_DATE, F.to_date("created_at"))
    width = [partitions] if partitions else []
    (
        dated.repartitionByRange(*width, PARTITION_DATE, order)
        .sortWithinPartitions(PARTITION_DATE, order)
        .write.mode(mode)
        .partitionBy(PARTITION_DATE)
        .parquet(path)
    )
