"""Reading a part of a table: the newest partition by its folder's name, one id by its bucket."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quaystone.session import file_system

_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a partitioned table's first partition column, from the folder names alone, in order; NULL is left out."""
    fs, new_path = file_system(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(new_path(path)) if f.isDirectory()]
    values = [n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}=")]
    return sorted(unquote(v) for v in values if v != _NO_VALUE)


def read_newest_partition(spark: SparkSession, path: str, column: str, schema: StructType | str) -> DataFrame:
    """The rows of the greatest partition value (S11): the folders are listed, then one partition is scanned.
    ``schema`` is the table's, with the partition column as text; a table without partitions is an error."""
    values = partition_values(spark, path, column)
    if not values:
        raise ValueError(f"no {column} partitions in {path}")
    return spark.read.schema(schema).parquet(path).where(F.col(column) == F.lit(values[-1]))


def save_by_id(df: DataFrame, name: str, path: str, id_col: str, buckets: int) -> DataFrame:
    """Write a table bucketed and sorted by its id, so that a filter on one id reads one bucket (S13); returns the table."""
    # one task a bucket and bucket files: without it every task would write a file for every bucket
    dealt = df.repartition(buckets, id_col)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, id_col).sortBy(id_col).saveAsTable(name)
    return df.sparkSession.table(name)
