"""Tables: scan (S3), sinks (S4-S7).  A name with a slash is a Parquet path.

Tables are written as Parquet.  ``mode="overwrite"`` replaces the whole table,
also partitions absent from the new data (as the reference does);
``mode="partitions"`` replaces only the partitions that the new data holds, so a
day can be run again beside the others.  A partition column moves to the end of
the schema and stays a string.  Reading goes through the catalog, so
``trade_date`` keeps its declared type (no partition-value inference) and
filters on it prune partitions.

A partitioned write is clustered first: rows are rebalanced by the partition
column, so a task writes few partitions and a partition gets few files, where
each task would otherwise write one file per partition.  Adaptive execution cuts
a hot partition into several tasks of its advisory size and joins small ones, so
a day that holds a third of all rows is written by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION = "trade_date"


def qualified(db: str | None, table: str) -> str:
    """``db.table`` instead of a session-wide ``USE db``."""
    return f"{db}.{table}" if db else table


def is_path(name: str) -> bool:
    return "/" in name


def read_table(spark: SparkSession, table: str, db: str | None = None) -> DataFrame:
    """S3: scan a catalog table by (qualified) name, or a Parquet folder by path.

    A folder's partition column is read as text, as the catalog declares it
    (Spark would infer a number from the folder names)."""
    if not is_path(table):
        return spark.table(qualified(db, table))
    schema = spark.read.parquet(table).schema
    text = T.StructType([T.StructField(f.name, T.StringType() if f.name == PARTITION else f.dataType)
                         for f in schema])
    return spark.read.schema(text).parquet(table)


def register_parquet(spark: SparkSession, table: str, path: str, db: str | None = None) -> None:
    """Expose existing Parquet files as an external catalog table."""
    name = qualified(db, table)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")


def write_table(df: DataFrame, table: str, db: str | None = None,
                partition_by: str | None = None, path: str | None = None,
                mode: str = "overwrite", cluster: bool = True,
                sort_by: Sequence[str] = (), max_file_rows: int | None = None,
                bucket_by: str | None = None, buckets: int = 0) -> None:
    """Save ``df`` as a Parquet catalog table, or in the folder ``table``.

    ``partition_by`` names the optional partition column (S6).  ``path`` makes the
    table external, at a location on shared storage.  ``mode`` is ``overwrite``,
    ``partitions`` (replace only the partitions that ``df`` holds; a table that does
    not exist is made) or one of Spark's.  ``cluster`` rebalances a partitioned
    write; ``sort_by`` orders the rows of each file, ``max_file_rows`` bounds them.

    ``buckets`` > 0 makes a catalog table bucketed by ``bucket_by``: what groups,
    joins or windows by that column reads it without a shuffle.  A bucket is read by
    one task, so only a column without hot values will do.  ``cluster`` then deals
    the rows out by bucket, so that each bucket of a partition is one file; a caller
    whose rows are dealt out that way already passes False.
    """
    if mode == "partitions" and not partition_by:
        raise ValueError('mode="partitions" needs a partition column')
    if buckets and (not bucket_by or is_path(table) or mode != "overwrite"):
        raise ValueError("a bucketed table needs a bucket column, a catalog name and a whole write")
    if buckets and cluster:
        df = df.repartition(buckets, bucket_by)
    elif partition_by and cluster:
        df = df.hint("rebalance", partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *sort_by)
    name = table if is_path(table) else qualified(db, table)
    if mode == "partitions" and not is_path(table) and df.sparkSession.catalog.tableExists(name):
        _replace_partitions(df, name, partition_by, max_file_rows)
        return
    writer = _writer(df, partition_by, mode, max_file_rows)
    if buckets:
        writer = writer.bucketBy(buckets, bucket_by)
    if is_path(table):
        writer.save(table)
        return
    if path:
        writer = writer.option("path", path)
    if db:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    writer.saveAsTable(name)


def _writer(df: DataFrame, partition_by: str | None, mode: str, max_file_rows: int | None) -> DataFrameWriter:
    writer = df.write.format("parquet").mode("overwrite" if mode == "partitions" else mode)
    if mode == "partitions":  # an option of this write: the session's setting stays as it is
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_file_rows:
        writer = writer.option("maxRecordsPerFile", max_file_rows)
    return writer.partitionBy(partition_by) if partition_by else writer


def _described(spark: SparkSession, name: str, what: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == what).collect()
    return rows[0]["data_type"] if rows else None


def table_location(spark: SparkSession, name: str) -> str:
    return _described(spark, name, "Location")


def buckets_of(spark: SparkSession, table: str, column: str, db: str | None = None) -> int:
    """Buckets of a catalog table (or of the table that a plain view of all its columns
    names in its properties) that is bucketed by ``column``; 0 for any other."""
    if not is_path(table) and spark.catalog.getTable(qualified(db, table)).tableType == "VIEW":
        named = spark.sql(f"SHOW TBLPROPERTIES {qualified(db, table)}").where("key = 'tapflow.version'").collect()
        table = named[0]["value"] if named else table
    if is_path(table) or _described(spark, qualified(db, table), "Bucket Columns") != f"[`{column}`]":
        return 0
    return int(_described(spark, qualified(db, table), "Num Buckets"))


def _replace_partitions(df: DataFrame, name: str, partition_by: str, max_file_rows: int | None) -> None:
    """Partition-wise overwrite of an existing catalog table: its folder is written, and
    the catalog learns of partitions that are new."""
    spark = df.sparkSession
    have = spark.table(name)
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if parts != [partition_by]:
        raise ValueError(f"{name} is partitioned by {parts}, not by {partition_by}")
    if {(f.name, f.dataType) for f in have.schema} != {(f.name, f.dataType) for f in df.schema}:
        raise ValueError(f"{name} has other columns than the new rows")
    _writer(df.select(*have.columns), partition_by, "partitions", max_file_rows).save(table_location(spark, name))
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
