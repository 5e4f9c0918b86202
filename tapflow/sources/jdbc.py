"""JDBC station tables (S2) and the JDBC -> table load.

Connection settings (URL, user, password, driver) always come from the
caller; nothing is stored here.  Without ``partitionColumn`` Spark reads a
JDBC table in one task, which is right for station tables (hundreds of rows);
for a large table pass ``partition_column``/``lower_bound``/``upper_bound``/
``num_partitions`` and the scan is split into range queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapflow.sources.tables import read_table, write_table


def read_jdbc(spark: SparkSession, options: dict[str, str],
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """Scan a JDBC table from an option map (``url``, ``dbtable``, ...)."""
    reader = spark.read.format("jdbc").options(**options).option("fetchsize", fetch_size)
    if partition_column:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partition column needs bounds and a partition count")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions))
    return reader.load()


def load_jdbc_to_table(spark: SparkSession, options: dict[str, str], table: str,
                       db: str | None = None, table_path: str | None = None,
                       **partitioning) -> DataFrame:
    """S9 (X3, X4): copy a JDBC table into an unpartitioned catalog table."""
    write_table(read_jdbc(spark, options, **partitioning), table, db=db, path=table_path)
    return read_table(spark, table, db)
