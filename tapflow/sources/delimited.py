"""Delimited tap files (S1) and the file -> table load.

The reader takes a fixed schema (no header, no inference) and parses
permissively: a bad timestamp becomes null, a short row gets nulls, extra
fields are dropped, quotes are honoured and an empty field is null, quoted or not.  Plain text files split into
``spark.sql.files.maxPartitionBytes`` chunks, so a large file is read by many
tasks; compressed files (gzip) cannot be split, so prefer many files or a
splittable codec for large loads.

``read_checked`` and ``load_with_rejects`` keep what permissive reading loses: a
line that does not parse whole (a value of another type, too few or too many
fields) is set aside with its reason, and the counts of good and rejected lines
add up to the lines of the file.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapflow.session import shared_dir
from tapflow.sources.tables import read_table, write_table

# Fixed value: the field separator of tap files.
SEPARATOR = "\t"
# Written timestamps keep microseconds; the reader's default parser accepts them.
_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_delimited(spark: SparkSession, path: str, schema: T.StructType,
                   sep: str = SEPARATOR) -> DataFrame:
    """Tab-separated file(s) under a fixed schema."""
    return (spark.read
            .option("header", False)
            .option("inferSchema", False)
            .option("sep", sep)
            .option("mode", "PERMISSIVE")
            .schema(schema)
            .csv(path))


#: Columns of a reject table: the line as it stands, why it was set aside, and its file.
REJECT_COLUMNS = ["line", "reason", "file"]
_RAW = "_corrupt_record"


def _reason(fields: int, sep: str) -> Column:
    """``short``, ``long`` or ``value``, by the separators outside of quotes."""
    bare = F.regexp_replace(_RAW, r'"(?:[^"\\]++|\\.)*+"', "")
    n = F.size(F.split(bare, re.escape(sep), -1))
    return F.when(n < fields, F.lit("short")).when(n > fields, F.lit("long")).otherwise(F.lit("value"))


def read_checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = SEPARATOR) -> DataFrame:
    """S1 with ``line``, ``reason`` and ``file`` (null for lines that parse whole).

    One scan.  Take all columns of it, as ``load_with_rejects`` does: Spark converts
    only what a query selects, so bad values of a column that is left out go unseen.
    Blank lines (white space only) are no rows, as for the reader without checks."""
    lines = (spark.read
             .option("header", False).option("inferSchema", False).option("sep", sep)
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW)
             .schema(T.StructType([*schema.fields, T.StructField(_RAW, T.StringType())]))
             .csv(path))
    bad = F.col(_RAW).isNotNull()
    return lines.select(*[F.col(f.name) for f in schema], F.col(_RAW).alias("line"),
                        F.when(bad, _reason(len(schema), sep)).alias("reason"),
                        F.when(bad, F.col("_metadata.file_path")).alias("file"))


@dataclass
class LoadCounts:
    lines: int
    good: int
    rejected: dict[str, int]  # by reason


def load_with_rejects(spark: SparkSession, path: str, schema: T.StructType, table: str, rejects: str,
                      db: str | None = None, partition_by: str | None = "trade_date",
                      table_path: str | None = None, mode: str = "overwrite",
                      sep: str = SEPARATOR) -> LoadCounts:
    """S8 with reject routing: the file's whole lines go to ``table``, the others to
    the table ``rejects`` (``REJECT_COLUMNS``), which is replaced.

    The text is scanned and parsed once, into a Parquet stage in the shared folder
    that holds good and rejected lines apart; both tables and the counts come from it."""
    stage = f"{shared_dir(spark)}/tapflow-load/{uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(stage)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    checked = read_checked(spark, path, schema, sep)
    checked.withColumn("_rejected", F.col("reason").isNotNull()).write.partitionBy("_rejected").parquet(stage)
    try:
        staged = spark.read.schema(T.StructType([*checked.schema, T.StructField("_rejected", T.BooleanType())])).parquet(stage)
        good, bad = staged.where(~F.col("_rejected")), staged.where("_rejected")
        write_table(good.select(*schema.names), table, db=db, partition_by=partition_by, path=table_path, mode=mode)
        write_table(bad.select(*REJECT_COLUMNS), rejects, db=db)
        counted = {r["reason"]: r["n"] for r in staged.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    finally:
        files.delete(place, True)
    n_good = counted.pop(None, 0)
    return LoadCounts(n_good + sum(counted.values()), n_good, counted)


def write_delimited(df: DataFrame, path: str, sep: str = SEPARATOR) -> None:
    """Write ``df`` as header-less tap files (blanks kept, nulls as empty fields)."""
    (df.write.mode("overwrite")
     .option("sep", sep)
     .option("header", False)
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .option("timestampFormat", _TS_FORMAT)
     .option("timestampNTZFormat", _TS_FORMAT)
     .csv(path))


def load_file_to_table(spark: SparkSession, path: str, schema: T.StructType,
                       table: str, db: str | None = None,
                       partition_by: str | None = "trade_date",
                       table_path: str | None = None, mode: str = "overwrite") -> DataFrame:
    """S8 (X1, X2): read a tap file and save it as a (partitioned) table.

    Returns the table as read back from the catalog.
    """
    df = read_delimited(spark, path, schema)
    write_table(df, table, db=db, partition_by=partition_by, path=table_path, mode=mode)
    return read_table(spark, table, db)
