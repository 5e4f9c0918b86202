"""Reading the corpus tables and cutting lineage in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapflow.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there.

    The copy survives lost executors, and Spark's context cleaner removes it
    when nothing refers to it (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` as a compressed table in the shared checkpoint folder, read back from
    there, and what deletes it: for wide or long intermediates, of which a checkpoint's
    plain rows take several times the disk.  Hadoop deletes it when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path), lambda: files.delete(place, True)


def written(df: DataFrame) -> DataFrame:
    """``stored``, kept until the driver ends."""
    return stored(df)[0]


@contextmanager
def single_rows(spark: SparkSession) -> Iterator[None]:
    """What runs inside gets Arrow batches of one row, for rows of many megabytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def keyed(df: DataFrame, seed: int = 5) -> DataFrame:
    """``df`` as (_row, _k1, _k2): each row as one struct, so that its columns may
    have any names, and 128 bits of hash over all its columns (and which of them
    are null).  Rows that agree in every column share a key; others differ in it.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    every = [c.isNull() for c in cols] + cols
    return df.select(F.struct(*cols).alias("_row"), F.xxhash64(F.lit(seed), *every).alias("_k1"),
                     F.xxhash64(F.lit(~seed), *every).alias("_k2"))


def with_rows(placed: DataFrame, df: DataFrame) -> DataFrame:
    """``placed`` (with _k1 and _k2) and the ``_row`` of ``df`` with that key: each
    row of ``placed`` meets exactly one of the (identical) rows with its key, so
    repeated rows stay as many as ``placed`` has."""
    return placed.join(keyed(df).dropDuplicates(["_k1", "_k2"]), ["_k1", "_k2"])


def key_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The runs of rows with equal first ``keys`` columns (non-null integers) of
    a stream of batches that is sorted by them, one table per run."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        new = np.zeros(b.num_rows, dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        bounds = [0, *np.flatnonzero(new).tolist(), b.num_rows]
        for low, high in zip(bounds[:-1], bounds[1:]):
            key = tuple(int(c[low]) for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(low, high - low))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def tile_pairs(df: DataFrame, key: list[str], size: Column, member: Column, tile_rows: int) -> DataFrame:
    """Split groups of ``size`` rows into tiles of about ``tile_rows`` and send
    every row to each pair of tiles that holds its own, as columns ``_lo`` <=
    ``_hi`` (the pair) and ``_tile`` (the row's tile).  Each pair of rows of a
    group then meets in exactly one (key, _lo, _hi), and no task needs a whole
    group."""
    n = F.ceil(size / F.lit(tile_rows)).cast("long")
    own = df.withColumn("_n", F.greatest(n, F.lit(1).cast("long")))
    own = own.withColumn("_tile", F.pmod(F.xxhash64(F.lit(11), member), F.col("_n")))
    other = own.withColumn("_u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    return other.withColumns({"_lo": F.least("_tile", "_u"), "_hi": F.greatest("_tile", "_u")}).drop(
        "_n", "_u")
