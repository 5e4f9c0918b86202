"""Scans and sinks: delimited files, catalog tables, overwrite semantics."""

import datetime as dt
import os
import uuid

from pyspark.sql import types as T

from tapflow.session import shared_dir
from tapflow.sources.delimited import load_file_to_table, read_delimited, write_delimited
from tapflow.sources.schemas import metro_tap_schema
from tapflow.sources.tables import read_table, write_table


def fresh(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def test_tsv_permissive(spark):
    path = fresh(spark, "tsv")
    os.makedirs(path)
    with open(os.path.join(path, "taps.tsv"), "w", encoding="utf-8") as fh:
        fh.write("c1\t01\t1\tS1\tD1\tnot-a-time\tI\t20240101\n")        # bad timestamp
        fh.write("c2\t01\t1\n")                                        # short row
        fh.write("c3\t01\t1\tS1\tD1\t2024-01-01 08:00:00\tO\t20240101\textra\n")
        fh.write('c4\t01\t1\t"5\tq"\tD1\t2024-01-01 09:00:00\tI\t20240101\n')  # quoted tab
        fh.write("c5\t\t1\tS1 \tD1\t2024-01-01 10:00:00.123456\tI\t20240101\n")
    rows = {r.card_id: r for r in read_delimited(spark, path, metro_tap_schema()).collect()}
    assert rows["c1"].trade_time is None and rows["c1"].io_type == "I"
    assert rows["c2"].station_id is None and rows["c2"].trade_date is None
    assert rows["c3"].trade_date == "20240101"
    assert rows["c4"].station_id == "5\tq"
    assert rows["c5"].card_type is None and rows["c5"].station_id == "S1 "
    assert rows["c5"].trade_time.microsecond == 123456


def test_tsv_round_trip_keeps_blanks_nulls_micros(spark):
    schema = metro_tap_schema(T.TimestampNTZType())
    data = [("c1", "01", "1", "NATION_3 ", "D1", dt.datetime(2024, 1, 2, 3, 4, 5, 678901),
             None, "20240102")]
    df = spark.createDataFrame(data, schema)
    path = fresh(spark, "rt")
    write_delimited(df, path)
    assert read_delimited(spark, path, schema).collect() == df.collect()


def test_partitioned_overwrite_replaces_whole_table(spark):
    schema = "card_id string, n int, trade_date string"
    first = spark.createDataFrame([("a", 1, "20240101"), ("b", 2, "20240102")], schema)
    second = spark.createDataFrame([("c", 3, "20240103")], schema)
    path = fresh(spark, "tbl")
    write_table(first, "tf_overwrite", partition_by="trade_date", path=path)
    write_table(second, "tf_overwrite", partition_by="trade_date", path=path)
    back = read_table(spark, "tf_overwrite")
    assert [r.card_id for r in back.collect()] == ["c"]
    # partition column moves to the end and stays a string
    assert back.columns[-1] == "trade_date"
    assert back.schema["trade_date"].dataType == T.StringType()


def test_file_to_table_prunes_by_date(spark):
    schema = metro_tap_schema(T.TimestampNTZType())
    data = [(f"c{i}", "01", "1", "S", "D1", dt.datetime(2024, 1, 1 + i % 3), "I",
             f"2024010{1 + i % 3}") for i in range(12)]
    src = fresh(spark, "src")
    write_delimited(spark.createDataFrame(data, schema), src)
    table = load_file_to_table(spark, src, schema, "tf_ods_metro", table_path=fresh(spark, "ods"))
    one_day = table.where("trade_date = '20240102'")
    assert one_day.count() == 4
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "20240102" in plan


def test_jdbc_partitioned_read_needs_bounds(spark):
    # option handling only: no database is started
    import pytest

    from tapflow.sources.jdbc import read_jdbc
    with pytest.raises(ValueError):
        read_jdbc(spark, {"url": "jdbc:none", "dbtable": "t"}, partition_column="id")


def test_shared_dir_uses_session_checkpoint_dir(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured and shared_dir(spark) == configured.rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None
