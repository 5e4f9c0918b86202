"""Partition-wise overwrite and clustered writes."""

import glob
import os
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tapflow.plans.queries import TapFlow
from tapflow.plans.steps import StepOptions, run_step
from tapflow.session import shared_dir
from tapflow.sources import tables

SCHEMA = "card_id string, n int, trade_date string"


def fresh(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def frame(spark, *rows):
    return spark.createDataFrame([(c, n, f"2024010{d}") for c, n, d in rows], SCHEMA)


def rows(df):
    return sorted((r.card_id, r.n, r.trade_date[-1]) for r in df.collect())


@pytest.fixture(params=["catalog", "external", "folder"])
def target(request, spark):
    """A table name and what ``write_table`` needs to make it."""
    if request.param == "folder":
        return fresh(spark, "tbl"), {}
    name = f"tf_{uuid.uuid4().hex}"
    return name, {"path": fresh(spark, "ext")} if request.param == "external" else {}


def test_partitions_are_replaced_alone(spark, target):
    name, options = target
    first = frame(spark, ("a", 1, 1), ("b", 2, 2), ("c", 3, 2), ("d", 4, 3))
    tables.write_table(first, name, partition_by="trade_date", mode="partitions", **options)  # makes the table
    assert rows(tables.read_table(spark, name)) == rows(first)
    again = frame(spark, ("x", 9, 2), ("new", 5, 7))
    tables.write_table(again.select("trade_date", "n", "card_id"), name, partition_by="trade_date", mode="partitions")
    back = tables.read_table(spark, name)
    assert rows(back) == [("a", 1, "1"), ("d", 4, "3"), ("new", 5, "7"), ("x", 9, "2")]
    assert dict(back.dtypes)["trade_date"] == "string"
    # rows that hold no partition replace none
    tables.write_table(again.limit(0), name, partition_by="trade_date", mode="partitions")
    assert rows(tables.read_table(spark, name)) == rows(back)
    # the default still replaces the whole table
    tables.write_table(again, name, partition_by="trade_date", **options)
    assert rows(tables.read_table(spark, name)) == rows(again)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_null_day_is_a_partition(spark):
    name = f"tf_{uuid.uuid4().hex}"
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "20240102")], SCHEMA)
    tables.write_table(df, name, partition_by="trade_date")
    tables.write_table(df.where("trade_date is null").withColumn("n", F.lit(7)), name, partition_by="trade_date", mode="partitions")
    assert sorted((r.card_id, r.n, r.trade_date) for r in tables.read_table(spark, name).collect()) == [
        ("a", 7, None), ("b", 2, "20240102")]


def test_other_layouts_are_refused(spark):
    name = f"tf_{uuid.uuid4().hex}"
    df = frame(spark, ("a", 1, 1))
    tables.write_table(df, name)
    with pytest.raises(ValueError, match="partitioned by"):
        tables.write_table(df, name, partition_by="trade_date", mode="partitions")
    with pytest.raises(ValueError, match="partition column"):
        tables.write_table(df, name, mode="partitions")
    other = f"tf_{uuid.uuid4().hex}"
    tables.write_table(df, other, partition_by="trade_date")
    with pytest.raises(ValueError, match="other columns"):
        tables.write_table(df.withColumn("n", F.lit("text")), other, partition_by="trade_date", mode="partitions")
    assert rows(tables.read_table(spark, other)) == rows(df)


def test_a_day_is_run_again_by_its_step(spark):
    """bus-clean over one day's raw rides replaces that day of the cleaned table."""
    rides = TapFlow(spark, SF0001).inputs["bus_rides"]
    root = fresh(spark, "rerun")
    days = [r[0] for r in rides.select("trade_date").distinct().orderBy("trade_date").limit(3).collect()]
    tables.write_table(rides, f"{root}/all", partition_by="trade_date")
    run_step(spark, "bus-clean", [f"{root}/all", f"{root}/clean"])
    before = tables.read_table(spark, f"{root}/clean").groupBy("trade_date").count().collect()
    tables.write_table(rides.where(F.col("trade_date") == days[1]).limit(2), f"{root}/day", partition_by="trade_date")
    out = run_step(spark, "bus-clean", [f"{root}/day", f"{root}/clean"], StepOptions(mode="partitions"))
    after = dict(out.groupBy("trade_date").count().collect())
    assert after == {**dict(before), days[1]: 2}


def files_per_day(path):
    return Counter(os.path.basename(os.path.dirname(f)) for f in glob.glob(f"{path}/trade_date=*/*.parquet"))


@pytest.fixture
def spread(spark):
    """40,000 rows of 12 days in 24 tasks; two thirds are of one day."""
    day = F.when(F.col("id") % 3 < 2, F.lit("20240101")).otherwise(
        F.concat(F.lit("202402"), F.lpad((F.col("id") % 11 + 1).cast("string"), 2, "0")))
    return spark.range(0, 40_000, 1, 24).select(F.sha2(F.col("id").cast("string"), 256).alias("card_id"),
                                                F.col("id").cast("int").alias("n"), day.alias("trade_date"))


def test_clustered_write_bounds_the_files(spark, spread):
    loose, tight = fresh(spark, "loose"), fresh(spark, "tight")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")  # so that the hot day is several tasks' worth
    try:
        tables.write_table(spread, loose, partition_by="trade_date", cluster=False)
        tables.write_table(spread, tight, partition_by="trade_date")
    finally:
        spark.conf.set(key, before)
    many, few = files_per_day(loose), files_per_day(tight)
    assert min(many.values()) == 24
    hot = few.pop("trade_date=20240101")
    # a day whose key falls into the hot day's shuffle partition is cut with it
    assert 2 <= hot <= 12 and max(few.values()) <= hot
    assert sorted(few.values())[len(few) // 2] == 1
    assert hot + sum(few.values()) < sum(many.values()) / 4
    assert tables.read_table(spark, tight).exceptAll(spread).count() == 0
    assert tables.read_table(spark, tight).count() == spread.count()


def test_rows_per_file_and_order(spark, spread):
    path = fresh(spark, "sorted")
    tables.write_table(spread, path, partition_by="trade_date", sort_by=["n"], max_file_rows=5_000)
    files = files_per_day(path)
    assert files["trade_date=20240101"] >= 6
    for f in glob.glob(f"{path}/trade_date=*/*.parquet"):
        n = [r.n for r in spark.read.parquet(f).coalesce(1).collect()]
        assert len(n) <= 5_000 and n == sorted(n)


def test_plan_rebalances_by_the_partition_column(spread):
    plan = spread.hint("rebalance", "trade_date")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and plan.count("Exchange") == 1
