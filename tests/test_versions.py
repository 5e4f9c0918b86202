"""A step that is killed midway leaves the published table; running it again finishes it."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from tapflow.operators import clean
from tapflow.plans import steps
from tapflow.plans.queries import TapFlow
from tapflow.plans.steps import StepOptions, run_step
from tapflow.sources import tables, versions


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture
def db(spark):
    name = f"tf_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    rides = TapFlow(spark, SF0001).inputs["bus_rides"]
    tables.write_table(rides.where("card_id < '3'"), "rides", db=name, partition_by="trade_date")
    return name


def test_killed_step_and_rerun(spark, db, monkeypatch):
    o = StepOptions(db=db, restartable=True)
    rides = TapFlow(spark, SF0001).inputs["bus_rides"]
    first = run_step(spark, "bus-clean", ["rides", "cleaned"], o)
    rows = first.count()
    assert same(clean.clean_bus(tables.read_table(spark, "rides", db)), first)
    assert len(versions.versions_of(spark, "cleaned", db)) == 1

    # new input; the step dies while its tasks write
    tables.write_table(rides, "rides", db=db, partition_by="trade_date")
    whole = clean.clean_bus

    def dying(df):
        return whole(df).withColumn("card_id", F.when(F.col("mark_tms_id") == "7", F.raise_error(F.lit("killed")).cast("string"))
                                    .otherwise(F.col("card_id")))

    monkeypatch.setattr(steps.clean, "clean_bus", dying)
    with pytest.raises(Exception, match="killed"):
        run_step(spark, "bus-clean", ["rides", "cleaned"], o)
    monkeypatch.setattr(steps.clean, "clean_bus", whole)
    assert tables.read_table(spark, "cleaned", db).count() == rows  # still readable, still the old rows

    again = run_step(spark, "bus-clean", ["rides", "cleaned"], o)
    assert same(clean.clean_bus(rides), again) and again.count() > rows
    shown = versions.versions_of(spark, "cleaned", db)
    assert len(shown) == 2  # this one and the one before it; nothing of the killed run


def test_killed_before_publishing(spark, db, monkeypatch):
    """The version is whole, but its writer dies before it is shown."""
    o = StepOptions(db=db, restartable=True)
    publish = versions.publish
    monkeypatch.setattr(versions, "publish", lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        run_step(spark, "bus-clean", ["rides", "cleaned"], o)
    assert not spark.catalog.tableExists(f"{db}.cleaned") and len(versions.versions_of(spark, "cleaned", db)) == 1
    monkeypatch.setattr(versions, "publish", publish)
    out = run_step(spark, "bus-clean", ["rides", "cleaned"], o)
    assert out.count() > 0 and len(versions.versions_of(spark, "cleaned", db)) == 1


def test_finished_work_is_skipped(spark, db, monkeypatch):
    o = StepOptions(db=db, restartable=True, buckets=3)
    first = run_step(spark, "bus-clean", ["rides", "cleaned"], o).count()
    made = versions.versions_of(spark, "cleaned", db)
    assert tables.buckets_of(spark, "cleaned", "card_id", db) == 3  # through the view
    monkeypatch.setattr(steps.clean, "clean_bus", lambda df: 1 / 0)
    assert run_step(spark, "bus-clean", ["rides", "cleaned"], o).count() == first
    assert versions.versions_of(spark, "cleaned", db) == made
    # the next step reads the published name, and is made again only when that changes
    assert versions.record(spark, "x", ["cleaned"], db) == versions.record(spark, "x", ["cleaned"], db)
    assert versions.record(spark, "x", ["cleaned"], db) != versions.record(spark, "y", ["cleaned"], db)
    assert versions.record(spark, "x", ["no_such"], db) != versions.record(spark, "x", ["no_such"], db)


def test_refused(spark, db):
    plain = f"{db}.rides"
    with pytest.raises(ValueError, match="is a table"):
        versions.published_record(spark, plain)
    for bad in (StepOptions(db=db, restartable=True, mode="partitions"), StepOptions(db=db, restartable=True, path="/x")):
        with pytest.raises(ValueError):
            run_step(spark, "bus-clean", ["rides", "cleaned"], bad)
    with pytest.raises(ValueError, match="catalog names"):
        run_step(spark, "bus-clean", ["rides", "/tmp/x"], StepOptions(db=db, restartable=True))
