"""The ten steps chained through catalog tables equal the in-memory chain."""

import os
import subprocess
import sys
import uuid

from conftest import SF0001
from tapflow.__main__ import main as cli_main
from tapflow.plans.queries import TapFlow
from tapflow.plans.steps import StepOptions, run_step
from tapflow.session import shared_dir
from tapflow.sources import delimited, tables


def read_from_files(tf):
    """The taps as they come from files: an empty field is null."""
    for name in ("bus_rides", "metro_taps"):
        tf.inputs[name] = tf.inputs[name].replace({"": None})
    return tf


def test_cli_rejects_wrong_name_count():
    assert cli_main(["bus-clean", "only_one_name"]) == 255


def test_steps_chain_matches_queries(spark):
    db = "tf_steps"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    tf = TapFlow(spark, SF0001)
    root = f"{shared_dir(spark)}/steps-{uuid.uuid4().hex}"
    delimited.write_delimited(tf.inputs["bus_rides"], f"{root}/bus")
    delimited.write_delimited(tf.inputs["metro_taps"], f"{root}/metro")
    # station tables stand in for the JDBC loads (no database is started)
    tables.write_table(tf.inputs["bus_stations"], "bus_station_tb", db=db)
    tables.write_table(tf.inputs["metro_stations"], "metro_station_tb", db=db)

    o = StepOptions(db=db, hot_threshold=0, rows_per_chunk=50)  # exercise the chunked path
    run_step(spark, "bus-load", [f"{root}/bus", "s_ods_bus"], o)
    run_step(spark, "metro-load", [f"{root}/metro", "s_ods_metro"], o)
    run_step(spark, "bus-clean", ["s_ods_bus", "f_bus_cleaned"], o)
    run_step(spark, "metro-clean", ["s_ods_metro", "f_metro_cleaned"], o)
    run_step(spark, "bus-join-site", ["f_bus_cleaned", "bus_station_tb", "a_bus_withsite"], o)
    run_step(spark, "metro-join-site",
             ["f_metro_cleaned", "metro_station_tb", "a_metro_withsite"], o)
    run_step(spark, "merge", ["a_bus_withsite", "a_metro_withsite", "a_ggjt"], o)
    out = run_step(spark, "od-flow", ["a_ggjt", "m_od_flow"], o)

    want = read_from_files(TapFlow(spark, SF0001)).passenger_flow
    cols = sorted(want.columns)
    assert sorted(out.columns) == cols
    assert out.columns[-1] == "trade_date"
    got = out.select(*cols)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*cols)).count() == 0


def test_steps_as_processes_over_folders(spark, tmp_path):
    """Load to flow, every step in a process of its own, tables as Parquet folders."""
    tf = TapFlow(spark, SF0001)
    delimited.write_delimited(tf.inputs["bus_rides"], f"{tmp_path}/in/bus")
    delimited.write_delimited(tf.inputs["metro_taps"], f"{tmp_path}/in/metro")
    for mode in ("bus", "metro"):
        tf.inputs[f"{mode}_stations"].write.parquet(f"{tmp_path}/{mode}_stations")
    chain = [["bus-load", "in/bus", "s_bus"], ["metro-load", "in/metro", "s_metro"],
             ["bus-clean", "s_bus", "c_bus"], ["metro-clean", "s_metro", "c_metro"],
             ["bus-join-site", "c_bus", "bus_stations", "w_bus"],
             ["metro-join-site", "c_metro", "metro_stations", "w_metro"],
             ["merge", "w_bus", "w_metro", "all"], ["od-flow", "all", "flow"]]
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    conf = "--conf spark.checkpoint.dir=" + f"{tmp_path}/shared" + " --conf spark.sql.shuffle.partitions=4 pyspark-shell"
    for step, *names in chain:
        done = subprocess.run([sys.executable, "-m", "tapflow", step, *[f"{tmp_path}/{n}" for n in names]],
                              env=env | {"PYSPARK_SUBMIT_ARGS": conf}, cwd=tmp_path, capture_output=True,
                              text=True, timeout=240)
        assert done.returncode == 0, done.stderr[-2000:]
    want = read_from_files(TapFlow(spark, SF0001)).passenger_flow
    got = tables.read_table(spark, f"{tmp_path}/flow")
    assert dict(got.dtypes)["trade_date"] == "string"
    got = got.select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
