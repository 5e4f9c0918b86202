"""Lines that do not parse whole are set aside, counted and kept as they stand."""

import os
import uuid

import pytest

from conftest import SF0001
from tapflow.plans.queries import TapFlow
from tapflow.plans.steps import StepOptions, run_step
from tapflow.session import shared_dir
from tapflow.sources import delimited, fixtures, schemas, tables

GOOD = ["c1\t01\t1\tS1\tD1\t2024-01-01 08:00:00\tI\t20240101", 'c2\t01\t1\t"5\tq"\tD1\t2024-01-01 09:00:00\tI\t20240101',
        "c3\t\t1\tS1 \tD1\t\t\t20240102"]
BLANK = "\t\t\t\t\t\t\t"  # as for the permissive reader, no row
BAD = {"c4\t01\t1\tS1\tD1\tnot-a-time\tI\t20240101": "value", "c5\t01\t1": "short", "lonely": "short",
       "c6\t01\t1\tS1\tD1\t2024-01-01 08:00:00\tO\t20240101\textra": "long", "c7" + "\t" * 500: "long",
       'c8\t01\t1\t"7\tx"\tD1\tnever\tI\t20240101': "value", 'c9\t01\t"a\tb\tc\td\te\tf\tg"': "short",
       "c10\t01\t1\t" + '"' + "y\t" * 100_000 + '"\tD1\tnever\tI\t20240101': "value"}


@pytest.fixture
def folder(spark):
    path = f"{shared_dir(spark)}/rejects-{uuid.uuid4().hex}"
    os.makedirs(f"{path}/in")
    with open(f"{path}/in/a.tsv", "w", encoding="utf-8") as f:
        f.write("\n".join([*GOOD, "", BLANK, *list(BAD)[:4]]) + "\n\n")
    with open(f"{path}/in/b.tsv", "w", encoding="utf-8") as f:
        f.write("\n".join(list(BAD)[4:]))
    return path


def test_lines_are_routed(spark, folder):
    counts = delimited.load_with_rejects(spark, f"{folder}/in", schemas.metro_tap_schema(), f"{folder}/good", f"{folder}/bad")
    assert counts == delimited.LoadCounts(len(GOOD) + len(BAD), len(GOOD), {"value": 3, "short": 3, "long": 2})
    bad = tables.read_table(spark, f"{folder}/bad").collect()
    assert {r.line: r.reason for r in bad} == BAD and len(bad) == len(BAD)
    assert {os.path.basename(r.file) for r in bad if r.line.startswith(("c4", "c5", "lonely"))} == {"a.tsv"}
    good = {r.card_id: r for r in tables.read_table(spark, f"{folder}/good").collect()}
    assert set(good) == {"c1", "c2", "c3"}
    assert good["c2"].station_id == "5\tq" and good["c3"].trade_time is None and good["c3"].station_id == "S1 "
    # the rows are those that the permissive reader gives for these lines
    plain = delimited.read_delimited(spark, f"{folder}/in", schemas.metro_tap_schema())
    assert plain.count() == counts.lines
    assert not [f for f in os.listdir(f"{shared_dir(spark)}/tapflow-load") if not f.startswith(".")]


def test_empty_and_clean_files(spark, folder):
    schema = schemas.metro_tap_schema()
    os.makedirs(f"{folder}/none")
    open(f"{folder}/none/x.tsv", "w").close()
    assert delimited.load_with_rejects(spark, f"{folder}/none", schema, f"{folder}/g0", f"{folder}/b0",
                                       partition_by=None) == delimited.LoadCounts(0, 0, {})
    delimited.write_delimited(TapFlow(spark, SF0001).inputs["bus_rides"], f"{folder}/bus")
    counts = delimited.load_with_rejects(spark, f"{folder}/bus", schemas.bus_ride_schema(), f"{folder}/g1", f"{folder}/b1")
    assert counts.good == counts.lines == 550 and tables.read_table(spark, f"{folder}/b1").count() == 0


def test_checked_rows(spark, folder):
    checked = delimited.read_checked(spark, f"{folder}/in", schemas.metro_tap_schema())
    assert checked.columns == [*schemas.metro_tap_schema().names, "line", "reason", "file"]
    assert {r.line: r.reason for r in checked.collect() if r.reason} == BAD


def test_step_loads_with_rejects(spark, folder):
    lines = fixtures.metro_lines(fixtures.load_events(spark, SF0001))
    lines.write.text(f"{folder}/lines")
    out = run_step(spark, "metro-load", [f"{folder}/lines", f"{folder}/ods"], StepOptions(rejects=f"{folder}/bad"))
    bad = tables.read_table(spark, f"{folder}/bad")
    assert out.count() + bad.count() == lines.count() == 550 and bad.count() == 200
    assert out.columns[-1] == "trade_date"
