"""Every named query against DuckDB's answer to its SQL, on whole tables."""

import compare
import pytest

import __spark_entry__ as entry_points
from waymeter.catalogue.oracle import ORACLE
from waymeter.catalogue.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    frame = QUERIES[name](spark, FOLDER)
    assert compare.differences(frame, connection, ORACLE[name]) == []


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= entry_points.queries().items()


def test_entry_is_the_flagship_query(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == [
        "sensor_id", "junction_name", "window_start", "window_end", "mean_speed_kmph",
        "total_vehicles", "congestion_index", "congestion_level",
    ]
    assert frame.count() == 989


def test_known_level_counts(spark):
    frame = entry_points.queries()["congestion_windows"](spark, FOLDER)
    counts = {row[0]: row[1] for row in frame.groupBy("congestion_level").count().collect()}
    assert counts == {"SEVERE": 791, "MODERATE": 1992, "LOW": 6560}
