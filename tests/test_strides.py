"""Predicates that share a table out among connections: each row in one, connections of even size."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from waymeter.config import JdbcConfig
from waymeter.sources import jdbc as J

HOUR = timedelta(hours=1)


def table(spark, rows):
    return spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], "id long, at timestamp, sensor string")


def counts(rows):
    """What the database answers to `count_query`."""
    hour = F.date_trunc("hour", "at")
    return rows.groupBy(hour.alias("key"), (hour + F.expr("INTERVAL 1 HOUR")).alias("upto"), F.col("sensor").alias("second")).agg(
        F.count(F.lit(1)).alias("n"))


def shared_out(rows, predicates):
    """Rows of each predicate, and in how many predicates each row is."""
    parts = [rows.filter(p).select("id").collect() for p in predicates]
    times = {}
    for part in parts:
        for row in part:
            times[row.id] = times.get(row.id, 0) + 1
    return [len(p) for p in parts], times


def even(draw):
    return [(datetime(2025, 7, 15) + timedelta(minutes=draw.randrange(3 * 1440)), f"J{draw.randrange(50)}") for _ in range(3000)]


def busy_hour(draw):
    """A third of all rows in one hour."""
    return even(draw)[:2000] + [(datetime(2025, 7, 16, 8, draw.randrange(60)), f"J{draw.randrange(50)}") for _ in range(1000)]


def one_hour(draw):
    return [(datetime(2025, 7, 16, 8, draw.randrange(60)), f"J{draw.randrange(50)}") for _ in range(1000)]


def busy_sensor(draw):
    """One sensor of one hour holds half of all rows: that pair cannot be cut."""
    return even(draw)[:1000] + [(datetime(2025, 7, 16, 8, draw.randrange(60)), "J7") for _ in range(1000)]


def nulls(draw):
    return [(at if draw.random() < 0.8 else None, sensor if draw.random() < 0.6 else None) for at, sensor in busy_hour(draw)]


def quotes(draw):
    return [(at, draw.choice(["J'1", "''", "O'Hara''s", "J2"])) for at, _ in one_hour(draw)]


@pytest.mark.parametrize("rows", [even, busy_hour, one_hour, busy_sensor, nulls, quotes])
def test_each_row_is_in_one_connection(spark, rows):
    made = table(spark, rows(random.Random(8))).persist()
    predicates = J.range_predicates(J.quantile_cuts(counts(made), 8), "at", "sensor")
    sizes, times = shared_out(made, predicates)
    assert len(times) == made.count() and set(times.values()) == {1}
    assert 1 < len(predicates) <= 8
    if rows in (even, busy_hour, one_hour):
        assert len(predicates) == 8 and max(sizes) < 1.6 * made.count() / 8
    if rows is busy_sensor:
        assert sorted(sizes)[-2] < 1.6 * made.count() / 8 <= max(sizes) < 1250
    made.unpersist()


def test_even_strides_would_put_the_busy_hour_in_one_connection(spark):
    made = table(spark, busy_hour(random.Random(8)))
    edges = [datetime(2025, 7, 15) + timedelta(hours=9 * k) for k in range(9)]
    strides = [made.filter((F.col("at") >= a) & (F.col("at") < b)).count() for a, b in zip(edges, edges[1:])]
    cut, _ = shared_out(made, J.range_predicates(J.quantile_cuts(counts(made), 8), "at", "sensor"))
    assert max(strides) > 3 * made.count() / 8 > 2 * max(cut)


def test_little_data_needs_few_connections(spark):
    empty = table(spark, [(datetime(2025, 7, 15), "J1")]).limit(0)
    assert J.quantile_cuts(counts(empty), 8) == [] and J.range_predicates([], "at", "sensor") == ["1 = 1"]
    one = table(spark, [(datetime(2025, 7, 15), "J1")])
    assert J.quantile_cuts(counts(one), 8) == []
    none = table(spark, [(None, "J1"), (None, None)])
    assert shared_out(none, J.range_predicates(J.quantile_cuts(counts(none), 4), "at", "sensor"))[1] == {0: 1, 1: 1}


def test_the_text_of_queries_and_predicates():
    assert J.count_query("congestion_index", "window_start", "sensor_id", "x = 1") == (
        "SELECT date_trunc('hour', window_start) AS key, date_trunc('hour', window_start) + interval '1 hour' AS upto, "
        "sensor_id AS second, count(*) AS n FROM congestion_index WHERE x = 1 GROUP BY date_trunc('hour', window_start), sensor_id")
    whole, inside = J.Cut("2025-07-15 08:00:00", "2025-07-15 09:00:00"), J.Cut("2025-07-15 08:00:00", "2025-07-15 09:00:00", "J'2")
    assert J.range_predicates([whole], "at", "s") == ["(at < '2025-07-15 08:00:00' OR at IS NULL)", "at >= '2025-07-15 08:00:00'"]
    assert J.range_predicates([inside], "at", "s") == [
        "((at < '2025-07-15 08:00:00' OR at < '2025-07-15 09:00:00' AND (s < 'J''2' OR s IS NULL)) OR at IS NULL)",
        "(at >= '2025-07-15 09:00:00' OR at >= '2025-07-15 08:00:00' AND s >= 'J''2')"]


class Reader:
    """Stands in for `spark.read`: notes what is read, answers the grouped count with rows of the test."""

    def __init__(self, answer):
        self.answer, self.noted = answer, {}

    def format(self, kind):
        assert kind == "jdbc"
        return self

    def options(self, **options):
        self.noted["query"] = options
        return self

    def load(self):
        return self.answer

    def jdbc(self, url, table, predicates, properties):
        self.noted |= {"url": url, "table": table, "predicates": predicates, "properties": properties}


def test_a_read_counts_first(spark):
    reader = Reader(counts(table(spark, even(random.Random(1)))))

    class Session:
        read = reader

    config = JdbcConfig(url="jdbc:x", user="u", password="p", max_connections=4)
    J.read_by_quantiles(Session, config, "congestion_index", "window_start", "sensor_id", "window_start >= '2025-07-15'")
    assert "query" in reader.noted["query"] and "dbtable" not in reader.noted["query"]
    assert len(reader.noted["predicates"]) == 4 and all(p.endswith(" AND (window_start >= '2025-07-15')") for p in reader.noted["predicates"])
    assert reader.noted["properties"] == {"user": "u", "password": "p", "driver": "org.postgresql.Driver", "fetchsize": "10000"}
