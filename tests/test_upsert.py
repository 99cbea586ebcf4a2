"""The exactly-once JDBC sink: its statements as text, and its steps against a ledger kept in Python.

No database takes part, so what a server makes of the statements is not shown here.
"""

import os
from datetime import datetime
from decimal import Decimal

import duckdb
import pytest

from waymeter.config import JdbcConfig, StreamConfig
from waymeter.schemas import CONGESTION_INDEX
from waymeter.sinks.upsert import ALERTS, WINDOWS, StagedTable, batch_key, prepare, staged_rows, statement_options, upsert_sink
from waymeter.sources.replay import replay_messages
from waymeter.operators.messages import decode_messages
from waymeter.streaming import queries as Q

KEY = "q-000000000003"


def test_statements_of_a_keyed_table():
    assert WINDOWS.clear(KEY) == "DELETE FROM congestion_index_staged WHERE batch_key = 'q-000000000003'"
    assert WINDOWS.entry(KEY) == (
        "SELECT batch_key, rows FROM batch_ledger WHERE table_name = 'congestion_index' AND batch_key = 'q-000000000003'")
    move = WINDOWS.move(KEY)
    columns = ('"sensor_id", "junction_name", "window_start", "window_end", "mean_speed_kmph", "total_vehicles", '
               '"congestion_index", "congestion_level", "recorded_at"')
    assert move == (
        "WITH entered AS (INSERT INTO batch_ledger (table_name, batch_key, rows) SELECT 'congestion_index', 'q-000000000003', "
        "count(*) FROM congestion_index_staged WHERE batch_key = 'q-000000000003' ON CONFLICT DO NOTHING RETURNING batch_key), "
        f"taken AS (DELETE FROM congestion_index_staged WHERE batch_key = 'q-000000000003' RETURNING row_no, {columns}) "
        f"INSERT INTO congestion_index AS old ({columns}) "
        f'SELECT DISTINCT ON ("sensor_id", "junction_name", "window_start") {columns} FROM taken '
        "WHERE EXISTS (SELECT 1 FROM entered) "
        'ORDER BY "sensor_id", "junction_name", "window_start", "recorded_at" DESC NULLS LAST, "total_vehicles" DESC NULLS LAST, row_no '
        'ON CONFLICT ("sensor_id", "junction_name", "window_start") DO UPDATE SET "window_end" = excluded."window_end", '
        '"mean_speed_kmph" = excluded."mean_speed_kmph", "total_vehicles" = excluded."total_vehicles", '
        '"congestion_index" = excluded."congestion_index", "congestion_level" = excluded."congestion_level", '
        '"recorded_at" = excluded."recorded_at" WHERE (old."recorded_at" IS NULL OR old."recorded_at" <= excluded."recorded_at")')


def test_statements_of_a_table_without_keys():
    move = ALERTS.move(KEY)
    assert "SELECT DISTINCT ON (row_no) " in move and move.endswith("ORDER BY row_no")
    assert " ON CONFLICT (" not in move
    assert not any("UNIQUE" in s for s in ALERTS.setup())


def test_setup_names_every_column_with_its_type():
    made = WINDOWS.setup()
    assert made[1] == (
        'CREATE TABLE IF NOT EXISTS congestion_index ("sensor_id" text NOT NULL, "junction_name" text, '
        '"window_start" timestamptz NOT NULL, "window_end" timestamptz NOT NULL, "mean_speed_kmph" numeric(6,2), '
        '"total_vehicles" bigint, "congestion_index" numeric(12,2), "congestion_level" text, "recorded_at" timestamptz)')
    assert made[2].startswith("CREATE TABLE IF NOT EXISTS congestion_index_staged (batch_key text NOT NULL, row_no bigint NOT NULL, ")
    assert made[-1] == ('CREATE UNIQUE INDEX IF NOT EXISTS congestion_index_key ON congestion_index '
                        '("sensor_id", "junction_name", "window_start") NULLS NOT DISTINCT')
    assert StagedTable("s.t", CONGESTION_INDEX, ("sensor_id",)).setup()[-1].startswith("CREATE UNIQUE INDEX IF NOT EXISTS s_t_key ON s.t ")
    ran = []
    prepare(lambda statement, query: ran.append((statement, query)), WINDOWS, ALERTS)
    assert [s for s, _ in ran] == WINDOWS.setup() + ALERTS.setup() and {q for _, q in ran} == {"SELECT 1 AS ready"}


@pytest.mark.parametrize("name", ["t; drop", "a b", "", "1t", "t'"])
def test_names_and_keys_are_checked(name):
    with pytest.raises(ValueError):
        StagedTable(name, CONGESTION_INDEX)
    with pytest.raises(ValueError):
        StagedTable("t", CONGESTION_INDEX, (name or "x",))
    with pytest.raises(ValueError):
        batch_key(name + "'", 3)
    assert batch_key("q", 3) == KEY


def test_a_statement_runs_in_the_session_of_a_read():
    options = statement_options(JdbcConfig(url="jdbc:x", user="u", password="p"), "MOVE", "LOOK")
    assert options == {"url": "jdbc:x", "user": "u", "password": "p", "driver": "org.postgresql.Driver",
                       "query": "LOOK", "sessionInitStatement": "MOVE", "fetchsize": "0"}


class Tables:
    """Stage, target and ledger of one table, as the statements would leave them. Statements are told by their text;
    the choice among staged rows is made by the statement's own SELECT, in DuckDB."""

    def __init__(self, table):
        self.table, self.staged, self.ledger = table, [], {}
        self.target, self.fail, self.ran = {}, set(), []

    def run(self, statement, query):
        kind, key = statement.split()[0], query.rsplit("'", 2)[1]
        self.ran.append(kind)
        assert query == self.table.entry(key)
        if kind == "DELETE":
            assert statement == self.table.clear(key)
            self.staged = [r for r in self.staged if r["batch_key"] != key]
        else:
            assert statement == self.table.move(key)
            if "before" in self.fail:
                raise ConnectionError
            if key not in self.ledger:
                self._move(statement, key)
            if "after" in self.fail:
                raise ConnectionError
        return [key] if key in self.ledger else []

    def _move(self, statement, key):
        mine = [r for r in self.staged if r["batch_key"] == key]
        self.staged = [r for r in self.staged if r["batch_key"] != key]
        self.ledger[key] = len(mine)
        if not mine:
            return
        connection = duckdb.connect()
        names = list(mine[0])
        connection.execute("CREATE TABLE taken (" + ", ".join(
            f'"{n}" ' + ("VARCHAR" if isinstance(mine[0][n], str) else "TIMESTAMP" if isinstance(mine[0][n], datetime)
                         else "DECIMAL(12,2)" if isinstance(mine[0][n], Decimal) else "BIGINT") for n in names) + ")")
        connection.executemany(f"INSERT INTO taken VALUES ({', '.join('?' * len(names))})", [list(r.values()) for r in mine])
        connection.execute("CREATE TABLE entered AS SELECT 1 AS batch_key")
        chosen = statement[statement.index("SELECT DISTINCT ON"):].split(" ON CONFLICT")[0]
        for row in connection.sql(chosen).fetchall():
            row = dict(zip(self.table.schema.fieldNames(), row))
            name = tuple(row[k] for k in self.table.keys)
            old = self.target.get(name)
            if old is None or old["recorded_at"] <= row["recorded_at"]:
                self.target[name] = row

    def append(self, rows, config, name):
        assert name == self.table.stage
        made = [r.asDict() for r in rows.collect()]
        self.staged += made
        if "twice" in self.fail:  # a task that committed and ran again
            self.staged += made[:2]
        if "append" in self.fail:
            raise ConnectionError


def windows(spark, *rows):
    made = [("J1", "A", datetime(2025, 7, 15, 8, m), datetime(2025, 7, 15, 8, m + 5), Decimal("20.00"), n, Decimal("1.00"), "LOW", at)
            for m, n, at in rows]
    return spark.createDataFrame(made, CONGESTION_INDEX)


@pytest.mark.parametrize("fault", ["append", "before", "after", "twice"])
def test_a_replayed_batch_replaces_itself(spark, fault):
    early, late = datetime(2025, 7, 15, 9), datetime(2025, 7, 15, 10)
    tables = Tables(WINDOWS)
    sink = upsert_sink(JdbcConfig(), WINDOWS, tables.run, tables.append)
    sink(windows(spark, (0, 10, early), (5, 20, early)), 0)
    tables.fail = {fault}
    batch = windows(spark, (5, 25, late), (10, 5, late), (15, 7, late))
    if fault == "twice":
        sink(batch, 1)
    else:
        with pytest.raises(ConnectionError):
            sink(batch, 1)
    tables.fail = set()
    sink(batch, 1)
    sink(windows(spark, (5, 20, early), (0, 10, early)), 0)  # replayed late: the ledger stops it
    assert sorted(r["total_vehicles"] for r in tables.target.values()) == [5, 7, 10, 25]
    assert tables.staged == [] and sorted(tables.ledger) == ["batch-000000000000", "batch-000000000001"]
    before = len(tables.ran)
    sink(batch, 1)
    assert tables.ran[before:] == ["DELETE"]


def test_an_older_row_never_replaces_a_newer(spark):
    tables = Tables(WINDOWS)
    sink = upsert_sink(JdbcConfig(), WINDOWS, tables.run, tables.append)
    sink(windows(spark, (0, 30, datetime(2025, 7, 15, 10)), (0, 20, datetime(2025, 7, 15, 9))), 0)
    sink(windows(spark, (0, 10, datetime(2025, 7, 15, 8))), 1)
    assert [r["total_vehicles"] for r in tables.target.values()] == [30]


def test_a_batch_that_is_not_taken_raises(spark):
    sink = upsert_sink(JdbcConfig(), WINDOWS, lambda statement, query: [], lambda *args: None)
    with pytest.raises(RuntimeError, match="did not take batch"):
        sink(windows(spark), 0)


def test_rows_are_staged_under_key_and_number(spark):
    rows = staged_rows(windows(spark, (0, 1, None), (5, 2, None)).repartition(2), WINDOWS, KEY).collect()
    assert {r.batch_key for r in rows} == {KEY} and len({r.row_no for r in rows}) == 2
    assert list(rows[0].asDict()) == ["batch_key", "row_no", *CONGESTION_INDEX.fieldNames()]


def test_a_restarted_stream_writes_each_window_once(spark, tmp_path):
    """The stream dies after the move and before its commit; the new run replays the batch under the same key."""
    topic = tmp_path / "topic"
    topic.mkdir()
    for k, clock in enumerate(("08:00:10", "08:20:00", "08:40:00")):
        file = topic / f"{k}.json"
        file.write_text(
            f'{{"sensor_id":"J1","junction_name":"A","timestamp":"2025-07-15T{clock}.000000Z","vehicle_count":{k + 1},"avg_speed":20.0}}\n')
        os.utime(file, (1_700_000_000 + k, 1_700_000_000 + k))  # batches in this order
    readings = decode_messages(replay_messages(spark, str(topic), files_per_batch=1)).drop("json_str")
    config, tables = StreamConfig(checkpoint_base=f"{tmp_path}/c"), Tables(WINDOWS)
    sink = upsert_sink(JdbcConfig(), WINDOWS, tables.run, tables.append)
    tables.fail = {"after"}
    for _ in range(4):  # each run gets one batch through that the query then repeats
        query = Q.start_congestion_sink(readings, config, sink, {"availableNow": True})
        try:
            query.awaitTermination(120)
        except Exception as error:
            assert "ConnectionError" in str(error)
    tables.fail = set()
    Q.start_congestion_sink(readings, config, sink, {"availableNow": True}).awaitTermination(120)
    assert [r["total_vehicles"] for r in tables.target.values()] == [1, 2]
    assert len({k.rsplit("-", 1)[0] for k in tables.ledger}) == 1
