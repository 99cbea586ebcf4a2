"""Exactly-once JDBC tables: a batch is staged by the executors and moved by one statement.

Rows of a micro-batch are appended to a staging table under their batch's key, the query id and the batch id. One
statement then takes them out of it, writes them to the target and enters the key in a ledger, all or nothing. A
replayed batch finds its key there and does nothing more; one that was not moved starts again from an empty stage.
A keyed table holds one row per key, the newest by an order; a table without keys takes each staged row once.

Statements are PostgreSQL's. They run in sessions that Spark's own JDBC source opens (`sessionInitStatement`), each
before a read of the ledger that shows whether it took effect, and any of them may safely run twice.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.config import JdbcConfig
from waymeter.schemas import CONGESTION_INDEX, CRITICAL_ALERTS
from waymeter.sinks.jdbc import append_table
from waymeter.sources.jdbc import jdbc_options

LEDGER = "batch_ledger"
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]{0,54}(\.[A-Za-z_][A-Za-z0-9_]{0,54})?")
_KEY = re.compile(r"[A-Za-z0-9-]{1,80}")
SQL_TYPES = {
    T.StringType: "text", T.TimestampType: "timestamptz", T.DoubleType: "double precision", T.IntegerType: "integer",
    T.LongType: "bigint", T.BooleanType: "boolean", T.DateType: "date",
}


def batch_key(query_id: str, batch_id: int) -> str:
    key = f"{query_id}-{batch_id:012d}"
    if not _KEY.fullmatch(key):
        raise ValueError(f"no key of a batch: {key!r}")
    return key


def _sql_type(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"numeric({kind.precision},{kind.scale})"
    return SQL_TYPES[type(kind)]


@dataclass(frozen=True)
class StagedTable:
    """A target table, its columns, the columns that name a row (none: every staged row counts) and, for rows of one
    key, the columns whose greatest values are the newest row's."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    newest: tuple[str, ...] = ()
    ledger: str = field(default=LEDGER)

    def __post_init__(self) -> None:
        columns = set(self.schema.fieldNames())
        for name in (self.name, self.ledger):
            if not _NAME.fullmatch(name):
                raise ValueError(f"no name of a table: {name!r}")
        for column in (*columns, *self.keys, *self.newest):
            if column not in columns or not _NAME.fullmatch(column) or "." in column:
                raise ValueError(f"{self.name} has no column {column!r}")

    @property
    def stage(self) -> str:
        return f"{self.name}_staged"

    @property
    def columns(self) -> str:
        return ", ".join(f'"{c}"' for c in self.schema.fieldNames())

    def setup(self) -> list[str]:
        """Tables and the unique index that the moves rely on; running them again changes nothing. Nulls of a key are
        one value (NULLS NOT DISTINCT, PostgreSQL 15)."""
        fields = ", ".join(f'"{f.name}" {_sql_type(f.dataType)}{"" if f.nullable else " NOT NULL"}' for f in self.schema.fields)
        made = [
            f"CREATE TABLE IF NOT EXISTS {self.ledger} (table_name text, batch_key text, rows bigint NOT NULL, "
            "moved_at timestamptz NOT NULL DEFAULT now(), PRIMARY KEY (table_name, batch_key))",
            f"CREATE TABLE IF NOT EXISTS {self.name} ({fields})",
            f"CREATE TABLE IF NOT EXISTS {self.stage} (batch_key text NOT NULL, row_no bigint NOT NULL, {fields})",
            f"CREATE INDEX IF NOT EXISTS {self._plain}_staged_batch ON {self.stage} (batch_key)",
        ]
        if self.keys:
            named = ", ".join(f'"{k}"' for k in self.keys)
            made.append(f"CREATE UNIQUE INDEX IF NOT EXISTS {self._plain}_key ON {self.name} ({named}) NULLS NOT DISTINCT")
        return made

    @property
    def _plain(self) -> str:
        return self.name.replace(".", "_")

    def clear(self, key: str) -> str:
        """Empties the stage of a batch, unless it is moved already and has nothing there."""
        return f"DELETE FROM {self.stage} WHERE batch_key = {_quoted(key)}"

    def move(self, key: str) -> str:
        """Stage to target and ledger in one statement. A task that ran twice staged its rows twice: of equal row
        numbers, or of one key, one row is taken. An entry that is there already blocks the whole statement."""
        named = ", ".join(f'"{k}"' for k in self.keys)
        one = f"DISTINCT ON ({named or 'row_no'})"
        order = ", ".join([named or "row_no", *(f'"{c}" DESC NULLS LAST' for c in self.newest), *["row_no"] * bool(named)])
        conflict = ""
        if self.keys:
            rest = [c for c in self.schema.fieldNames() if c not in self.keys]
            update = ", ".join(f'"{c}" = excluded."{c}"' for c in rest)
            newer = " AND ".join(f'(old."{c}" IS NULL OR old."{c}" <= excluded."{c}")' for c in self.newest[:1])
            conflict = f" ON CONFLICT ({named}) DO UPDATE SET {update}{' WHERE ' + newer if newer else ''}" if rest else f" ON CONFLICT ({named}) DO NOTHING"
        return (
            f"WITH entered AS (INSERT INTO {self.ledger} (table_name, batch_key, rows) "
            f"SELECT {_quoted(self.name)}, {_quoted(key)}, count(*) FROM {self.stage} WHERE batch_key = {_quoted(key)} "
            f"ON CONFLICT DO NOTHING RETURNING batch_key), "
            f"taken AS (DELETE FROM {self.stage} WHERE batch_key = {_quoted(key)} RETURNING row_no, {self.columns}) "
            f"INSERT INTO {self.name} AS old ({self.columns}) "
            f"SELECT {one} {self.columns} FROM taken WHERE EXISTS (SELECT 1 FROM entered) ORDER BY {order}{conflict}"
        )

    def entry(self, key: str) -> str:
        """The ledger's entry of a batch, none before it is moved."""
        return f"SELECT batch_key, rows FROM {self.ledger} WHERE table_name = {_quoted(self.name)} AND batch_key = {_quoted(key)}"


def _quoted(text: str) -> str:
    if "'" in text or "\\" in text:
        raise ValueError(f"no name of a table or batch: {text!r}")
    return f"'{text}'"


WINDOWS = StagedTable("congestion_index", CONGESTION_INDEX, ("sensor_id", "junction_name", "window_start"), ("recorded_at", "total_vehicles"))
ALERTS = StagedTable("critical_alerts", CRITICAL_ALERTS)


def statement_options(config: JdbcConfig, statement: str, query: str) -> dict[str, str]:
    """A read of `query` whose session first runs `statement`. Without a fetch size each statement commits by itself."""
    options = {k: v for k, v in jdbc_options(config, "").items() if k not in ("dbtable", "numPartitions")}
    return {**options, "query": query, "sessionInitStatement": statement, "fetchsize": "0"}


Run = Callable[[str, str], list]


def jdbc_run(spark: SparkSession, config: JdbcConfig) -> Run:
    """Runs a statement, then answers a query on the driver: one row at most, the ledger's."""
    return lambda statement, query: spark.read.format("jdbc").options(**statement_options(config, statement, query)).load().take(1)


def prepare(run: Run, *tables: StagedTable) -> None:
    """Creates what is missing. A table that held several rows of a key must be cleaned before it gets its index."""
    for table in tables:
        for statement in table.setup():
            run(statement, "SELECT 1 AS ready")


def staged_rows(batch: DataFrame, table: StagedTable, key: str) -> DataFrame:
    """The batch as it is staged: the target's columns, the batch's key, and a number per row that a task which runs
    again gives again."""
    names = table.schema.fieldNames()
    return batch.select(F.lit(key).alias("batch_key"), F.monotonically_increasing_id().alias("row_no"), *names)


def upsert_sink(config: JdbcConfig, table: StagedTable, run: Run | None = None,
                append: Callable[[DataFrame, JdbcConfig, str], None] = append_table) -> Callable[[DataFrame, int], None]:
    """A batch sink that writes each batch of a query exactly once. `run` and `append` reach the database."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        key, statements = batch_key(query_id, batch_id), run or jdbc_run(spark, config)
        if statements(table.clear(key), table.entry(key)):
            # Moved before the query could note it. The plan runs all the same: its state must be committed.
            batch.write.format("noop").mode("overwrite").save()
            return
        append(staged_rows(batch, table, key), config, table.stage)
        if not statements(table.move(key), table.entry(key)):
            raise RuntimeError(f"{table.name} did not take batch {key}")

    return write
