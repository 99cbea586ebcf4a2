"""Stored tables over JDBC, read by many tasks over the time range they need."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waymeter.config import JdbcConfig


def jdbc_options(config: JdbcConfig, table: str) -> dict[str, str]:
    return {
        "url": config.url,
        "dbtable": table,
        "user": config.user,
        "password": config.password,
        "driver": config.driver,
        "numPartitions": str(config.max_connections),
    }


def jdbc_read_options(
    config: JdbcConfig, table: str, column: str | None = None,
    lower: str | None = None, upper: str | None = None,
) -> dict[str, str]:
    """With a column and its bounds, each connection reads one stride of the range.

    The bounds only place the strides; they drop no row. Filters on the result are pushed down.
    """
    options = {**jdbc_options(config, table), "fetchsize": str(config.fetch_size)}
    if column is not None:
        if lower is None or upper is None:
            raise ValueError("a partition column needs both bounds")
        options |= {"partitionColumn": column, "lowerBound": lower, "upperBound": upper}
    return options


@dataclass(frozen=True)
class Cut:
    """An end of a range: rows before `key`, an instant, or in the unit from `key` to `upto` and below `second`."""

    key: str
    upto: str
    second: str | None = None


def quantile_cuts(counts: DataFrame, connections: int) -> list[Cut]:
    """Ends of at most `connections` ranges of about equal numbers of rows.

    `counts` (key, upto, second, n) says how many rows a table holds per unit of its key, such as an hour, and second
    key, such as a sensor; one grouped query of the database gives it. A unit with more rows than a range is cut
    inside, by the second key, so a busy hour is not one connection. Only the sums of units are put in order in one
    task; a cut per connection comes to the driver.
    """
    known = counts.where("key IS NOT NULL AND n > 0")
    units = known.groupBy("key", "upto").agg(F.sum("n").alias("unit"))
    behind = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    placed = units.withColumn("before", F.coalesce(F.sum("unit").over(behind), F.lit(0)))
    total = F.broadcast(units.agg(F.sum("unit").alias("total")))  # one row
    inside = Window.partitionBy("key").orderBy("second").rowsBetween(Window.unboundedPreceding, -1)
    rows = known.groupBy("key", "second").agg(F.sum("n").alias("n")).withColumn("done", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    shares = rows.join(placed, "key").crossJoin(total).withColumn(
        "range", F.floor((F.col("before") + F.col("done")) * connections / F.col("total")))
    first = shares.groupBy("range").agg(F.min(F.struct("key", "upto", "second", (F.col("done") == 0).alias("whole"))).alias("cut"))
    return [
        Cut(str(row.key), str(row.upto), None if row.whole else str(row.second))
        for row in first.where("range > 0").orderBy("range").select("cut.*").collect()
    ]


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def range_predicates(cuts: list[Cut], key: str, second: str) -> list[str]:
    """A WHERE clause per range between the cuts; every row, one with null keys too, satisfies exactly one.

    Rows without the key are in the first range, rows without the second key before all others of their unit. All
    comparisons are of plain columns, so an index on them serves each connection.
    """
    def below(cut: Cut) -> str:
        if cut.second is None:
            return f"{key} < {_literal(cut.key)}"
        return (f"({key} < {_literal(cut.key)} OR {key} < {_literal(cut.upto)} AND "
                f"({second} < {_literal(cut.second)} OR {second} IS NULL))")

    def from_(cut: Cut) -> str:
        if cut.second is None:
            return f"{key} >= {_literal(cut.key)}"
        return f"({key} >= {_literal(cut.upto)} OR {key} >= {_literal(cut.key)} AND {second} >= {_literal(cut.second)})"

    if not cuts:
        return ["1 = 1"]
    middle = [f"{from_(a)} AND {below(b)}" for a, b in zip(cuts, cuts[1:])]
    return [f"({below(cuts[0])} OR {key} IS NULL)", *middle, from_(cuts[-1])]


def count_query(table: str, key: str, second: str, where: str = "1 = 1") -> str:
    """Rows per hour of `key` and second key."""
    hour = f"date_trunc('hour', {key})"
    return (f"SELECT {hour} AS key, {hour} + interval '1 hour' AS upto, {second} AS second, count(*) AS n "
            f"FROM {table} WHERE {where} GROUP BY {hour}, {second}")


def read_by_quantiles(spark: SparkSession, config: JdbcConfig, table: str, key: str, second: str, where: str = "1 = 1") -> DataFrame:
    """The rows of the table that satisfy `where`, in connections of about equal numbers of rows, however uneven its
    hours are. The bounds of connections are UTC; the session of the database must be too."""
    options = {k: v for k, v in jdbc_options(config, table).items() if k not in ("dbtable", "numPartitions")}
    counts = spark.read.format("jdbc").options(**options, query=count_query(table, key, second, where)).load()
    predicates = range_predicates(quantile_cuts(counts, config.max_connections), key, second)
    properties = {k: options[k] for k in ("user", "password", "driver")} | {"fetchsize": str(config.fetch_size)}
    return spark.read.jdbc(config.url, table, predicates=[f"({p}) AND ({where})" for p in predicates], properties=properties)


def read_table(spark: SparkSession, config: JdbcConfig, table: str, **strides: str) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(config, table, **strides)).load()
