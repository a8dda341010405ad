"""Full-refresh writes; running one twice leaves the same table."""

from __future__ import annotations

import logging
import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from venuerank import schemas
from venuerank.functions.rows import complete_rows
from venuerank.operators.profiles import sanitise
from venuerank.sinks.guards import require_unique

log = logging.getLogger(__name__)

JDBC_SETTINGS = ("VENUE_DB_URL", "VENUE_DB_USER", "VENUE_DB_PASSWORD")
CODEC = "zstd"


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None, laid_out: bool = False) -> None:
    """Overwrite a Parquet table.

    With a partition column rows are rebalanced by it first: one value's rows land in few
    files, but AQE still cuts a value that holds a large share of the table. Rows that are read from
    files laid out so (`laid_out`) stay where they are, and nothing is shuffled.
    """
    if partition_by:
        rows = df if laid_out else df.hint("rebalance", partition_by)
        rows.write.mode("overwrite").option("compression", CODEC).partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: str) -> None:
    """Replace the partitions of a Parquet table that `df` has rows of; the others stay as they are."""
    dynamic = df.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    dynamic.option("compression", CODEC).partitionBy(partition_by).parquet(path)


def jdbc_settings(environment: Mapping[str, str] | None = None) -> dict[str, str]:
    """Connection settings, checked before any Spark work is started."""
    source = os.environ if environment is None else environment
    missing = [name for name in JDBC_SETTINGS if not source.get(name)]
    if missing:
        raise OSError(f"missing settings for the database write: {', '.join(missing)}")
    return {
        "url": source["VENUE_DB_URL"],
        "user": source["VENUE_DB_USER"],
        "password": source["VENUE_DB_PASSWORD"],
        "driver": source.get("VENUE_DB_DRIVER", "org.postgresql.Driver"),
    }


def jdbc_options(
    table: str, settings: Mapping[str, str], connections: int = 8, batch: int = 10_000, columns: StructType | None = None
) -> dict[str, str]:
    options = {
        **settings,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch),
    }
    if columns is not None:
        options["createTableColumnTypes"] = ", ".join(f"{c.name} {schemas.sql_type(c)}" for c in columns.fields)
    return options


def swap_statements(table: str, staging: str, columns: StructType) -> list[str]:
    """SQL that replaces a table's rows by those of its staging table; run as one transaction."""
    names = ", ".join(columns.names)
    return [
        *schemas.create_statements(table, columns), f"DELETE FROM {table}",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}", f"DROP TABLE {staging}",
    ]


def write_jdbc(df: DataFrame, table: str, settings: Mapping[str, str], connections: int = 8) -> None:
    """Replace the rows of a database table.

    Executors load a staging table over at most `connections` connections. Only when it is
    complete do its rows take the place of the old ones, in one transaction, so readers see all
    of either, and a failed load leaves the table as it was, with its key and indexes.
    """
    staging = f"{table}_staging"
    df.write.format("jdbc").mode("overwrite").options(**jdbc_options(staging, settings, connections, columns=df.schema)).save()
    run_transaction(df.sparkSession, swap_statements(table, staging, df.schema), settings)


def run_transaction(spark: SparkSession, statements: list[str], settings: Mapping[str, str]) -> None:
    jvm = spark.sparkContext._jvm
    jvm.java.lang.Class.forName(settings["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(settings["url"], settings["user"], settings["password"])
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
        connection.commit()
    finally:
        connection.close()  # undoes what wasn't committed


def read_jdbc(spark: SparkSession, table: str, settings: Mapping[str, str], **parameters: str) -> DataFrame:
    """A database table, or the rows whose columns equal the named parameters; the filter reaches the database."""
    df = spark.read.format("jdbc").options(**settings, dbtable=table).load()
    for name, value in parameters.items():
        df = df.filter(df[name] == value)
    return df


def ready_for_serving(df: DataFrame, table: str) -> DataFrame:
    """Typed, complete rows with the table's key checked."""
    if table == "als_recommendations":
        df = complete_rows(df, schemas.RECOMMENDATION_COLUMNS).select(
            "user_id", "business_id", df["predicted_rating"].cast("double").alias("predicted_rating"),
            df["rank"].cast("int").alias("rank"),
        )
    elif table == "grid_sentiment":
        df = complete_rows(df, ["grid_cell", "sentiment_score"]).select(
            "grid_cell", "sentiment_score", df["positive_count"].cast("int").alias("positive_count"),
            df["negative_count"].cast("int").alias("negative_count"),
        )
    elif table == "business_profiles":
        df = sanitise(df).select(*schemas.PROFILE_COLUMNS)
    return require_unique(df, schemas.PRIMARY_KEYS[table])


def copy_tables(
    names: list[str], read: Callable[[str], DataFrame], write: Callable[[DataFrame, str], None]
) -> list[str]:
    """Copy tables one by one; an empty source is reported and left out. Returns those copied."""
    copied = []
    for name in names:
        source = read(name)
        if source.isEmpty():
            log.warning("table %s is empty, not copied", name)
            continue
        write(source, name)
        copied.append(name)
    return copied
