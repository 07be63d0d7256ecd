"""Database tables, read in key ranges so that no single task reads the whole table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcTable:
    """A table behind a JDBC driver; ``login`` carries user, password and driver class."""

    url: str
    table: str
    key: str | None = None
    partitions: int = 16
    fetch_size: int = 10_000
    login: dict[str, str] = field(default_factory=dict, repr=False)

    def base_options(self) -> dict[str, str]:
        return {**self.login, "url": self.url, "fetchsize": str(self.fetch_size)}

    def bounds_options(self) -> dict[str, str]:
        bounds = f"SELECT min({self.key}) AS low, max({self.key}) AS high FROM {self.table}"
        return {**self.base_options(), "query": bounds}

    def scan_options(self, low: int | None = None, high: int | None = None) -> dict[str, str]:
        """Options of the table scan, split by key where the bounds are known.

        The bounds only set the stride: rows outside them, and null keys, are still read.
        """
        options = {**self.base_options(), "dbtable": self.table}
        if self.key and low is not None and high is not None:
            options.update(
                partitionColumn=self.key,
                lowerBound=str(low),
                upperBound=str(high),
                numPartitions=str(self.partitions),
            )
        return options


def read_table(spark: SparkSession, source: JdbcTable, format: str = "jdbc") -> DataFrame:
    """The rows of ``source``; asks for its key bounds first when a key is given."""
    low = high = None
    if source.key:
        found = spark.read.format(format).options(**source.bounds_options()).load()
        low, high = found.select(F.col("low").cast("long"), F.col("high").cast("long")).first()
    return spark.read.format(format).options(**source.scan_options(low, high)).load()
