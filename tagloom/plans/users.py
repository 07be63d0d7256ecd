"""Publication of the users dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from tagloom.config import Zones
from tagloom.operators.users import build_users_dim
from tagloom.schemas import USERS, USERS_DIM
from tagloom.sinks.tables import create_database, create_external_table, overwrite_table
from tagloom.sources.files import read_csv


def publish_users(spark: SparkSession, zones: Zones, batch: datetime | str | None = None) -> None:
    """Landed users to the users table, replacing its rows. No shuffle."""
    location = f"{zones.serving}/users_dim"
    dim = build_users_dim(read_csv(spark, zones.users, USERS, multi_line=True), batch)
    create_database(spark, zones.database, f"{zones.serving}/database")
    create_external_table(spark, zones.users_dim, USERS_DIM, location, format=zones.table_format)
    overwrite_table(dim, zones.users_dim, USERS_DIM, location, zones.table_format)
