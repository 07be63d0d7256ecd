"""Named queries over a data folder, and the SQL that checks them."""

from tagloom.catalog.oracles import oracle_sql
from tagloom.catalog.queries import flagship, queries

__all__ = ["flagship", "oracle_sql", "queries"]
