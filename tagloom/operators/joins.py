"""Joins of large facts to dimensions, safe for hot keys on the fact side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def fits_broadcast(dim: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``dim`` has at most ``rows`` rows and ``size`` bytes of text, by one aggregation over it."""
    measured = dim.agg(
        F.count("*").alias("rows"), F.sum(F.octet_length(F.to_json(F.struct(*dim.columns)))).alias("bytes")
    ).first()
    return measured["rows"] <= rows and (measured["bytes"] or 0) <= size


def join_dimension(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "inner", broadcast: bool | None = None) -> DataFrame:
    """Equi-join ``facts.fact_key = dim.dim_key``; ``how`` is ``inner`` or ``left``.

    A dimension measured to be small is broadcast, so the facts are not shuffled. With a larger one both sides have
    exchanges of their own, and adaptive execution splits the facts of a hot key, or those without a key, over tasks: by
    size, so that copies of one row are split as well, and without repeating the dimension.
    """
    if broadcast is None:
        broadcast = fits_broadcast(dim)
    return facts.join(F.broadcast(dim) if broadcast else dim, facts[fact_key] == dim[dim_key], how)
