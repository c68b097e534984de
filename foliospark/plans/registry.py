"""Where queries and their SQL are kept, and what all modules of queries need."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.runtime import table

T = TypeVar("T")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, **pieces: str):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            text = sql
            for name, piece in pieces.items():
                text = text.replace("{" + name + "}", piece)
            ORACLES[f.__name__] = text
        return f

    return add


def plain(c: str = "text") -> Column:
    return F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("ß"), F.lit("ss"))


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def joined(c: str) -> Column:
    return F.array_join(c, " ")


_KEPT: dict[tuple, object] = {}


def kept(spark: SparkSession, d: str, name: str, make: Callable[[], T]) -> T:
    """What `make` gives (tables that it has written), made once for a session and input and then used again by other queries."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]  # type: ignore[return-value]


def forget() -> None:
    """The next query makes everything anew."""
    _KEPT.clear()
