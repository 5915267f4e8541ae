"""Registry of named queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    covers: tuple[str, ...]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function under its own name.

    ``covers`` lists the inventory ids it exercises, ``sql`` is the same question in
    plain SQL, used as the check.
    """

    def register(run: Callable[[SparkSession, str], DataFrame]):
        if run.__name__ in REGISTRY:
            raise ValueError(f"{run.__name__} is registered twice")
        REGISTRY[run.__name__] = Query(run, tuple(covers.split()), sql)
        return run

    return register
