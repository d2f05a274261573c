"""Collects queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import package
from ..sources.adapter import SQL, Roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *ctes: str):
    """Register a function of :class:`Roles`; ``sql`` may use the role tables and further ``ctes``."""

    def add(f: Callable[[Roles], DataFrame]):
        QUERIES[name] = lambda spark, folder: f(Plans(spark, folder))  # the class as it is at call time
        if sql is not None:
            ORACLES[name] = "WITH " + ",\n".join([SQL.strip(), *ctes]) + "\n" + sql
        return f

    return add


#: Landed tables by application, input folder and name.
_LANDED: dict[tuple[str, str, str], str] = {}


def forget() -> None:
    """Let later queries land their tables anew (a benchmark does this between queries)."""
    _LANDED.clear()


class Plans(Roles):
    """Roles and the tables derived from them, each defined once.

    Tables that several others build on are landed: written once to the folder that driver and executors share
    and read from there. Without that, every use would repeat the self-joins below it, and plans would grow
    with the product of their uses.
    """

    def shared_path(self, name: str) -> str:
        return package.shared_path(self.spark, name)

    def landed(self, name: str, frame: Callable[[], DataFrame]) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _LANDED:
            path = self.shared_path(name)
            frame().write.parquet(path)
            _LANDED[key] = path
        return self.spark.read.parquet(_LANDED[key])
