"""Typed scans, table checks and sinks."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.fingerprint import fingerprint


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table. Timestamps stay without a zone, so no session setting can shift them."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_typed_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV file with a header, read by position with a declared schema; bad values fail the query."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def load_tables(spark: SparkSession, folder: str, schemas: Mapping[str, StructType], required: set[str]) -> dict[str, DataFrame]:
    """CSV tables by name; a missing one raises FileNotFoundError, an empty required one ValueError."""
    found = {}
    for name, schema in schemas.items():
        path = f"{folder}/{name}.csv"
        try:
            found[name] = read_typed_csv(spark, path, schema)
        except Exception as e:  # Spark reports a missing path as an analysis error
            if "PATH_NOT_FOUND" in str(e):
                raise FileNotFoundError(path) from e
            raise
    for name in sorted(required):
        if found[name].isEmpty():
            raise ValueError(f"table {name} is empty")
    return found


def audit(tables: Mapping[str, DataFrame], required: set[str]) -> DataFrame:
    """(table_name, n, status): ``empty`` for a required table without rows, else ``ok``."""
    rows = [
        t.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"),
            "n",
            F.when((F.col("n") == 0) & F.lit(name in required), "empty").otherwise("ok").alias("status"),
        )
        for name, t in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def write_once(frame: DataFrame, path: str) -> DataFrame:
    """Write a new Parquet table (an existing one is refused) and read it back."""
    frame.write.mode("errorifexists").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def replace_partition(frame: DataFrame, path: str, column: str) -> None:
    """Replace just the partitions that ``frame`` holds; running it again changes nothing."""
    frame.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(column).parquet(path)


def append_rows(frame: DataFrame, path: str) -> None:
    frame.write.mode("append").parquet(path)


def publish(staged: DataFrame, root: str, passed: bool, summed: tuple[str, ...] = ()) -> bool:
    """Serve a new version of a table below ``root`` if its audit ``passed``; else what is served stays.

    A version is written, read back and held against the staged table (schema, rows, sums, content fingerprint)
    before a marker row names it; readers take the newest marker, so a version without one is never seen.
    """
    if not passed:
        return False
    spark = staged.sparkSession
    facts = lambda f: f.agg(F.count("*").alias("n_rows"), *(F.sum(c).cast("double").alias(c) for c in summed)).crossJoin(fingerprint(f).select("fingerprint")).first().asDict()
    path, wanted = f"{root}/version-{uuid.uuid4().hex[:12]}", facts(staged)
    version = write_once(staged, path)
    if version.dtypes != staged.dtypes or facts(version) != wanted:
        raise ValueError("the written version differs from the staged table")
    columns = ",".join(version.columns)
    marker = [(path, time.time_ns(), wanted["n_rows"], wanted["fingerprint"], columns)]
    append_rows(spark.createDataFrame(marker, "path string, at long, n_rows long, fingerprint string, columns string"), f"{root}/markers")
    return True


def served(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """The newest published version, held against its marker, and how many there are."""
    markers = spark.read.parquet(f"{root}/markers")
    n = markers.count()
    newest = markers.orderBy(F.desc("at")).first()  # one short row for each publication
    found = spark.read.parquet(newest["path"])
    if found.columns != newest["columns"].split(",") or found.count() != newest["n_rows"] or fingerprint(found).first()["fingerprint"] != newest["fingerprint"]:
        raise ValueError("the served version differs from its marker")
    return found, n
