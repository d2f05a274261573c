"""Dates of a run published together: a numbered log of commits names the files that each date is served from.

A run writes its rows once, below a folder of its own, and is seen only when its commit exists. A commit takes the
next free number by creating a file that mustn't exist yet, so of two writers one gets it and the other tries the
next. Nothing that was served is ever overwritten.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

LOG = "commit long, run_id string, date string, passed boolean, n_rows long, path string"
MOST_DATES = 10_000


@dataclass(frozen=True)
class Staged:
    """A run's rows, written below ``path`` by date and not served yet."""

    run_id: str
    column: str
    path: str
    rows: DataFrame


def stage(frame: DataFrame, root: str, run_id: str, column: str) -> Staged:
    """Write ``frame`` below ``root`` by ``column``; every attempt has a folder of its own. Null dates are refused."""
    path = f"{root}/data/attempt={uuid.uuid4().hex}"
    whole = F.when(F.col(column).isNotNull(), F.col(column)).otherwise(F.raise_error(F.lit(f"null {column}")).cast(dict(frame.dtypes)[column]))
    # a date has few files; the hint, unlike a repartition, lets adaptive execution split a large one over several tasks
    frame.withColumn(column, whole).hint("rebalance", F.col(column)).write.partitionBy(column).parquet(path)
    return Staged(run_id, column, path, frame.sparkSession.read.schema(frame.schema).parquet(path).select(frame.columns))


def commit(staged: Staged, root: str, verdicts: DataFrame) -> int:
    """Publish the dates that passed and mark those that failed, all at once; returns the commit's number.

    ``verdicts`` has (date, passed) with the date under the staged column's name; a staged date without a verdict
    has failed, and a date with one but without rows is recorded with none. A run that has a commit keeps it: a
    repeated attempt, also one at the same time, changes nothing.
    """
    spark, c = staged.rows.sparkSession, staged.column
    counts = staged.rows.groupBy(c).agg(F.count("*").alias("n_rows"))
    judged = verdicts.groupBy(c).agg(F.bool_and(F.coalesce("passed", F.lit(False))).alias("passed"))
    lines = counts.join(judged, c, "full").select(F.col(c).cast("string").alias("date"), F.coalesce("passed", F.lit(False)).alias("passed"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    found = lines.orderBy("date").limit(MOST_DATES + 1).collect()  # a line for each date of a calendar
    if len(found) > MOST_DATES:
        raise ValueError(f"a run of more than {MOST_DATES} dates")
    while True:
        seen = log(spark, root)
        mine = seen.where(F.col("run_id") == staged.run_id).agg(F.min("commit")).first()[0]
        if mine is not None:
            return mine
        number = seen.agg(F.coalesce(F.max("commit"), F.lit(0))).first()[0] + 1
        rows = [{"commit": number, "run_id": staged.run_id, **r.asDict(), "path": staged.path if r["passed"] else None} for r in found]
        rows = rows or [{"commit": number, "run_id": staged.run_id}]  # a run without dates is one line without a date
        if _create(spark, f"{root}/log/{number:020d}.json", "".join(json.dumps(r) + "\n" for r in rows)):
            return number


def log(spark: SparkSession, root: str) -> DataFrame:
    """A line for each commit and date; empty if nothing was committed."""
    try:
        return spark.read.schema(LOG).option("mode", "FAILFAST").json(f"{root}/log")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], LOG)
        raise


def state(spark: SparkSession, root: str) -> DataFrame:
    """(date, state, last_commit, served_commit, n_rows, path) of each date.

    ``published``: its last verdict was good. ``failed``: it was bad, and nothing is served. ``stale``: it was bad,
    and what an earlier run published is still served.
    """
    good = F.when(F.col("passed"), F.col("commit"))
    by = log(spark, root).where("date is not null").groupBy("date").agg(
        F.max("commit").alias("last_commit"), F.max(good).alias("served_commit"), F.max_by("n_rows", good).alias("n_rows"), F.max_by("path", good).alias("path")
    )
    how = F.when(F.col("served_commit").isNull(), "failed").when(F.col("served_commit") < F.col("last_commit"), "stale").otherwise("published")
    return by.select("date", how.alias("state"), "last_commit", "served_commit", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "path")


def served(spark: SparkSession, root: str, like: DataFrame, column: str, dates: Iterable[str] | None = None) -> DataFrame:
    """What is served of ``dates`` (ISO texts; all if None), with the columns of ``like``: only those dates' files are listed and read."""
    at = state(spark, root).where("path is not null and n_rows > 0")
    if dates is not None:
        at = at.where(F.col("date").isin([str(d) for d in dates]))
    folders = [f"{r['path']}/{column}={r['date']}" for r in at.select("path", "date").collect()]  # a folder for each date of a calendar
    if not folders:
        return spark.createDataFrame([], like.schema)
    columns = StructType([*like.schema.fields, StructField("attempt", StringType())])
    return spark.read.schema(columns).option("basePath", f"{root}/data").parquet(*folders).select(like.columns)


def append_once(frame: DataFrame, path: str, attempt: str) -> None:
    """Append the rows of one attempt to a log: appending them again replaces just these, and attempts don't meet."""
    frame.write.mode("overwrite").parquet(f"{path}/attempt={attempt}")


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a whole file at ``path`` unless there is one; False if there is.

    A hidden file is written first and then gets the name: by a link on a local or mounted disk, elsewhere by a
    rename that refuses an existing target. Both are one step there and on HDFS; a store without such a rename can't
    hold the log.
    """
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    at = fs.makeQualified(at)
    if at.toUri().getScheme() == "file":
        return _link_new(at.toUri().getPath(), text)
    return _rename_new(spark, at, fs, text)


def _link_new(path: str, text: str) -> bool:
    folder, name = os.path.split(path)
    os.makedirs(folder, exist_ok=True)
    hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with open(hidden, "w", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(hidden, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(hidden)
    return True


def _rename_new(spark: SparkSession, path, fs, text: str) -> bool:
    jvm = spark._jvm
    hidden = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}.{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    modes = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    modes[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration()).rename(hidden, path, modes)
    except Exception as e:
        fs.delete(hidden, False)
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    return True
