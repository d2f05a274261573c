"""Guards of scoring: windows that can be judged, label-free inputs, complete labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .intervals import WINDOW_DAYS, days

# fixed values: columns that only become known after a stay
LABEL_SIDE = ("is_readmitted", "label_horizon")


def window_days(dates: DataFrame, back: int, until: int = 0) -> DataFrame:
    """(..., day): one row for each day from ``d - back`` to ``d - until`` of each date's window."""
    return dates.withColumn("day", F.explode(F.sequence(F.date_sub("d", back), F.date_sub("d", until))))


def in_windows(rows: DataFrame, at: str, dates: DataFrame, back: int, until: int = 0) -> DataFrame:
    """``rows`` once for each date whose window, whole days from ``d - back`` to ``d - until``, holds their instant ``at``.

    Windows of any distance and overlap are days that a row's own day equals, so no row is compared with a date that
    it isn't in. Dates are a calendar, hence broadcast.
    """
    days = window_days(dates, back, until).withColumnRenamed("day", "_day")
    return rows.join(F.broadcast(days), F.to_date(at) == F.col("_day")).drop("_day")


def windows(dates: DataFrame, rows: DataFrame, window_days: int, reference_end: Column, outcome_days: int = WINDOW_DAYS) -> DataFrame:
    """(d, start, stop, observable, n_rows): each date's scoring window [start, stop), whether the outcomes of all that stop in
    it have been observed by the reference end, and how many rows stop in it."""
    at = dates.select("d", F.date_sub("d", window_days - 1).cast("timestamp_ntz").alias("start"), F.date_add("d", 1).cast("timestamp_ntz").alias("stop"))
    hits = in_windows(rows.select("index_stop"), "index_stop", dates.select("d"), window_days - 1).groupBy("d").agg(F.count("*").alias("n_rows"))
    seen = (F.col("stop") <= reference_end - days(outcome_days)).alias("observable")
    return at.join(hits, "d", "left").select("d", "start", "stop", seen, F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def ranked(rows: DataFrame, by: str, score: str, key: str, land: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, ... by descending score (nulls last) within ``by``, ties by ``key``.

    Rows are sorted across tasks by (by, score, key), so a group of any size lies in many of them; a row's rank is its
    place in its task, less the group's first place there, plus the group's rows in earlier tasks. ``land`` must write
    the frame and read it back, so that places stay what they are.
    """
    order = (F.col(by).asc(), F.desc(score), F.col(key).asc())
    # the id of a row is its task's number above 33 bits, and its place below
    dealt = land(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()))
    task = F.shiftright("_place", 33)
    parts = dealt.groupBy(by, task.alias("_task")).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))  # tasks plus groups, at most
    earlier = F.coalesce(F.sum("_n").over(W.partitionBy(by).orderBy("_task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col(by).alias("_by"), "_task", "_first", earlier.alias("_earlier"))
    joined = dealt.join(parts, F.col(by).eqNullSafe(F.col("_by")) & (task == F.col("_task")))
    return joined.withColumn("rank", (F.col("_place") - F.col("_first") + F.col("_earlier") + 1).cast("int")).drop("_place", *parts.columns)


def require_observable(stop: Column, reference_end: Column, outcome_days: int = WINDOW_DAYS) -> Column:
    """``stop``, or an error at run time where a window ends after the observation horizon."""
    message = F.concat(F.lit("window ends past the observation horizon: "), stop.cast("string"))
    return F.when(stop <= reference_end - days(outcome_days), stop).otherwise(F.raise_error(message))


def label_free(rows: DataFrame) -> DataFrame:
    """``rows`` without the columns that only become known after a stay."""
    return rows.drop(*LABEL_SIDE)


def require_label_free(rows: DataFrame) -> DataFrame:
    """``rows``, refused if they hold such a column."""
    found = [c for c in LABEL_SIDE if c in rows.columns]
    if found:
        raise ValueError(f"label-side columns in a scoring input: {found}")
    return rows


def with_labels(rows: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """``rows`` with their labels; a row without one stops the query."""
    message = F.concat(F.lit("no label for "), F.col(key).cast("string"))
    given = F.when(F.col(label).isNotNull(), F.col(label)).otherwise(F.raise_error(message).cast(dict(labels.dtypes)[label]))
    return rows.join(labels, key, "left").withColumn(label, given)


def require_held_out(gate: DataFrame) -> None:
    """Refuses a window whose ``gate`` (one row of counts, see ``split.held_out_window``) forbids its use."""
    n = gate.first().asDict()
    wrong = [f"{k} = {n[k]}" for k in ("n_train", "n_unassigned", "n_duplicate") if n[k]]
    if not n["n_rows"] or wrong:
        raise ValueError("held-out window refused: " + (", ".join(wrong) or "it is empty"))
