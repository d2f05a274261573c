"""Declarative table assertions: a rule that is false or null on a row counts against it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def bad(condition: Column) -> Column:
    """Rows on which a condition doesn't hold; a null doesn't hold."""
    return F.count_if(~F.coalesce(condition, F.lit(False)))


def constant(column: str) -> Column:
    """1 if a column is not one non-null value throughout."""
    return F.when((F.countDistinct(column) == 1) & (F.count_if(F.col(column).isNull()) == 0), 0).otherwise(1).cast("long")


def run(frame: DataFrame, rules: Mapping[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, rule, n_bad, passed) from one pass over ``frame``; ``rules`` map names to aggregates that must be 0."""
    counted = frame.groupBy(*by).agg(*(F.coalesce(c.cast("long"), F.lit(1)).alias(n) for n, c in rules.items()))
    named = F.array(*(F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("n_bad")) for n in rules))
    return counted.select(*by, F.explode(named).alias("x")).select(*by, "x.rule", "x.n_bad", (F.col("x.n_bad") == 0).alias("passed"))


def verdict(results: DataFrame) -> DataFrame:
    """One row (passed, first_failure): rules are judged in the order of their names."""
    return results.agg(F.min("passed").alias("passed"), F.min(F.when(~F.col("passed"), F.col("rule"))).alias("first_failure"))


def not_increasing(frame: DataFrame, by: tuple[str, ...], place: str, value: str, width: int = 65_536) -> DataFrame:
    """(*by, n_bad): the places of each group whose values aren't all at or below those of the place before it.

    A null value is bad unless the place before it has none, too; places may have gaps or several rows. Places are
    compared in ranges of ``width``, and each range with the end of the one before, so no group lies in one task and
    a place that all rows share is aggregated before it is compared. A null place comes before all others.
    """
    one = frame.groupBy(*by, place).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count_if(F.col(value).isNull()).alias("nulls"))
    one = one.withColumn("_range", F.coalesce(F.floor(F.col(place) / width), F.lit(-(2**62))))
    inside = one.withColumn("_before", F.lag("lo").over(W.partitionBy(*by, "_range").orderBy(place))).withColumn("_first", F.row_number().over(W.partitionBy(*by, "_range").orderBy(place)) == 1)
    # ends of ranges: a row for each ``width`` places
    ends = one.withColumn("_at", F.struct(F.col(place).isNotNull(), place)).groupBy(*by, "_range").agg(F.max_by(F.struct("lo"), "_at").alias("_end"))
    ends = ends.withColumn("_end", F.lag("_end").over(W.partitionBy(*by).orderBy("_range"))["lo"])
    same = [F.col(f"i.{c}").eqNullSafe(F.col(f"e.{c}")) for c in (*by, "_range")]
    both = inside.alias("i").join(ends.alias("e"), same, "left").select("i.*", "e._end")
    before = F.when(F.col("_first"), F.col("_end")).otherwise(F.col("_before"))
    wrong = before.isNotNull() & ((F.col("nulls") > 0) | (F.col("hi") > before))
    return both.groupBy(*by).agg(F.count_if(wrong).alias("n_bad"))
