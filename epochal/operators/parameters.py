"""Scores from a stored table of parameters: any logistic model becomes one table, and the table one expression.

A row is ``intercept``; ``number`` or ``count`` (a column, its mean, deviation and coefficient; counts enter as
log1p); or ``category`` (a column, a value and its coefficient; the rare value stands for every value that has no
row, and without a row for it those have no coefficient). Null numbers are at their mean, as in the fitted models.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .models import RARE

PARAMETERS = "kind string, column string, category string, mean double, deviation double, coefficient double"
MOST = 100_000


def scaling(train: DataFrame, counts: tuple[str, ...], others: tuple[str, ...], *more) -> DataFrame:
    """(kind, column, mean, deviation, ...) of each number, from one pass; a constant column has the deviation 1.

    ``more`` are (name, function of the value's expression and its deviation's) that give further aggregates.
    """
    rows = []
    for c in (*counts, *others):
        x = F.log1p(c) if c in counts else F.col(c)
        s = F.when(F.stddev_pop(x) > 0, F.stddev_pop(x)).otherwise(1.0)
        made = [f(x, s).alias(n) for n, f in more]
        rows.append(F.struct(F.lit("count" if c in counts else "number").alias("kind"), F.lit(c).alias("column"), F.avg(x).alias("mean"), s.alias("deviation"), *made))
    return train.agg(F.array(*rows).alias("x")).select(F.inline("x"))


def fitted_parameters(model, scaled: DataFrame, numbers: tuple[str, ...], categories: tuple[str, ...]) -> DataFrame:
    """The parameter table of ``models.fit_logistic``'s pipeline, whose numbers were standardised as ``scaled`` (of
    :func:`scaling`) says."""
    spark, fit = scaled.sparkSession, model.stages[-1]
    weights, at = fit.coefficients.toArray().tolist(), len(numbers)
    rows = [("intercept", None, None, None, None, float(fit.intercept))]
    for c, stage in zip(categories, model.stages[1 : 1 + len(categories)], strict=True):  # a place for each value the indexer knows
        rows += [("category", c, v, None, None, weights[at + i]) for i, v in enumerate(stage.labels)]
        at += len(stage.labels)
    if at != len(weights):
        raise ValueError(f"{len(weights)} coefficients for {at} places")
    given = spark.createDataFrame([(c, weights[i]) for i, c in enumerate(numbers)], "column string, coefficient double")
    lines = scaled.join(F.broadcast(given), "column").select("kind", "column", F.lit(None).cast("string").alias("category"), "mean", "deviation", "coefficient")
    return lines.unionByName(spark.createDataFrame(rows, PARAMETERS))


def evidence_parameters(train: DataFrame, label: str, counts: tuple[str, ...], others: tuple[str, ...], categories: tuple[str, ...], least: int = 20) -> DataFrame:
    """A scorecard without iterations: weights of evidence as coefficients.

    A value with at least ``least`` rows has the log odds of its rows, less those of all rows; all other values of a
    column together are the rare one. A number has the covariance of label and standardised value. The intercept is
    the log odds of all rows; half a row is added to each class everywhere.
    """
    y = F.col(label).cast("double")
    odds = lambda pos, n: F.log((pos + 0.5) / (n - pos + 0.5))
    base = train.agg(odds(F.coalesce(F.sum(y), F.lit(0.0)), F.count("*")).alias("base"))  # one row
    numbers = scaling(train, counts, others, ("coefficient", lambda x, s: F.covar_pop(x, y) / s))
    long = train.select(y.alias("y"), F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in categories))).alias("x")).select("y", "x.*")
    by = long.where("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"), F.sum("y").alias("pos"))
    by = by.groupBy("column", F.when(F.col("n") >= least, F.col("value")).otherwise(RARE).alias("category")).agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    by = by.crossJoin(F.broadcast(base)).select(F.lit("category").alias("kind"), "column", "category", (odds(F.col("pos"), F.col("n")) - F.col("base")).alias("coefficient"))
    return numbers.unionByName(by, allowMissingColumns=True).unionByName(base.select(F.lit("intercept").alias("kind"), F.col("base").alias("coefficient")), allowMissingColumns=True)


def score(table: DataFrame) -> Column:
    """The probability that a parameter table gives, as one expression over the raw columns; a bad table is refused."""
    lines = table.select("kind", "column", "category", "mean", "deviation", "coefficient").limit(MOST + 1).collect()  # a row for each parameter of a model
    if len(lines) > MOST:
        raise ValueError(f"more than {MOST} parameters")
    seen = {(r["kind"] == "category", r["column"], r["category"]) for r in lines}
    bad = [r for r in lines if r["kind"] not in ("intercept", "number", "count", "category") or r["coefficient"] is None or (r["kind"] != "intercept" and r["column"] is None)]
    bad += [r for r in lines if r["kind"] in ("number", "count") and (r["mean"] is None or not (r["deviation"] or 0) > 0)]
    bad += [r for r in lines if r["kind"] == "category" and r["category"] is None]
    if bad or len(seen) < len(lines) or sum(r["kind"] == "intercept" for r in lines) != 1:
        raise ValueError(f"not a table of parameters: {bad[:3] or 'a parameter is given twice, or there is not one intercept'}")
    terms, values = [], {}
    for r in sorted(lines, key=lambda r: (r["kind"], r["column"] or "", r["category"] or "")):
        if r["kind"] == "intercept":
            terms.append(F.lit(r["coefficient"]))
        elif r["kind"] == "category":
            values.setdefault(r["column"], {})[r["category"]] = r["coefficient"]
        else:
            x = F.log1p(r["column"]) if r["kind"] == "count" else F.col(r["column"])
            terms.append(F.coalesce((x - r["mean"]) / r["deviation"], F.lit(0.0)) * r["coefficient"])
    for c, found in values.items():
        rest = F.lit(found.pop(RARE, 0.0))
        known = F.create_map(*map(F.lit, chain.from_iterable(found.items())))[F.col(c).cast("string")] if found else F.lit(None).cast("double")
        terms.append(F.coalesce(known, rest))
    z = terms[0]
    for t in terms[1:]:
        z = z + t
    return 1 / (1 + F.exp(-z))
