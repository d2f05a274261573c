"""Scores from stored parameters against the fitted model and plain Python."""

import math

import pytest
from pyspark.sql import functions as F

from epochal.operators import models, parameters

VALUES = ["a"] * 40 + ["b"] * 30 + ["z"] * 3 + [None] * 7


def rows(spark, n=80):
    return spark.createDataFrame([(i, float(i * i % 11), None if i % 13 == 0 else float(i % 7), VALUES[i % 80], i % 2 and "m" or "f", int(i * 31 % 17 < 6)) for i in range(n)], "id long, k double, x double, c string, g string, y int")


def stored(frame, path):
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def test_the_table_of_a_fitted_model_scores_as_it_does(spark, tmp_path):
    train, other = rows(spark), rows(spark, 90).withColumn("c", F.when(F.col("id") % 4 == 0, "unseen").otherwise(F.col("c"))).withColumn("g", F.when(F.col("id") % 9 == 0, "unseen").otherwise(F.col("g")))
    ready = lambda f: models.standardize(train, f, ("k",), ("x",)).na.fill(0.0, ["k", "x"]).withColumn("y", F.col("y").cast("double"))
    fitted = models.fit_logistic(ready(train), ("k", "x"), ("c", "g"), "y")
    table = stored(parameters.fitted_parameters(fitted, parameters.scaling(train, ("k",), ("x",)), ("k", "x"), ("c", "g")), f"file://{tmp_path}/p")
    assert {(r["column"], r["category"]) for r in table.where("kind = 'category'").collect()} == {("c", "a"), ("c", "b"), ("c", models.RARE), ("g", "f"), ("g", "m")}
    want = {r["id"]: r["risk_score"] for r in models.score_logistic(fitted, ready(other), "id").collect()}
    got = {r["id"]: r["s"] for r in other.select("id", parameters.score(table).alias("s")).collect()}
    assert len(want) == 90 and max(abs(got[i] - want[i]) for i in want) < 1e-9


def test_weights_of_evidence(spark):
    data = [r.asDict() for r in rows(spark).collect()]
    table = {(r["kind"], r["column"], r["category"]): r for r in parameters.evidence_parameters(rows(spark), "y", ("k",), ("x",), ("c", "g")).collect()}
    odds = lambda found: math.log((sum(r["y"] for r in found) + 0.5) / (sum(1 - r["y"] for r in found) + 0.5))
    base = odds(data)
    assert table["intercept", None, None]["coefficient"] == pytest.approx(base)
    for value, members in (("a", "a"), ("b", "b"), (models.RARE, "z")):
        assert table["category", "c", value]["coefficient"] == pytest.approx(odds([r for r in data if r["c"] == members]) - base)
    k = [math.log1p(r["k"]) for r in data]
    mean, my = sum(k) / 80, sum(r["y"] for r in data) / 80
    dev = math.sqrt(sum((v - mean) ** 2 for v in k) / 80)
    r = table["count", "k", None]
    assert (r["mean"], r["deviation"]) == (pytest.approx(mean), pytest.approx(dev))
    assert r["coefficient"] == pytest.approx(sum((v - mean) / dev * (x["y"] - my) for v, x in zip(k, data, strict=True)) / 80)
    assert len(table) == 1 + 2 + 3 + 2


def test_constants_and_empty_tables(spark):
    same = rows(spark).withColumn("k", F.lit(3.0))
    r = parameters.scaling(same, ("k",), ()).first()
    assert (r["deviation"], r["mean"]) == (1.0, pytest.approx(math.log(4)))
    empty = parameters.evidence_parameters(rows(spark).where("false"), "y", ("k",), (), ("c",))
    with pytest.raises(ValueError, match="not a table of parameters"):
        parameters.score(empty)  # means of no rows


@pytest.mark.parametrize("lines", [
    [], [("intercept", None, None, None, None, None)], [("intercept", None, None, None, None, 1.0)] * 2, [("intercept", None, None, None, None, 1.0), ("other", "k", None, 0.0, 1.0, 1.0)],
    [("intercept", None, None, None, None, 1.0), ("number", "k", None, 0.0, 0.0, 1.0)], [("intercept", None, None, None, None, 1.0), ("category", "c", None, None, None, 1.0)],
    [("intercept", None, None, None, None, 1.0), ("count", "k", None, 0.0, 1.0, 1.0), ("number", "k", None, 0.0, 1.0, 1.0)],
])
def test_bad_tables_are_refused(spark, lines):
    with pytest.raises(ValueError, match="not a table of parameters"):
        parameters.score(spark.createDataFrame(lines, parameters.PARAMETERS))


def test_unknown_values(spark):
    lines = [("intercept", None, None, None, None, 0.0), ("category", "c", "a", None, None, 2.0)]
    at = lambda more: {r["c"]: r["s"] for r in rows(spark).select("c", parameters.score(spark.createDataFrame(lines + more, parameters.PARAMETERS)).alias("s")).distinct().collect()}
    assert at([])[None] == at([])["b"] == 0.5 and at([])["a"] == pytest.approx(1 / (1 + math.exp(-2)))
    rare = at([("category", "c", models.RARE, None, None, -1.0)])
    assert rare[None] == rare["b"] == pytest.approx(1 / (1 + math.exp(1)))
