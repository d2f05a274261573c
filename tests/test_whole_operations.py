"""Every date, every rule and every population check."""

import pytest
from pyspark.sql import functions as F

from epochal.plans import operations, registry

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def p(spark):
    return registry.Plans(spark, SMALL)


def test_a_bad_date_fails_and_is_not_published(p):
    other = F.col("as_of_date") == F.lit("2000-08-07").cast("date")
    rows = p.predictions.withColumn("risk_score", F.when(other, 2.0).otherwise(F.col("risk_score")))
    failed = {(str(r["as_of_date"]), r["rule"]) for r in operations.prediction_verdicts(rows).where("not passed").collect()}
    before = {(str(r["as_of_date"]), r["rule"]) for r in operations.prediction_verdicts(p.predictions).where("not passed").collect()}
    assert failed - before == {("2000-08-07", "PRED-04")}
    served = {str(r["as_of_date"]) for r in operations.publish_predictions(p, rows).select("as_of_date").distinct().collect()}
    assert "2000-08-07" not in served and "2000-05-01" in served


def test_every_mutation_fires_its_rule(p):
    got = {r["mutation"]: r["fired"].split(",") for r in operations.dq_mutations_all(p).collect()}
    rules = operations.gold_rules(p.metadata) | operations.prediction_rules() | operations.run_rules() | operations.tick_rules()
    assert set(rules) | {"GOLD-07", "PRED-07"} == {m for m in got if not m.startswith("clean")}
    for m, fired in got.items():
        if m == "PRED-01":  # an empty table has no ranks and no constants either
            assert m in fired
        else:
            assert fired == ([""] if m.startswith("clean") else [m])


def test_population_checks_are_whole(p):
    got = {r["check_name"]: r["status"] for r in operations.population_checks_all(p).collect()}
    assert {"ids", "posthumous", "power", "label", "structure", "latest", "horizon", "disjoint"} <= set(got)
    assert got["disjoint"] == got["horizon"] == "PASS"


@pytest.mark.parametrize("name", ["predictions", "preflight", "run_window", "cohort_eval"])
def test_windows_are_joined_by_day(p, monkeypatch, capsys, name):
    """No row is compared with dates that it isn't in: neither of the plans has a nested loop."""
    from epochal.plans import QUERIES

    joined, plans, land = ("predictions", "hits", "cohorts"), [], registry.Plans.landed

    def spy(self, table, frame):
        if table in joined:
            plans.append(frame())
        return land(self, table, frame)

    monkeypatch.setattr(registry, "_LANDED", {k: v for k, v in registry._LANDED.items() if k[2] not in joined})
    monkeypatch.setattr(registry.Plans, "landed", spy)
    for frame in (QUERIES[name](p.spark, SMALL), *plans):
        frame.explain()
    shown = capsys.readouterr().out
    assert "BroadcastHashJoin" in shown
    assert all("Cross" in line for line in shown.splitlines() if "NestedLoop" in line)  # the one row of score ranges that the ranked metrics use


def test_days_of_windows(spark):
    """Windows that overlap, touch, or leave days out; instants at midnight and just before."""
    from datetime import date, datetime, timedelta

    from epochal.operators import scoring

    dates = [date(2000, 3, 1), date(2000, 3, 3), date(2000, 3, 20)]
    rows = [(i, datetime(2000, 2, 20) + timedelta(hours=7 * i)) for i in range(120)] + [(500, datetime(2000, 3, 2)), (501, datetime(2000, 3, 1, 23, 59, 59)), (502, None)]
    frame = spark.createDataFrame(rows, "id long, at timestamp_ntz")
    for back, until in ((6, 0), (0, 0), (9, 4)):
        got = {(r["id"], r["d"]) for r in scoring.in_windows(frame, "at", spark.createDataFrame([(d,) for d in dates], "d date"), back, until).collect()}
        assert got == {(i, d) for i, t in rows for d in dates if t and d - timedelta(days=back) <= t.date() <= d - timedelta(days=until)}


def test_one_date_of_the_sheet_opens_its_own_files(p, capsys):
    operations.landed_sheet(p).where("as_of_date = date'2000-05-01'").explain()
    shown = capsys.readouterr().out
    assert "2000-05-01" in shown.partition("PartitionFilters: ")[2].split("PushedFilters")[0]


def test_mismatches(spark):
    """Equal, near, off, null, missing, extra and repeated rows; tables without rows."""
    from epochal.operators.fingerprint import mismatches

    kind = "d string, k long, x double, s string"
    wanted = spark.createDataFrame([("a", 1, 0.5, "u"), ("a", 2, None, None), ("a", 3, 0.5, "u"), ("b", 1, 0.5, "u"), ("b", 2, 0.5, "u"), (None, 1, 0.5, "u")], kind)
    found = spark.createDataFrame([("a", 1, 0.5 + 1e-9, "u"), ("a", 2, None, None), ("a", 3, None, "u"), ("b", 1, 0.5, None), ("b", 3, 0.5, "u"), ("b", 3, 0.5, "u")], kind)
    got = {r["d"]: tuple(r)[1:] for r in mismatches(found, wanted, "d", "k").collect()}
    assert got == {"a": (3, 3, 0, 0, 1), "b": (3, 2, 1, 1, 1), None: (0, 1, 1, 0, 0)}
    assert mismatches(wanted, wanted.where("false"), "d", "k").agg(F.sum("n_extra")).first()[0] == 6
    twice = wanted.where("d = 'a'").unionByName(wanted.where("d = 'a'"))
    assert mismatches(twice, wanted.where("d = 'a'"), "d", "k").first()["n_different"] == 3
