"""Boundary rows of the interval, look-back, split, evaluation and assertion operators."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from epochal.functions.poisson import garwood
from epochal.operators import assertions, evaluate, fingerprint, intervals, lookback, split

STAY = "id long, entity long, start timestamp_ntz, stop timestamp_ntz, class string"
PROCEDURE = "encounter long, code string, start timestamp_ntz, stop timestamp_ntz"


def at(text):
    return datetime.fromisoformat(text)


def stays(spark, *rows):
    return spark.createDataFrame([(i, e, at(a), at(b) if b else None, "inpatient") for i, e, a, b in rows], STAY)


def flags(spark, *rows, planned=()):
    p = spark.createDataFrame([(i, "3", at("2000-01-01"), None) for i in planned], PROCEDURE)
    return intervals.flag_stays(stays(spark, *rows), p, ("3",))


def labels(spark, *rows, **kw):
    f = flags(spark, *rows, **kw)
    c = intervals.index_candidates(f)
    plain = {r["id"]: r["label"] for r in intervals.outcome(c, f).collect()}
    assert plain == {r["id"]: int(r["last_start"] is not None) for r in intervals.last_start(c, f).collect()}
    return plain


def test_start_at_earlier_stop_continues(spark):
    f = {r["id"]: r for r in flags(spark, (1, 1, "2000-01-01", "2000-01-05"), (2, 1, "2000-01-05", "2000-01-06")).collect()}
    assert f[2]["is_continuation"] and not f[1]["is_continuation"]
    assert not f[1]["is_terminal"]


def test_longest_earlier_stay_counts_not_the_last(spark):
    f = {r["id"]: r for r in flags(spark, (1, 1, "2000-01-01", "2000-02-01"), (2, 1, "2000-01-02", "2000-01-03"), (3, 1, "2000-01-20", "2000-03-01")).collect()}
    assert f[3]["is_continuation"]


def test_window_bounds(spark):
    assert labels(spark, (1, 1, "2000-01-01", "2000-01-02"), (2, 1, "2000-02-01", "2000-02-02"))[1] == 1  # exactly 30 days
    assert labels(spark, (1, 1, "2000-01-01", "2000-01-02"), (2, 1, "2000-02-01T00:00:01", "2000-02-02"))[1] == 0
    assert labels(spark, (1, 1, "2000-01-02", "2000-01-02"), (2, 1, "2000-01-02", "2000-01-02"))[1] == 0  # exactly at the stop


def test_open_stay_is_an_outcome_but_no_candidate(spark):
    assert labels(spark, (1, 1, "2000-01-01", "2000-01-02"), (2, 1, "2000-01-10", None)) == {1: 1}


def test_entities_and_planned_stays_are_apart(spark):
    assert labels(spark, (1, 1, "2000-01-01", "2000-01-02"), (2, 2, "2000-01-10", "2000-01-11"))[1] == 0
    assert labels(spark, (1, 1, "2000-01-01", "2000-01-02"), (2, 1, "2000-01-10", "2000-01-11"), planned=(2,)) == {1: 0}


def test_observable(spark):
    rows = spark.createDataFrame([(1, 1, at("2000-03-01"), 0), (2, 2, at("2000-03-01"), 1), (3, 3, at("2000-03-01"), 0), (4, 3, at("2000-07-01"), 0)], "id long, entity long, deadline timestamp_ntz, label int")
    people = spark.createDataFrame([(1, date(2000, 3, 1)), (2, date(2000, 1, 1)), (3, None)], "id long, death date")
    kept = intervals.observable(rows, people, F.lit("2000-07-01").cast("timestamp_ntz"))
    assert sorted(r["id"] for r in kept.collect()) == [2, 3]  # death at the deadline and a deadline at the end are out


def test_horizon_of_open_and_planned_stays(spark):
    f = flags(spark, (1, 1, "2000-01-01", "2000-01-02"), (2, 1, "2000-01-10", None))
    out = intervals.label_horizon(intervals.index_candidates(f), f, F.lit("2001-07-01").cast("timestamp_ntz"))
    assert out.first()["label_horizon"] == at("2001-07-01")


def test_look_back_bounds(spark):
    index = spark.createDataFrame([(1, 1, at("2004-02-29T10:00:00"))], "id long, entity long, start timestamp_ntz")
    facts = spark.createDataFrame([(1, at("2003-02-28")), (1, at("2003-02-27T23:59:59")), (1, at("2004-02-29T10:00:00")), (2, at("2003-06-01"))], "entity long, start timestamp_ntz")
    counted = lookback.counts(index, lookback.started(facts, "n"), ("n",))
    assert counted.first()["n"] == 1


def test_same_day_codes(spark):
    index = spark.createDataFrame([(1, 1, at("2004-03-01T10:00:00"))], "id long, entity long, start timestamp_ntz")
    facts = spark.createDataFrame([(1, "a", at("2004-03-01"), None), (1, "b", at("2004-02-01"), at("2003-01-01")), (1, "c", at("2004-02-01"), None)], "entity long, code string, start timestamp_ntz, stop timestamp_ntz")
    count = lambda by_day: lookback.counts(index, lookback.active_codes(facts, "n", by_day), ("n",)).first()["n"]
    assert (count(True), count(False)) == (1, 2)


def test_auc_ties_and_one_class(spark):
    rows = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, p double")
    assert evaluate.auc(rows, "y", "p").first()["auc"] == pytest.approx(0.875)
    assert evaluate.auc(rows.where("y = 1"), "y", "p").first()["auc"] is None


def test_constant_scores_make_one_bin(spark):
    rows = spark.createDataFrame([(1, 0.2), (0, 0.2), (0, 0.2)], "y int, p double")
    curve = evaluate.calibration(rows, "y", "p")
    assert [r["n"] for r in curve.collect()] == [3]


@pytest.mark.parametrize(("k", "low", "high"), [(0, 0.0, 3.6889), (1, 0.0253, 5.5716), (10, 4.7954, 18.3904)])
def test_garwood(k, low, high):
    assert garwood(k) == pytest.approx((low, high), abs=1e-4)


def test_null_counts_as_failure(spark):
    rows = spark.createDataFrame([(1,), (None,)], "x int")
    assert assertions.run(rows, {"R": assertions.bad(F.col("x") == 1)}).first()["n_bad"] == 1


def test_fingerprint_ignores_order_but_not_duplicates(spark):
    rows = spark.createDataFrame([(1, "a", 0.1), (2, None, -0.0)], "i int, s string, d double")
    one = fingerprint.fingerprint(rows).first()["fingerprint"]
    assert one == fingerprint.fingerprint(rows.repartition(3).orderBy(F.desc("i"))).first()["fingerprint"]
    assert one != fingerprint.fingerprint(rows.unionByName(rows)).first()["fingerprint"]


def test_split_reasons(spark):
    rows = [(1, 1, "2000-02-01", "2000-02-02", "2000-03-03"), (2, 1, "1999-01-01", "1999-01-02", "1999-02-01"), (3, 2, "1999-12-01", "1999-12-02", "2000-01-01"), (4, 3, "1999-01-01", "1999-01-02", "2000-01-01"), (5, 4, "1999-01-01", "1999-01-02", "1999-02-01"), (6, 5, "2001-06-01", "2001-06-02", "2001-07-02")]
    gold = spark.createDataFrame([(i, e, *map(at, t)) for i, e, *t in rows], "encounter_id long, patient_id long, index_start timestamp_ntz, index_stop timestamp_ntz, label_horizon timestamp_ntz")
    t = lambda x: F.lit(x).cast("timestamp_ntz")
    found = {r["encounter_id"]: r["partition"] for r in split.chronological_split(gold, t("2000-01-01"), t("2001-07-01")).collect()}
    assert found == {1: "test", 2: "patient_overlap", 3: "label_window", 4: "label_horizon", 5: "train", 6: "censored"}


def shifted(d, years):
    """add_months(d, 12 * years): the same day, or the month's last."""
    try:
        return d.replace(year=d.year + years)
    except ValueError:
        return d.replace(year=d.year + years, day=28)


def test_time_lines_against_pairwise_comparison(spark):
    """Flags, labels, horizons and counts of a busy entity (many chunks, ties, open and zero-length stays) and others."""
    rnd = random.Random(4)
    day = lambda: datetime(1999, 1, 1) + timedelta(days=rnd.randrange(1200), hours=rnd.choice((0, 0, 7)))
    rows = []
    for i in range(260):
        start = day()
        rows.append((i, 1 if i < 180 else rnd.randrange(2, 9), start, None if rnd.random() < 0.05 else start + timedelta(days=rnd.choice((0, 1, 2, 3, 30, 400)) if rnd.random() < 0.3 else 0), rnd.choice(("inpatient", "inpatient", "emergency"))))
    frame = spark.createDataFrame(rows, STAY)
    planned = [(i, "3", day(), None) for i in range(0, 260, 17)]
    end = datetime(2002, 6, 1)
    flagged = intervals.flag_stays(frame, spark.createDataFrame(planned, PROCEDURE), ("3",), reference_end=F.lit(str(end)).cast("timestamp_ntz")).cache()
    own = sorted((r for r in rows if r[4] == "inpatient"), key=lambda r: (r[2], r[0]))
    until = {i: t for i, _, t, _ in planned}
    want = {}
    for i, e, start, stop, _ in own:
        before = [s for j, f, b, s, _ in own if f == e and (b, j) < (start, i) and s]
        cover = any(f == e and j != i and b <= stop and s and s > stop for j, f, b, s, _ in own) if stop else False
        want[i] = (i in until, bool(before) and start <= max(before), not cover, max(before, default=None))
    got = {r["id"]: (r["is_planned"], r["is_continuation"], r["is_terminal"], r["prev_max_stop"]) for r in flagged.collect()}
    assert got == want

    candidates = intervals.index_candidates(flagged)
    labels = {r["id"]: r["label"] for r in intervals.outcome(candidates, flagged).collect()}
    horizons = {r["id"]: r["label_horizon"] for r in intervals.label_horizon(candidates, flagged, F.lit(str(end)).cast("timestamp_ntz")).collect()}
    for i, e, _, stop, _ in own:
        if stop is None or want[i][0] or not want[i][2]:
            assert i not in labels
            continue
        ahead = [r for r in own if r[1] == e and r[0] != i and stop < r[2] <= stop + timedelta(days=30)]
        assert labels[i] == any(not want[r[0]][0] and not want[r[0]][1] for r in ahead)
        held = [x for r in ahead for x in (r[2], r[3] or end, want[r[0]][3], until.get(r[0])) if x]
        assert horizons[i] == max([stop + timedelta(days=30), *held])

    facts = [(1 if k < 200 else rnd.randrange(2, 9), rnd.choice("abcdef"), b, None if rnd.random() < 0.05 else b + timedelta(days=rnd.choice((-3, 0, 5, 300)))) for k in range(320) for b in [day()]]
    coded = spark.createDataFrame(facts, "entity long, code string, start timestamp_ntz, stop timestamp_ntz")
    index = spark.createDataFrame([(i, e, t) for i, e, t, _, _ in rows] + [(900 + k, 1, datetime(*d)) for k, d in enumerate(((2000, 2, 29), (2001, 2, 28, 5), (2001, 3, 1), (2000, 3, 1)))], "id long, entity long, start timestamp_ntz")
    roles = {"stays": frame, "conditions": coded, "careplans": coded, "medications": coded, "procedures": coded.select("entity", "start"), "observations": coded.select("entity", "start")}
    counted = {r["id"]: r for r in lookback.all_counts(index, roles).collect()}
    assert len(counted) == index.count()
    for i, e, t in index.collect():
        ws = datetime.combine(shifted(t.date(), -1), datetime.min.time())
        stays_in = [r for r in rows if r[1] == e and ws <= r[2] < t and r[3] and r[3] <= t]
        active = lambda before: len({c for f, c, b, s in facts if f == e and before(b) and (s is None or s >= ws)})  # noqa: E731, B023
        r = counted[i]
        assert (r["prior_encounter_count"], r["prior_inpatient_count"]) == (len(stays_in), sum(x[4] == "inpatient" for x in stays_in))
        assert r["procedure_count_window"] == r["observation_count_window"] == sum(f == e and ws <= b < t for f, _, b, _ in facts)
        assert r["active_medication_count"] == active(lambda b: b < t)  # noqa: B023
        # by day, both ends are dates
        by_day = len({c for f, c, b, s in facts if f == e and b.date() < t.date() and (s is None or s >= ws)})
        assert r["active_condition_count"] == r["active_careplan_count"] == by_day
