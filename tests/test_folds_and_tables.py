"""Balanced entity folds, isotonic calibration, and tables that differ in content or only in their last bits."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from epochal.operators import fingerprint, models, split, timeline


@pytest.mark.parametrize("chunk", [16_384, 40])
def test_balanced_folds_keep_entities_whole(spark, monkeypatch, chunk):
    """Many entities of one size, large ones, rows without an entity; also where a size is scanned in chunks."""
    monkeypatch.setattr(timeline, "CHUNK_ROWS", chunk)
    rnd = random.Random(5)
    sizes = [1] * 400 + [rnd.randint(2, 9) for _ in range(150)] + [60, 45, 45]
    rows = [(e, i) for e, n in enumerate(sizes) for i in range(n)] + [(None, 0), (None, 1)]
    got = split.balanced_folds(spark.createDataFrame(rows, "patient_id long, i long").repartition(4), 5).collect()
    assert len(got) == len(rows)
    folds = {}
    for r in got:
        folds.setdefault(r["patient_id"], set()).add(r["fold"])
    assert folds.pop(None) == {None} and all(len(f) == 1 for f in folds.values())
    loads = [sum(r["fold"] == f for r in got) for f in range(5)]
    assert max(loads) - min(loads) <= 1 and max(loads) <= 1.05 * min(loads)


def test_sizes_are_dealt_as_one_by_one():
    rnd = random.Random(7)
    for k in (1, 2, 5):
        sizes = [(n, rnd.randint(1, 40)) for n in rnd.sample(range(1, 60), 8)]
        loads, want = [0] * k, {}
        for n, m in sorted(sizes, reverse=True):
            want[n] = [0] * k
            for _ in range(m):
                f = min(range(k), key=lambda f: (loads[f], f))
                loads[f] += n
                want[n][f] += 1
        assert dict(split._deal(sizes, k)) == want


def test_folds_of_no_rows(spark):
    assert split.balanced_folds(spark.createDataFrame([], "patient_id long, i long"), 5).collect() == []


def test_one_class_folds_are_refused(spark):
    frame = lambda *rows: spark.createDataFrame([*rows], "fold int, label double")
    good = [(f, y) for f in (0, 1) for y in (0.0, 1.0)]
    split.require_folds(frame(*good), "fold", "label", 2)
    for rows, message in (([*good, (None, 1.0)], "1 rows are in no fold"), ([*good, (2, 1.0)], "in no fold"), ([(0, 0.0), (0, 1.0), (1, 1.0)], "fold 0 has"), (good[:2], "fold 0 has 1 positive of 2")):
        with pytest.raises(ValueError, match=message):
            split.require_folds(frame(*rows), "fold", "label", 2)
    with pytest.raises(ValueError, match="two classes"):
        models.fit_boosted(frame((0, 0.0), (1, 1.0)).withColumn("x", F.lit(1.0)), ("x",), (), "label", "fold", folds=2, rounds=1)


def pooled(x, y):
    """Adjacent violators, one by one, on distinct scores."""
    blocks = []
    for v in sorted(set(x)):
        own = [b for a, b in zip(x, y, strict=True) if a == v]
        blocks.append([[v], sum(own), len(own)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2] + last[2]]
    return [v for b in blocks for v in b[0]], [b[1] / b[2] for b in blocks for _ in b[0]]


def test_isotonic_equals_pooling_one_by_one(spark):
    """Tied scores, scores between and outside the fitted ones."""
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=600), 1)
    y = (rng.random(600) < 1 / (1 + np.exp(-x))).astype(float)
    model = models.fit_isotonic(spark.createDataFrame(list(zip(x.tolist(), y.tolist(), strict=True)), "margin double, label double").repartition(6), "margin", "label")
    asked = [-9.0, 9.0, *np.round(rng.normal(size=200), 2).tolist()]
    got = {r["margin"]: r["calibrated"] for r in model.transform(spark.createDataFrame([(v,) for v in asked], "margin double")).collect()}
    px, pf = pooled(x.tolist(), y.tolist())
    assert all(got[v] == pytest.approx(np.interp(v, px, pf), abs=1e-9) for v in asked)


def test_boosted_with_isotonic_calibration(spark):
    rows = [(i, i % 5, float(i % 7), "a" if i % 3 else "b", float(i % 7 > 3)) for i in range(200)]
    frame = spark.createDataFrame(rows, "id long, fold int, x double, c string, label double").cache()
    fitted = models.fit_boosted(frame, ("x",), ("c",), "label", "fold", rounds=2, method="isotonic")
    got = {r["id"]: r["risk_score"] for r in models.score_boosted(fitted, frame, "id").collect()}
    assert len(got) == 200 and all(0 <= v <= 1 for v in got.values()) and got[6] > got[0]
    with pytest.raises(ValueError, match="unknown calibration"):
        models.fit_boosted(frame, ("x",), ("c",), "label", "fold", rounds=1, method="other")


VALUES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), -1.5, 1e308, 1.7976931348623157e308, math.inf, -math.inf, 0.1, 123456.789]


def place(v):
    bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
    return -bits if v < 0 else bits


def test_places_of_doubles(spark):
    got = spark.createDataFrame([(v,) for v in [*VALUES, math.nan, None]], "v double").select("v", fingerprint.ordered_bits(F.col("v")).alias("o")).collect()
    assert [r["o"] for r in got] == [place(v) for v in VALUES] + [None, None]


def test_kinds_of_differences(spark):
    up = lambda v, n: up(math.nextafter(v, math.inf), n - 1) if n else v
    base = [(1, 1.0, 1.0, 1.0, "a", math.nan), (2, 2.0, 2.0, -0.0, None, None), (3, -1e300, 0.5, 3.0, "c", 1.0)]
    other = [(1, 1.0, up(1.0, 2), up(1.0, 3), "a", math.nan), (2, 2.0, 2.0, 0.0, None, None), (3, -1e300, up(0.5, 1), 3.0, "c", 1.0)]
    kinds = "k long, same double, last double, far double, text string, odd double"
    make = lambda rows: spark.createDataFrame(rows, kinds)
    got = {r["column_name"]: r for r in fingerprint.table_verdict(make(base), make(other), "k", 2).collect()}
    assert {c: r["kind"] for c, r in got.items()} == {"same": "equal", "last": "serialisation", "far": "content", "text": "equal", "odd": "equal"}
    assert (got["last"]["n_different"], int(got["last"]["max_ulp"]), got["last"]["n_beyond"]) == (2, 2, 0)
    assert (int(got["far"]["max_ulp"]), got["far"]["n_beyond"]) == (3, 1)
    shorter = {r["column_name"]: r for r in fingerprint.table_verdict(make(base), make(other[:2]), "k", 2).collect()}
    assert shorter["same"]["kind"] == "content" and shorter["same"]["n_only_left"] == 1 and shorter["same"]["n_different"] == 0
    null = fingerprint.table_verdict(make(base), make([other[0], (2, None, 2.0, 0.0, "x", None), other[2]]), "k", 2).collect()
    assert {r["column_name"]: r["n_beyond"] for r in null} == {"same": 1, "last": 0, "far": 1, "text": 1, "odd": 0}
    empty = make([])
    assert {r["kind"] for r in fingerprint.table_verdict(empty, empty, "k").collect()} == {"equal"}


def test_tables_that_cannot_be_compared(spark):
    one = spark.createDataFrame([(1, 2.0)], "k long, v double")
    with pytest.raises(ValueError, match="different columns"):
        fingerprint.table_verdict(one, one.withColumnRenamed("v", "w"), "k")
    for bad in (one.unionByName(one), spark.createDataFrame([(None, 2.0)], "k long, v double")):
        with pytest.raises(Exception, match="null or repeated k"):
            fingerprint.table_verdict(one, bad, "k").collect()
