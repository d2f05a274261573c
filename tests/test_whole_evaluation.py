"""Bootstrap, models and report at the size that the reference has, against brute force."""

import hashlib
import inspect
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from epochal.operators import evaluate, models
from epochal.plans import evaluation


def rows_of(n=60, entities=13):
    r = np.random.default_rng(3)
    return [(int(i), int(i * 7 % entities), int(r.random() < 0.4), float(r.integers(1, 8) / 8), float(r.integers(1, 8) / 8)) for i in range(n)]


def one_resample(rows, b, entities):
    """Rows as often as their entity is drawn: Poisson counts of a mixed hash, in plain integers."""

    def mix(x):
        for shift, times in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
            x = (x ^ (x >> shift)) * times % 2**32
        return x

    times = {}
    for e in entities:
        h = hashlib.md5(str(e).encode()).hexdigest()
        u, k, cdf = mix(mix((int(h[:8], 16) + b * 0x9E3779B9) % 2**32) ^ int(h[8:16], 16)) / 2**32, 0, math.exp(-1)
        while u >= cdf:
            k += 1
            cdf += math.exp(-1) / math.factorial(k)
        times[e] = k
    return [r for r in rows for _ in range(times[r[1]])]


def metrics(y, p):
    pos, neg = p[y == 1], p[y == 0]
    area = np.mean((pos[:, None] > neg[None]) + 0.5 * (pos[:, None] == neg[None])) if len(pos) and len(neg) else None
    edges = np.unique(np.quantile(p, np.arange(11) / 10))
    bins = np.clip(np.searchsorted(edges, p, side="right") - 1, 0, max(len(edges) - 2, 0))
    ece = sum(abs((p[bins == i] - y[bins == i]).sum()) for i in set(bins)) / len(p)
    return {"auc": area, "brier": np.mean((p - y) ** 2), "oe": y.sum() / p.sum(), "gap": p.mean() - y.mean(), "ece": ece}


@pytest.mark.parametrize("block", [4096, 9, 5])
def test_bootstrap_equals_brute_force(spark, monkeypatch, block):
    """Also where a block holds few rows and ties of one score lie in several tasks."""
    monkeypatch.setattr(evaluate, "BLOCK_ROWS", block)
    rows = rows_of()
    frame = spark.createDataFrame(rows, "id long, e long, y int, p double, q double")
    got = evaluate.bootstrap(frame, "y", ["p", "q"], "e", 40).join(evaluate.bootstrap_ece(frame, "y", ["p", "q"], "e", 40), ["b", "arm"]).collect()
    assert len(got) == 80
    for g in got:
        drawn = one_resample(rows, g["b"], {r[1] for r in rows})
        want = metrics(np.array([r[2] for r in drawn]), np.array([r[3 if g["arm"] == "p" else 4] for r in drawn]))
        for name, v in want.items():
            assert g[name] == (None if v is None else pytest.approx(v, abs=1e-9)), name


def test_weights_are_poisson():
    e1, e2 = np.random.default_rng(1).integers(0, 2**32, (2, 500)).astype(np.uint32)
    w = evaluate.poisson_weights(e1, e2, np.arange(400, dtype=np.uint32))
    assert w.mean() == pytest.approx(1, abs=0.01) and w.var() == pytest.approx(1, abs=0.02) and (w == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.15 and abs(np.corrcoef(w[0], w[1])[0, 1]) < 0.15


def test_ranges_of_scores_against_numpy(spark):
    r = np.random.default_rng(8)
    y, p = r.integers(0, 2, 3000), np.round(r.random(3000), 3)
    frame = spark.createDataFrame(list(zip(y.tolist(), p.tolist(), strict=True)), "y int, p double").repartition(5)
    order = np.argsort(-p, kind="stable")
    _, last = np.unique(-p[order], return_index=True)
    ends = np.append(last[1:], len(p)) - 1
    hits = np.cumsum(y[order])[ends]
    ap = (np.diff(hits, prepend=0) * hits / (ends + 1)).sum() / y.sum()
    assert evaluate.average_precision(frame, "y", "p").first()[0] == pytest.approx(ap, abs=1e-12)
    assert evaluate.auc(frame, "y", "p").first()[0] == pytest.approx(metrics(y, p)["auc"], abs=1e-12)
    assert evaluate.ece(evaluate.calibration(frame, "y", "p")).first()[0] == pytest.approx(metrics(y, p)["ece"], abs=1e-12)


def test_sizes_of_the_reference():
    assert (evaluation.RESAMPLES, evaluation.FOLDS, evaluation.ROUNDS) == (2000, 5, 300)
    full = {k: v.default for k, v in inspect.signature(models.fit_boosted).parameters.items()}
    assert (full["folds"], full["rounds"], full["depth"]) == (5, 300, 4)


def test_report_has_both_models_and_paired_intervals(spark):
    frame = spark.createDataFrame(rows_of(), "id long, e long, y int, p double, q double")
    got = {(r["model"], r["metric"]): r for r in evaluation.report(frame, "y", ("p", "q"), "e", 0.4, 200).collect()}
    for metric in ("auc", "brier", "oe_ratio", "gap", "abs_gap", "ece"):
        d = got["difference", metric]
        assert d["value"] == pytest.approx(got["q", metric]["value"] - got["p", metric]["value"])
        assert d["low"] < d["high"] and got["p", metric]["low"] < got["p", metric]["high"] and d["n_used"] == 200
    assert got["p", "average_precision"]["value"] > 0


def test_boosted_folds(spark):
    rows = [(i, i % 5, float(i % 7), "a" if i % 3 else "b", float(i % 7 > 3)) for i in range(200)]
    frame = spark.createDataFrame(rows, "id long, fold int, x double, c string, label double").cache()
    fitted = models.fit_boosted(frame, ("x",), ("c",), "label", "fold", rounds=2)
    assert len(fitted) == 5
    assert models.score_boosted(fitted, frame, "id").where("risk_score between 0 and 1").count() == 200


def test_places_of_quantiles_are_bounded_by_parameters(spark):
    """22 places for each resample, whatever the rows; sums by block; and most blocks stay closed."""
    n, resamples = 60_000, 40
    score = F.pmod(F.xxhash64("id"), F.lit(10**9)) / 10**9
    frame = spark.range(n).select("id", (F.col("id") % 9000).alias("e"), (F.col("id") % 7 == 0).cast("int").alias("y"), score.alias("p"))
    blocks = evaluate.block_rows(frame, "y", ["p"], "e").cache()
    sums = evaluate.block_sums(blocks, resamples).cache()
    places = evaluate._quantile_places(sums, 4).cache()
    assert places.count() == resamples * 10 and sums.count() == resamples * math.ceil(n / evaluate.BLOCK_ROWS)
    assert places.select("block").distinct().count() < blocks.select("block").distinct().count()
    assert blocks.groupBy("block").count().agg(F.max("count")).first()[0] <= 2 * evaluate.BLOCK_ROWS
