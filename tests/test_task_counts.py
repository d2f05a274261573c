"""How many tasks share the work of boosting rounds and bootstrap blocks."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from epochal.operators import evaluate, models


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_boosting_tasks():
    """They follow the cores, not the rows or the files of the table."""
    assert [models.boosting_tasks(n, 5, 12) for n in (100, 10_000, 120_000, 600_000)] == [1, 2, 3, 3]
    assert models.boosting_tasks(10_000_000, 5, 12) == 39  # at most 262,144 rows each
    assert models.boosting_tasks(120_000, 5, 1) == 1


def test_blocks_are_spread(spark):
    """Blocks are few bytes: tasks by bytes would put all resamples into one."""
    rows = spark.range(40_000).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 997 / 997).alias("p"))
    sums = evaluate.block_sums(evaluate.block_rows(rows, "y", ["p"], "id"), 10)
    assert "REPARTITION_BY_NUM" in plan(sums)
    ece = evaluate.resampled_ece(evaluate.block_rows(rows, "y", ["p"], "id"), sums)
    assert plan(ece).count("REPARTITION_BY_NUM") >= 2


def test_weights_at_borders():
    """The table of upper bits gives the weights that a search among the borders gives."""
    borders = np.array(evaluate.POISSON, np.uint64)
    near = np.unique(np.concatenate([[0, 2**32 - 1], *(np.clip(borders.astype(np.int64) + d, 0, 2**32 - 1) for d in (-65536, -1, 0, 1, 65536))])).astype(np.uint64)
    w = evaluate._weights(near.astype(np.uint32))
    assert w.tolist() == np.searchsorted(borders, near, side="right").tolist()


@pytest.mark.parametrize("scores", [1, 7, 4096])
def test_a_block_is_summed_in_little_memory(scores):
    """Sums of a block are those of all its weights, of which only as many are drawn at once as a core's cache holds."""
    rng, n = np.random.default_rng(3), 4096
    frame = pd.DataFrame({"p": rng.integers(0, scores, n) / scores, "y": (rng.random(n) < 0.1).astype(float), "arm": "p", "block": 0, "tied": False})
    frame = frame.assign(e1=rng.integers(0, 2**32, n), e2=rng.integers(0, 2**32, n))
    tracemalloc.start()
    got = evaluate._sums_of_block(frame, 300)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6, peak  # 40 MB and more when 256 resamples are drawn at once
    p, y = (frame[c].to_numpy() for c in ("p", "y"))
    w = evaluate.poisson_weights(*(frame[c].to_numpy().astype(np.uint32) for c in ("e1", "e2")), np.arange(300, dtype=np.uint32)).astype(float)
    assert got["pos"].tolist() == (y @ w).tolist() and got["neg"].tolist() == ((1 - y) @ w).tolist()
    assert np.allclose(got["wp"], p @ w) and np.allclose(got["wsq"], (p - y) ** 2 @ w)
    for b in (0, 299):
        below = [(w[p < s, b] @ (1 - y[p < s])) + (w[p == s, b] @ (1 - y[p == s])) / 2 for s in p[y == 1]]
        assert got["within"][b] == pytest.approx(w[y == 1, b] @ np.array(below))
