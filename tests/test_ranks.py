"""Ranks and their order across tasks, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from epochal.operators import assertions, scoring
from epochal.sources import tables


def landing(tmp_path):
    return lambda frame: tables.write_once(frame, f"file://{tmp_path}/dealt")


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_hot_group_is_ranked_in_many_tasks(spark, tmp_path, adaptive):
    """One group with most rows, ties, null scores and groups, one empty-named group; ranks are 1 to n in order."""
    rng = random.Random(4)
    data = [("hot" if i % 10 else rng.choice(["a", "b", None, ""]), i, None if i % 97 == 0 else rng.randrange(50) / 50) for i in range(20_000)]
    frame = spark.createDataFrame(data, "g string, id long, s double").repartition(3)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        land, parts = landing(tmp_path), []
        got = scoring.ranked(frame, "g", "s", "id", lambda f: parts.append(land(f)) or parts[0]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    want, groups = {}, {}
    for g, i, s in data:
        groups.setdefault(g, []).append((s is None, -(s or 0), i))
    for members in groups.values():
        want |= {m[2]: k for k, m in enumerate(sorted(members), 1)}
    assert {r["id"]: r["rank"] for r in got} == want and len(got) == len(data)
    if adaptive == "false":
        tasks = parts[0].where("g = 'hot'").groupBy(F.shiftright("_place", 33)).count().collect()
        assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 9_000


def test_no_rows(spark, tmp_path):
    assert scoring.ranked(spark.createDataFrame([], "g string, id long, s double"), "g", "s", "id", landing(tmp_path)).count() == 0


@pytest.mark.parametrize("width", [3, 65_536])
def test_order_across_ranges(spark, width):
    """Values that rise inside a range, at its border and after a gap; nulls, repeated places, groups without fault."""
    rng = random.Random(9)
    data = []
    for g in range(12):
        values = sorted((rng.random() for _ in range(20)), reverse=True)
        for _ in range(g % 4):
            values[rng.randrange(20)] = rng.choice([rng.random(), None])
        data += [(g if g else None, r, v) for r, v in enumerate(values, 1) if rng.random() < 0.8]
    frame = spark.createDataFrame(data, "g int, r int, v double")
    want = {}
    for g in {d[0] for d in data}:
        rows = sorted((r, v) for x, r, v in data if x == g)
        want[g] = sum(p[1] is not None and (v is None or v > p[1]) for p, (_, v) in zip(rows, rows[1:], strict=False))
    assert {r["g"]: r["n_bad"] for r in assertions.not_increasing(frame, ("g",), "r", "v", width).collect()} == want and any(want.values())
    shared = spark.createDataFrame([(1, 1, 0.5), (1, 1, 0.9), (1, 2, 0.7), (1, None, 0.1)], "g int, r int, v double")
    assert assertions.not_increasing(shared, ("g",), "r", "v", width).first()["n_bad"] == 2  # place 1 after the null place, place 2 after place 1
