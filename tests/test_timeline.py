"""Time lines of hot keys: rows of chunks, and the same results as without chunks."""

import random

import pytest
from pyspark.sql import functions as F

from epochal.operators import timeline

DAY = timeline._DAY


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(timeline, "CHUNK_ROWS", 40)


def tables(spark):
    """Half of the facts belong to one entity and code; ties, spans without end or start, null codes and null entities."""
    rnd = random.Random(4)
    spans, asked = [], []
    for i in range(1200):
        entity = 1 if i % 2 else rnd.choice([None, 2, 3, *range(4, 60)])
        lo = rnd.choice([rnd.randint(0, 2000), 500])
        hi = rnd.choice([None, lo + rnd.randint(0, 30), lo + rnd.randint(0, 400)]) if rnd.random() < 0.9 else lo
        spans.append((entity, "a" if i % 3 else "b", rnd.choice([None, "x", "x", "x", str(rnd.randint(0, 4))]), lo if rnd.random() < 0.97 else None, hi))
    spans = [s if s[4] is None or i % 40 == 0 else (*s[:4], s[4]) for i, s in enumerate(spans) if s[4] is not None or i % 7 == 0]
    for i in range(700):
        asked.append((i, 1 if i % 2 else rnd.choice([2, 3, 50, 99]), rnd.choice([rnd.randint(0, 2500), 500])))
    return (
        spans, asked, spark.createDataFrame(spans, "entity long, name string, code string, lo long, hi long").repartition(5), spark.createDataFrame(asked, "id long, entity long, at long").repartition(3),
    )


def covering(spans, entity, at, name):
    """Plain spans one by one, codes once; a span without a start covers nothing."""
    hit = [c for e, n, c, lo, hi in spans if (e, n) == (entity, name) and lo is not None and lo <= at and (hi is None or (lo < hi and at < hi))]
    return sum(c is None for c in hit) + len({c for c in hit if c is not None})


def test_counts_of_hot_entities_and_codes(spark, small_chunks):
    spans, asked, facts, questions = tables(spark)
    assert len(timeline.hot_keys(facts, ["entity", "name", "code"])) >= 1
    got = {r["id"]: (r["a"], r["b"]) for r in timeline.count_covering(questions, [facts.where("code is not null"), facts.where("code is null").drop("code")], ("a", "b")).collect()}
    assert got == {i: tuple(covering(spans, e, at, n) for n in "ab") for i, e, at in asked}


def test_latest_within_of_hot_entities(spark, small_chunks):
    _, asked, _, questions = tables(spark)
    rnd = random.Random(6)
    facts = [(rnd.choice([1, 1, 2, 50]), rnd.choice([rnd.randint(0, 2500) * DAY, 500 * DAY]), rnd.randint(0, 99)) for _ in range(600)]
    frame = spark.createDataFrame(facts, "entity long, at long, value int").repartition(4)
    days = questions.withColumn("at", F.col("at") * DAY)
    got = {r["id"]: r["value"] for r in timeline.latest_within(days, frame, 30).collect()}
    assert got == {i: max((v for e, t, v in facts if e == entity and at * DAY < t <= (at + 30) * DAY), default=None) for i, entity, at in asked}


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_maximum_of_hot_keys(spark, small_chunks, inclusive):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, 1, 1, 1, 2, *range(3, 30)]), rnd.randint(0, 10**6), i, rnd.randint(0, 10**6)) for i in range(900)]
    frame = spark.createDataFrame(rows, "entity int, at long, id long, value long").repartition(6)
    out = timeline.running(frame, ["entity"], ["at", "id"], {"most": (F.max, F.col("value")), "n": (F.sum, F.lit(1))}, inclusive=inclusive)
    assert out.columns == ["entity", "at", "id", "value", "most", "n"]
    before = lambda r: [x[3] for x in rows if x[0] == r[0] and ((x[1], x[2]) < (r[1], r[2]) or (inclusive and x[2] == r[2]))]
    assert {r["id"]: (r["most"], r["n"]) for r in out.collect()} == {r[2]: (max(b), len(b)) if (b := before(r)) else (None, None) for r in rows}


def half_hot(spark, n):
    """Half of ``n`` rows in one entity and code."""
    entity = F.when(F.col("id") % 2 == 0, 1).otherwise(-F.col("id")).alias("entity")
    return spark.range(n).select(entity, F.lit("a").alias("name"), F.lit("x").alias("code"), (F.col("id") % 1_000_003).alias("lo")).withColumn("hi", F.col("lo") + 1)


def test_chunks_of_a_code_with_half_of_five_million_rows(spark):
    """No chunk has over a fiftieth of the rows."""
    n, keys = 5_000_000, ["entity", "name", "code"]
    cut = timeline.chunked(half_hot(spark, n).where("entity = 1"), keys, ["lo"], n // 2)
    assert cut.groupBy("_chunk").count().agg(F.max("count"), F.sum("count")).first()[:] < (n / 50, n)


def test_counts_of_a_code_with_half_of_many_rows(spark):
    n = 400_000
    rows = half_hot(spark, n)
    assert [(r["entity"], r["n"]) for r in timeline.hot_keys(rows, ["entity", "name", "code"])] == [(1, n // 2)]
    asked = spark.createDataFrame([(i, 1, 10**4 * i) for i in range(1, 11)], "id long, entity long, at long")
    assert {r["a"] for r in timeline.count_covering(asked, rows, ("a",)).collect()} == {1}
