"""What look-back counts send."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from epochal.operators import timeline
from epochal.plans import registry
from epochal.sources.adapter import LINE

SMALL = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_spans_are_sent_once(spark):
    """No exchange of steps after that of spans; counts are those of plain Python."""
    spans = [(e, n, c, lo, lo + w) for e in range(7) for n, w in (("a", 5), ("b", 9)) for c in range(3) for lo in range(0, 60, 4 + e)]
    asked = [(i, i % 8, i * 3 % 70) for i in range(200)]
    kinds = "entity long, name string, code long, lo long, hi long"
    coded = spark.createDataFrame(spans, kinds)
    plain = coded.drop("code").withColumn("name", F.concat("name", F.lit("_all")))
    names = ("a", "b", "a_all", "b_all")
    found = timeline.count_covering(spark.createDataFrame(asked, "id long, entity long, at long"), [coded, plain], names)
    hashed = [x for x in plan(found).splitlines() if "Exchange hashpartitioning" in x]
    assert hashed and not [x for x in hashed if "REPARTITION_BY_COL" not in x], hashed
    for r in found.collect():
        e, at = next((e, at) for i, e, at in asked if i == r["id"])
        hits = [(n, c) for x, n, c, lo, hi in spans if x == e and lo <= at < hi]
        assert tuple(r)[1:] == (len({c for n, c in hits if n == "a"}), len({c for n, c in hits if n == "b"}), sum(n == "a" for n, _ in hits), sum(n == "b" for n, _ in hits))


def test_lines_hold_what_roles_take(spark):
    assert registry.Plans(spark, SMALL).lines.columns == list(LINE)


def test_a_line_is_sent_once_for_all_its_roles(spark):
    """Counts of the feature table send lines, stays and questions, each by entity and once."""
    p = registry.Plans(spark, SMALL)
    hashed = [x for x in plan(p.counts).splitlines() if "Exchange hashpartitioning(entity" in x]
    assert len(hashed) == 3, hashed


def test_counts_put_only_questions_in_order(spark):
    """Rows of an entity are sorted by nothing but the entity, and what spans share is sent once."""
    found = plan(registry.Plans(spark, SMALL).counts).split("MapInArrow")[1]
    sorts = [x for x in found.split("Exchange")[0].splitlines() if "Sort [" in x]
    assert len(sorts) == 1 and sorts[0].split("Sort [")[1].count("ASC") == 1, sorts


@pytest.mark.parametrize("at_once", [1, 50, 10**6])
def test_entities_across_batches(monkeypatch, at_once):
    """Entities that lie in several batches, or several in one, are counted whole."""
    monkeypatch.setattr(timeline, "ROWS_AT_ONCE", at_once)
    rnd, rows, want = random.Random(1), [], {}
    for e in range(40):
        spans = [(lo, lo + rnd.randrange(1, 30), rnd.choice("abc")) for lo in (rnd.randrange(60) for _ in range(rnd.randrange(9)))]
        asked = [(100 * e + i, rnd.randrange(90)) for i in range(rnd.randrange(4))]
        mine = [{"bits": 6, "t0": lo, "t1": hi, "c0": c} for lo, hi, c in spans] + [{"bits": 1, "t0": at, "id": i} for i, at in asked]
        rnd.shuffle(mine)
        rows += [r | {"nth": n + 1} for n, r in enumerate(mine)]
        for i, at in asked:
            held = [c for lo, hi, c in spans if lo <= at < hi]
            want[i] = (len(held), len(set(held)))
    kinds = pa.schema([("bits", pa.int64()), ("t0", pa.int64()), ("t1", pa.int64()), ("c0", pa.string()), ("id", pa.int64()), ("nth", pa.int64())])
    layout = [[(2, [0], "t0", "t1", None), (4, [1], "t0", "t1", "c0")]]
    found = list(timeline._answers(iter(pa.Table.from_pylist(rows, kinds).to_batches(max_chunksize=7)), layout, ("n", "codes")))
    assert {r["id"]: (r["n"], r["codes"]) for b in found for r in b.to_pylist()} == want
    assert len(found) > 1 or at_once > len(rows)


@pytest.mark.parametrize("chunk", [10**6, 20])
def test_rows_that_stand_for_several_spans(spark, monkeypatch, chunk):
    """Spans of one row, with several names, codes, conditions, without end, start or length, as plain Python counts them; with and without hot entities."""
    monkeypatch.setattr(timeline, "CHUNK_ROWS", chunk)
    rnd = random.Random(5)
    rows = [(rnd.choice([None, 1, 1, 2, 3, 4]), rnd.choice([None, 5, 6, 7]), rnd.choice([None, *range(0, 90, 3)]), rnd.choice([None, -2, 0, 4, 25]), rnd.random() < 0.5) for _ in range(300)]
    asked = [(i, i % 6, i * 7 % 110) for i in range(160)]
    facts = spark.createDataFrame(rows, "entity long, code int, lo long, width long, flag boolean")
    lo, hi, known = F.col("lo"), F.col("lo") + F.col("width"), F.col("code").isNotNull()
    spans = [
        timeline.Span(("p", "q"), lo, hi), timeline.Span(("q",), lo + 1, hi, where=F.col("flag")), timeline.Span(("r",), lo, hi, F.col("code"), known),
        timeline.Span(("s",), lo, hi, F.col("code"), known & F.col("flag")),
    ]
    tables = [timeline.Facts(facts, spans), timeline.Facts(facts.where("flag"), spans[:1])]
    found = timeline.count_covering(spark.createDataFrame(asked, "id long, entity long, at long"), tables, tuple("pqrs"))
    got = {r["id"]: tuple(r)[1:] for r in found.collect()}
    for i, e, at in asked:
        mine = [r for r in rows if r[0] == e and r[2] is not None]
        holds = lambda r, by=0: r[2] + by <= at and (r[3] is None or at < r[2] + r[3])  # noqa: B023, E731
        a = sum(holds(r) * (1 + r[4]) for r in mine)
        b = a + sum(holds(r, 1) for r in mine if r[4])
        c, d = (len({r[1] for r in mine if holds(r) and r[1] is not None and (r[4] or not f)}) for f in (False, True))
        assert got[i] == (a, b, c, d), (i, e, at)
