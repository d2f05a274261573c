"""The drawn rows, not only the weights, reach the raked targets."""

import random

import pytest
from pyspark.sql import functions as F

from epochal.llm import mixing
from epochal.llm.common import work_dir


def test_drawn_rows_reach_the_targets(spark):
    rnd = random.Random(5)
    texts = {"legal": "licence w w w w w w w w w", "prose": "w " * 10}
    rows = [(i, texts["legal" if rnd.random() < 0.05 else "prose"], "en" if rnd.random() < 0.9 else "de", rnd.choice("ab")) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").cache()
    shares = {"topic": {"legal": 0.3, "prose": 0.7}, "lang": {"en": 0.6, "de": 0.4}, "source": {"a": 0.5, "b": 0.5}}
    targets = {m: spark.createDataFrame(list(t.items()), f"{m} string, share double") for m, t in shares.items()}
    out = mixing.sample(docs, targets=targets).select("doc_id", "lang", "source", mixing.topic(F.col("text")).alias("topic")).collect()
    assert len(out) == pytest.approx(6000, rel=0.03)
    for m, t in shares.items():
        for name, share in t.items():
            assert sum(r[m] == name for r in out) / len(out) == pytest.approx(share, abs=0.02), (m, name)
    times = {r["doc_id"]: r for r in mixing.weigh(docs, targets=targets).collect()}
    drawn = {}
    for r in out:
        drawn[r["doc_id"]] = drawn.get(r["doc_id"], 0) + 1
    assert max(r["copies"] for r in times.values()) > 3
    for i, r in times.items():
        assert drawn.get(i, 0) == r["drawn"] and abs(r["drawn"] - r["copies"]) < 1 and r["copies"] == pytest.approx(r["whole"] + r["probability"])
    # expected shares of the sample are the targets
    total = sum(r["copies"] * r["n_tokens"] for r in times.values())
    for m, t in shares.items():
        for name, share in t.items():
            assert sum(r["copies"] * r["n_tokens"] for r in times.values() if r[m] == name) / total == pytest.approx(share, abs=0.01)


def test_raking_in_one_row_equals_raking_by_tables(spark):
    rnd = random.Random(6)
    rows = [(s, l, t, rnd.choice((0, 3, 50, 900))) for s in "abcdefgh" for l in ("x", "y", "(none)") for t in "pq" if rnd.random() < 0.8]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    given = {"source": [("a", 0.5), ("b", 0.3), ("zz", 0.2)], "lang": [("x", 1.0), ("y", 0.0)], "topic": [("p", 0.4), ("q", 0.6)]}
    targets = [mixing.corpus_targets(cells, 0.7), {m: spark.createDataFrame(t, f"{m} string, share double") for m, t in given.items()}]
    for t in targets:
        one = {tuple(r)[:3]: r["factor"] for r in mixing.rake(cells, t, 5).collect()}
        other = {tuple(r)[:3]: r["factor"] for r in mixing.rake_tables(cells, t, work_dir(spark, "rake"), 5).collect()}
        assert one == pytest.approx(other)
    assert mixing.rake(cells.where("tokens < 0"), mixing.corpus_targets(cells, 0.7)).count() == 0


def test_null_repeated_and_clashing_rows(spark):
    rows = [(1, None, None, None, 5), (1, "a b c", "en", "s", 6), (1, "a b c", "en", "s", 6), (None, "a b", None, "s", 7), (2, "", "en", None, 8), (3, " \n", "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, copies int")
    out = mixing.weigh(docs).collect()
    assert len(out) == 6 and {r["topic"] for r in out} == {"none", "prose"} and {r["source"] for r in out} == {"s", "(none)"}
    drawn = [r["drawn"] for r in out if r["doc_id"] == 1 and r["n_tokens"] == 3]
    assert len(set(drawn)) == 1  # equal ids draw equal numbers
    assert mixing.sample(docs).columns == docs.columns
    assert mixing.sample(docs.limit(0)).count() == 0
