"""Groups of many short texts that share a hub and link to nothing."""

import numpy as np
from pyspark.sql import functions as F

from epochal.llm import near_dup
from epochal.llm.common import work_dir


def test_blocks_are_bounded_by_rows(spark):
    rows = spark.range(20_000).select(F.lit(1).alias("hub"), (F.col("id") < 5000).alias("main"), F.lit(64).cast("long").alias("bytes"))
    n = near_dup._blocks(rows).first()
    assert (n["n_main"], n["n_rest"]) == (3, 8)


def test_a_template_group_over_several_blocks(spark):
    texts = [(i, f"a b c d e f g h i j w{i}") for i in range(5000)]
    texts += [(10_000 + i, f"A b c d e f g h i j w{i}") for i in range(0, 5000, 1000)]  # equal but for case
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs, words=4).collect()}
    assert got == {i: i % 10_000 for i, _ in texts}


def test_rows_under_one_id_with_different_texts(spark):
    """Copies of either text are found, in any order of rows."""
    a, b = ([f"{x}{i}" for i in range(40)] for x in "ab")
    near = lambda w: " ".join([*w[:-1], "else"])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (8, near(a)), (9, near(b)), (9, None), (7, "apart from all of them"), (None, " ".join(a)), (None, "no id at all"), (None, "no id at all")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        got = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in near_dup.near_duplicates(docs).collect())
        assert got == [(0, 0, True), (0, 0, True), (0, 5, False), (5, 5, True), (5, 5, True), (7, 7, True), (8, 5, False), (9, 5, False), (9, 5, False)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 100)] + [(1000, i) for i in range(900, 1000)] + [(5000, 5000), (2001, 2000), (2001, 2002)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["label"] for r in near_dup.connected_components(frame, work_dir(spark, "cc"), "t").collect()}
    assert got == {i: 0 for i in range(101)} | {i: 900 for i in range(900, 1001)} | {i: 2000 for i in range(2000, 2003)}


def test_candidates_equal_the_estimate_pair_by_pair():
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 2**62, 120)
    x, y = ([np.unique(np.where(rnd.random(n := rnd.integers(5, 120)) < 0.12, rnd.integers(0, 2**62, n), base[:n])) for _ in range(40)] for _ in range(2))
    want = set()
    for i, a in enumerate(x):
        for j, b in enumerate(y):
            low, high = sorted((len(a), len(b)))
            shared = np.intersect1d(a[:64], b[:64])
            within = np.intersect1d(np.union1d(a[:64], b[:64])[:64], shared)
            exact = 100 * len(shared) >= 80 * (low + high - len(shared))
            if 100 * low >= 80 * high and (exact if high <= 64 else len(within) >= 32):
                want.add((i, j))
    got = near_dup.candidates(x, y, 80, 64, 32)
    assert set(zip(*(v.tolist() for v in got), strict=True)) == want and want
