"""The filter audit against filters that are really applied one after another."""

import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from epochal.llm import filter_audit, queries


def fails(rows):
    """For each row its failing letters, by plain Python."""
    out = []
    for i, text, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append({
            c for c, bad in zip("ABCDE", (
                len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), re.search(r"[#$%&*|]", t),
                i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows),
            ), strict=True) if bad
        })
    return out


def by_hand(rows, labels):
    failed, found = fails(rows), {}
    good, toxic = ({i for i, *marks in labels if marks[k] == 1 and i is not None} for k in (0, 1))
    for part in {p or "" for *_, p in rows}:
        own = [k for k, (*_, p) in enumerate(rows) if (p or "") == part]
        for order in permutations("ABCDE"):
            kept = own
            for step, f in enumerate(order, 1):
                gone = [k for k in kept if f in failed[k]]
                kept = [k for k in kept if f not in failed[k]]
                count = lambda marked, gone=gone: sum(rows[k][0] in marked for k in gone)
                found[part, "".join(order), step] = [
                    len(kept), len(gone), sum(f in failed[k] for k in own) - len(gone), sum(failed[k] == {f} for k in own), count(good), count(toxic), f,
                ]
    for key, x in found.items():
        x.append(sum(y[1] for k, y in found.items() if k[0] == key[0] and y[6] == x[6]))
    return {k: tuple(x[:6] + x[7:]) for k, x in found.items()}


def sides(spark, tmp_path, rows, labels):
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).withColumns({c: F.lit("x") for c in ("row", "part", "digest", "A", "n")}).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return {(r[0], r[1], r[2]): tuple(r[3:]) for r in queries.op11_filter_audit(spark, f"file://{tmp_path}").collect()}


def test_audit_equals_filters_applied_in_every_order(spark, tmp_path):
    """Nulls in each column, empty and very long texts, copies, repeated rows, labels of equal ids, part names of both kinds of empty."""
    rng = np.random.default_rng(7)
    words = [*"abcdefghij", "Word", "LOUD", "50%", "é中", "😀"]
    make = lambda n, k: " \t\n".join(rng.choice(words[:k], n))
    rows = [(i, make(int(rng.integers(1, 120)), int(rng.integers(2, 16))), f"src{int(rng.integers(0, 3))}") for i in range(120)]
    rows += [(i, rows[i % 7][1], "src0") for i in range(120, 160)]
    rows += [(200, None, None), (201, "", ""), (202, None, "src1"), (None, rows[0][1], "src1"), (None, None, None), (5, rows[5][1], "src1"), (300, "x " * 200_000, "src2"), (301, "\x0b\x0b", "only")]
    labels = [(i, int(i % 2), int(i % 5 == 0)) for i in range(0, 210, 3)] + [(3, 0, 1), (None, 1, 1), (6, None, None)]
    assert sides(spark, tmp_path, rows, labels) == by_hand(rows, labels)


def test_audit_of_nothing_is_nothing(spark, tmp_path):
    assert sides(spark, tmp_path, [], []) == {}


def test_merges_of_sorted_lists():
    rng = np.random.default_rng(1)
    for _ in range(300):
        lists = [np.unique(rng.integers(0, 60, int(rng.integers(0, 40)))) for _ in range(4)]
        assert filter_audit.merged(lists).tolist() == sorted(set().union(*map(set, lists)))
        a, b = lists[:2]
        assert filter_audit.without(a, b).tolist() == sorted(set(a) - set(b))
        assert filter_audit.common(a, b) == len(set(a) & set(b))


def test_lists_of_a_large_part_are_cut(spark):
    rows = spark.range(30_000).select(F.col("id").alias("row"), F.lit("hot").alias("part"), *(F.lit(True).alias(c) for c in (*"ABCDE", "good", "toxic")))
    lists = filter_audit.postings(rows)
    assert lists.agg(F.max(F.size("A"))).first()[0] <= filter_audit.RANGE
    assert filter_audit.audit(lists).where("filter_order = 'ABCDE' and step = 1").select("kept", "removed").first() == (0, 30_000)
