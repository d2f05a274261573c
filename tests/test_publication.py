"""Dates published together: repeated attempts, two writers, failing dates, pruned reading."""

from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F

from epochal.sources import publication as pub

DAYS = ["2000-01-03", "2000-01-10", "2000-01-17"]


def rows(spark, value, days=DAYS):
    return spark.createDataFrame([(d, i, value) for d in days for i in range(3)], "d string, id long, v string").withColumn("d", F.col("d").cast("date"))


def verdicts(spark, **bad):
    return spark.createDataFrame([(d, d not in bad.get("bad", ())) for d in bad.get("days", DAYS)], "d string, passed boolean").withColumn("d", F.col("d").cast("date"))


def run(spark, root, run_id, value, bad=(), days=DAYS):
    return pub.commit(pub.stage(rows(spark, value, days), root, run_id, "d"), root, verdicts(spark, bad=bad, days=days))


def values(spark, root, dates=None):
    got = pub.served(spark, root, rows(spark, ""), "d", dates)
    return sorted({(str(r["d"]), r["v"]) for r in got.collect()}), got.count()


def test_nothing_is_served_before_the_commit(spark, tmp_path):
    root = f"file://{tmp_path}/p"
    assert pub.log(spark, root).count() == 0 and values(spark, root) == ([], 0)
    pub.stage(rows(spark, "a"), root, "r1", "d")
    assert values(spark, root) == ([], 0)


def test_a_date_that_fails_later_is_marked_and_its_rows_stay(spark, tmp_path):
    root = f"file://{tmp_path}/p"
    assert run(spark, root, "r1", "a", bad=DAYS[2:]) == 1
    assert run(spark, root, "r2", "b", bad=DAYS[1:]) == 2
    got = {r["date"]: (r["state"], r["last_commit"], r["served_commit"], r["n_rows"]) for r in pub.state(spark, root).collect()}
    assert got == {DAYS[0]: ("published", 2, 2, 3), DAYS[1]: ("stale", 2, 1, 3), DAYS[2]: ("failed", 2, None, 0)}
    assert values(spark, root) == ([(DAYS[0], "b"), (DAYS[1], "a")], 6)


def test_a_repeated_attempt_changes_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/p"
    assert run(spark, root, "r1", "a") == 1 and run(spark, root, "r2", "b", days=DAYS[:1]) == 2
    assert run(spark, root, "r1", "a") == 1  # the first run once more doesn't hide the second
    assert values(spark, root) == ([(DAYS[0], "b"), (DAYS[1], "a"), (DAYS[2], "a")], 9)


def test_writers_at_the_same_time_all_get_numbers(spark, tmp_path):
    root = f"file://{tmp_path}/p"
    with ThreadPool(4) as pool:
        numbers = pool.map(lambda k: run(spark, root, f"r{k % 3}", f"v{k % 3}"), range(4))  # r0 twice
    assert numbers[0] == numbers[3] and sorted(set(numbers)) == [1, 2, 3]
    last = max(range(3), key=lambda k: numbers[k])
    assert values(spark, root) == ([(d, f"v{last}") for d in DAYS], 9)


def test_reading_one_date_reads_its_files_only(spark, tmp_path):
    root = f"file://{tmp_path}/p"
    run(spark, root, "r1", "a")
    run(spark, root, "r2", "b", days=DAYS[:1])
    got = pub.served(spark, root, rows(spark, ""), "d", [DAYS[1]])
    assert got.count() == 3 and all(f"d={DAYS[1]}" in f for f in got.inputFiles()) and got.columns == ["d", "id", "v"]
    assert values(spark, root, ["1999-01-01"]) == ([], 0)


def test_odd_runs(spark, tmp_path):
    """A staged date without a verdict fails; a verdict without rows is recorded; an empty run has a number; null dates are refused."""
    root = f"file://{tmp_path}/p"
    staged = pub.stage(rows(spark, "a"), root, "r1", "d")
    assert pub.commit(staged, root, verdicts(spark, days=[*DAYS[:2], "2000-02-01"])) == 1
    got = {r["date"]: (r["state"], r["n_rows"]) for r in pub.state(spark, root).collect()}
    assert got == {DAYS[0]: ("published", 3), DAYS[1]: ("published", 3), DAYS[2]: ("failed", 0), "2000-02-01": ("published", 0)}
    assert values(spark, root)[1] == 6
    assert run(spark, root, "r2", "b", days=[]) == 2 and values(spark, root)[1] == 6
    with pytest.raises(Exception, match="null d"):
        pub.stage(rows(spark, "a").withColumn("d", F.lit(None).cast("date")), root, "r3", "d")


def test_a_number_is_taken_once(spark, tmp_path):
    """Both ways of creating a file refuse an existing one, keep its text and leave nothing beside it."""
    path = f"{tmp_path}/log/1.json"
    assert pub._link_new(path, "a") and not pub._link_new(path, "b")
    at = spark._jvm.org.apache.hadoop.fs.Path(f"file://{tmp_path}/log/2.json")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    assert pub._rename_new(spark, at, fs, "a") and not pub._rename_new(spark, at, fs, "b")
    assert {p.name: p.read_text() for p in (tmp_path / "log").glob("[!.]*")} == {"1.json": "a", "2.json": "a"}


def test_appending_an_attempt_again_adds_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/log"
    for attempt in ("one", "two", "one"):
        pub.append_once(spark.range(3), path, attempt)
    assert spark.read.parquet(path).count() == 6
