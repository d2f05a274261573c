"""Chronological, entity-disjoint split of a feature table and checks on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intervals import WINDOW_DAYS, days
from .timeline import running


def chronological_split(gold: DataFrame, test_start: Column, reference_end: Column, window_days: int = WINDOW_DAYS, train_start: Column | None = None) -> DataFrame:
    """``gold`` with ``partition``: train, test or the reason for which a row is in neither.

    In order: outcome window not observed; test by start; before the train start; outcome window or label
    horizon reaches into the test period; entity has a test row. Entities of the test side come from a
    distinct list, so the row table is joined once.
    """
    end = F.col("index_stop") + days(window_days)
    before = F.lit(False) if train_start is None else F.col("index_start") < train_start
    rough = (
        F.when(~(end < reference_end), "censored")
        .when(F.col("index_start") >= test_start, "test")
        .when(before, "before_train_start")
        .when(~(end < test_start), "label_window")
        .when(~(F.col("label_horizon") < test_start), "label_horizon")
        .otherwise("train")
    )
    rows = gold.withColumn("partition", rough)
    tested = rows.where("partition = 'test'").select("patient_id").distinct().withColumn("_tested", F.lit(True))
    final = F.when((F.col("partition") == "train") & F.col("_tested").isNotNull(), "patient_overlap").otherwise(F.col("partition"))
    return rows.join(tested, "patient_id", "left").withColumn("partition", final).drop("_tested")


def split_summary(split: DataFrame) -> DataFrame:
    """One row of counts, rates and ranges."""
    at = lambda p: F.col("partition") == p
    dropped = [F.count_if(at(p)).alias(f"n_dropped_{p}") for p in ("censored", "before_train_start", "label_window", "label_horizon", "patient_overlap")]
    sides = []
    for p in ("train", "test"):
        sides += [
            F.count_if(at(p)).alias(f"n_{p}"),
            F.count_if(at(p) & (F.col("is_readmitted") == 1)).alias(f"n_{p}_positive"),
            F.avg(F.when(at(p), F.col("is_readmitted"))).alias(f"{p}_positive_rate"),
            F.countDistinct(F.when(at(p), F.col("patient_id"))).alias(f"n_{p}_patients"),
            F.min(F.when(at(p), F.col("index_start"))).alias(f"{p}_start_min"),
            F.max(F.when(at(p), F.col("index_start"))).alias(f"{p}_start_max"),
        ]
    return split.agg(F.count("*").alias("n_input"), *dropped, *sides)


def split_consistency(split: DataFrame, test_start: Column) -> DataFrame:
    """Counts that must be 0: early test rows, late train rows, entities on both sides."""
    by = split.where("partition in ('train', 'test')")
    both = by.groupBy("patient_id").agg(F.countDistinct("partition").alias("n")).agg(F.count_if(F.col("n") > 1).alias("n_entities_both"))
    rows = by.agg(
        F.count_if((F.col("partition") == "test") & (F.col("index_start") < test_start)).alias("n_test_early"),
        F.count_if((F.col("partition") == "train") & (F.col("index_start") >= test_start)).alias("n_train_late"),
    )
    return rows.crossJoin(F.broadcast(both))  # one row each


def absent_ids(assignment: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: how many assigned ids the feature table lacks."""
    return assignment.select("encounter_id").join(gold.select("encounter_id"), "encounter_id", "left_anti").agg(F.count("*").alias("n_absent"))


def assignment_parity(stored: DataFrame, computed: DataFrame) -> DataFrame:
    """One row: ids on one side only, and ids on different sides of two (encounter_id, partition) tables."""
    both = stored.withColumnRenamed("partition", "p").join(computed.withColumnRenamed("partition", "q"), "encounter_id", "full")
    return both.agg(
        F.count_if(F.col("q").isNull()).alias("only_stored"), F.count_if(F.col("p").isNull()).alias("only_computed"), F.count_if(F.col("p") != F.col("q")).alias("other_side")
    )


def grouped_folds(rows: DataFrame, k: int, group: str = "patient_id") -> DataFrame:
    """``rows`` with ``fold``: by a hash of the entity, hence entity-disjoint and known without a shuffle."""
    number = F.conv(F.substring(F.md5(F.col(group).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return rows.withColumn("fold", F.pmod(number, F.lit(k)).cast("int"))


def _deal(sizes: list[tuple[int, int]], k: int) -> list[tuple[int, list[int]]]:
    """(size, counts): how many entities of a size each fold gets if, largest first, each goes to the lightest fold.

    The entities of one size aren't dealt one by one: folds are filled up to the highest level that they suffice for.
    """
    loads, dealt = [0] * k, []
    for n, m in sorted(sizes, reverse=True):
        filled = lambda level: [max(0, -((w - level) // n)) for w in loads]  # noqa: B023, E731
        low, high = min(loads), max(loads) + n * m + 1
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if sum(filled(middle)) <= m else (low, middle)
        counts = filled(low)
        after = [w + n * c for w, c in zip(loads, counts, strict=True)]
        for f in sorted(range(k), key=lambda f: (after[f], f))[: m - sum(counts)]:  # noqa: B023
            counts[f] += 1
        loads = [w + n * c for w, c in zip(loads, counts, strict=True)]
        dealt.append((n, counts))
    return dealt


def balanced_folds(rows: DataFrame, k: int, group: str = "patient_id") -> DataFrame:
    """``rows`` with ``fold``: entities are whole, and folds have about equally many rows.

    Entities are counted by size, and only that histogram (one row for each distinct size, hence under sqrt(2 n) for n rows)
    is packed. An entity's place among those of its size, by a hash, then gives its fold. Rows without an entity have
    none. Repeated rows count as rows.
    """
    entity = F.col(group)
    sizes = rows.where(entity.isNotNull()).groupBy(group).agg(F.count("*").alias("_size")).withColumn("_h", F.md5(entity.cast("string").cast("binary")))
    histogram = [(r["_size"], r["m"]) for r in sizes.groupBy("_size").agg(F.count("*").alias("m")).collect()]  # distinct sizes
    upto = [(n, [sum(counts[: f + 1]) for f in range(k)]) for n, counts in _deal(histogram, k)]
    dealt = rows.sparkSession.createDataFrame(upto, "_size long, _upto array<long>")
    placed = running(sizes, ["_size"], ["_h", group], {"_place": (F.sum, F.lit(1))}, inclusive=False).withColumn("_place", F.coalesce("_place", F.lit(0)))
    fold = F.size(F.filter("_upto", lambda n: n <= F.col("_place")))
    return rows.join(placed.join(dealt, "_size").select(group, fold.alias("fold")), group, "left")


def require_folds(rows: DataFrame, fold: str, label: str, k: int) -> None:
    """Refuses folds that aren't 0 to k - 1 for every row, or of which one, or all others, hold one class only."""
    at = lambda i: F.col(fold) == i
    inside = F.coalesce(F.col(fold).between(0, k - 1), F.lit(False))
    counts = [c for i in range(k) for c in (F.count_if(at(i)).alias(f"n{i}"), F.count_if(at(i) & (F.col(label) == 1)).alias(f"pos{i}"))]
    r = rows.agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("pos"), F.count_if(~inside).alias("outside"), *counts).first()
    if r["outside"]:
        raise ValueError(f"{r['outside']} rows are in no fold")
    for i in range(k):
        n, pos = r[f"n{i}"], r[f"pos{i}"]
        if not 0 < pos < n or not 0 < r["pos"] - pos < r["n"] - n:
            raise ValueError(f"fold {i} has {pos} positive of {n} rows, the others {r['pos'] - pos} of {r['n'] - n}: both need two classes")


def held_out_window(split: DataFrame, start: Column, end: Column) -> tuple[DataFrame, DataFrame]:
    """(rows, gate): test rows that stop in [start, end); the gate counts rows that forbid their use."""
    inside = split.where((F.col("index_stop") >= start) & (F.col("index_stop") < end))
    known = F.col("partition") == "test"
    gate = inside.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("partition") == "train").alias("n_train"),
        F.count_if(~F.col("partition").isin("train", "test")).alias("n_unassigned"),
        (F.count("*") - F.countDistinct("encounter_id")).alias("n_duplicate"),
    )
    return inside.where(known), gate
