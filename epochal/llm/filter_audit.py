"""Filter interaction audit: what each filter removes, alone, after the others, and over all orders.

Each filter has, for each part and range of row numbers, a sorted posting list of the rows that fail it. What a
filter removes after others is its list without the union of theirs; unions and differences are merges that gallop
(each search goes on from the last one) through sorted lists. A range holds at most ``RANGE`` rows of one part, so
lists are short however large a part is, and only sizes leave a range, to be added up by part.

Edge cases: null texts and sources are empty; equal rows are rows of their own; a null doc_id has no smaller and is
no smaller one, and has no labels; rows of ``labels`` that share a doc_id count as one that has either mark; very long
texts are only read by expressions; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, work_dir

FILTERS = "ABCDE"
#: Rows of a range; a power of two.
RANGE = 8192
_ROWS = -1  # the cell that holds the number of rows
_OUT = pa.schema([("part", pa.string()), ("cell", pa.int32()), ("removed", pa.int64()), ("good_lost", pa.int64()), ("toxic_lost", pa.int64())])


def failing(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that judge a text by itself."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n, length = F.size(words), F.char_length(text)
    capitals = length - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(words)) * F.lit(100) < n * F.lit(65),
        "C": capitals * F.lit(100) > length * F.lit(5),
        "D": text.rlike("[#$%&*|]"),
    }


def judged(docs: DataFrame, labels: DataFrame, folder: str, *, part: str = "source") -> DataFrame:
    """(row, part, A to E, good, toxic): a boolean for each filter that a row fails and for its labels.

    Copies are found by a digest: the first of a digest's doc_ids is the smallest, and a row that isn't its digest's
    first fails E. Rows are joined by doc_id and digest, so a text with very many copies doesn't meet in one task.
    """
    text = F.coalesce("text", F.lit(""))
    own = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), *(c.alias(f) for f, c in failing(text).items()),
    )
    own = materialize(own, folder, "judged")
    named = own.where("doc_id is not null")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    mark = lambda c: F.coalesce(F.bool_or(F.col(c) == 1), F.lit(False))
    marks = labels.groupBy("doc_id").agg(mark("quality").alias("good"), mark("toxic").alias("toxic"))
    out = named.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left").withColumn("E", F.col("first").isNull())
    no = {c: F.lit(False) for c in ("E", "good", "toxic")}
    columns = ("row", "part", *FILTERS, "good", "toxic")
    return out.select(*columns).unionByName(own.where("doc_id is null").withColumns(no).select(*columns))


def postings(rows: DataFrame) -> DataFrame:
    """(part, range, n, one array of failing row numbers per filter, good, toxic), each array in ascending order."""
    listed = lambda c: F.sort_array(F.collect_list(F.when(F.col(c), F.col("row")))).alias(c)
    bits = RANGE.bit_length() - 1
    by = rows.groupBy("part", F.shiftright("row", bits).alias("range"))
    return by.agg(F.count("*").alias("n"), *(listed(c) for c in (*FILTERS, "good", "toxic")))


def found(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of a sorted list's numbers, whether the other sorted list has it; ``searchsorted`` goes on from the last place."""
    if not len(short) or not len(long):
        return np.zeros(len(short), bool)
    at = np.searchsorted(long, short)
    at[at == len(long)] = 0
    return long[at] == short


def without(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Difference of two sorted lists: gallops through the longer with the shorter one's numbers."""
    if not len(left) or not len(right):
        return left
    if len(left) <= len(right):
        return left[~found(left, right)]
    stays = np.ones(len(left), bool)
    at = np.searchsorted(left, right)
    inside = at < len(left)
    at, right = at[inside], right[inside]
    stays[at[left[at] == right]] = False
    return left[stays]


def merged(lists: list[np.ndarray]) -> np.ndarray:
    """Union of sorted lists, the longest first; what the others add is put in at its place."""
    first, *others = sorted(lists, key=len, reverse=True)
    for other in others:
        new = without(other, first)
        if len(new):
            first = np.insert(first, np.searchsorted(first, new), new)
    return first


def common(left: np.ndarray, right: np.ndarray) -> int:
    """How many numbers two sorted lists share."""
    return int(found(*sorted((left, right), key=len)).sum())


def sizes(lists: list[np.ndarray], good: np.ndarray, toxic: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(cell, removed, good among them, toxic among them) for each filter after each set of the others; zeros are left out.

    The cell is the set's bits times the number of filters, plus the filter.
    """
    n = len(lists)
    for before in range(1 << n):
        chosen = [lists[i] for i in range(n) if before >> i & 1]
        union = merged(chosen) if chosen else np.zeros(0, np.int64)
        for f in range(n):
            if not before >> f & 1 and len(lists[f]):
                removed = without(lists[f], union)
                if len(removed):
                    yield before * n + f, len(removed), common(removed, good), common(removed, toxic)


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = []
        names = batch.schema.names
        for i in range(batch.num_rows):
            part, n = batch.column(names.index("part"))[i].as_py(), batch.column(names.index("n"))[i].as_py()
            lists = [batch.column(names.index(c))[i].values.to_numpy() for c in (*FILTERS, "good", "toxic")]
            out.append((part, _ROWS, n, 0, 0))
            out += [(part, *x) for x in sizes(lists[: len(FILTERS)], *lists[len(FILTERS) :])]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT) if out else pa.RecordBatch.from_pylist([], _OUT)


def audit(lists: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from :func:`postings`.

    (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)
    """
    n, orders = len(FILTERS), list(permutations(range(len(FILTERS))))
    steps = [(sum(1 << f for f in o[:k]) * n + o[k]) for o in orders for k in range(n)]
    cells = lists.mapInArrow(_sized, "part string, cell int, removed long, good_lost long, toxic_lost long")
    sums = cells.groupBy("part", "cell").agg(*(F.sum(c).alias(c) for c in ("removed", "good_lost", "toxic_lost")))
    by_part = sums.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("cell", F.struct("removed", "good_lost", "toxic_lost")))).alias("m"))  # at most 81 cells
    of = lambda cell, what="removed": F.coalesce(F.col("m")[cell][what], F.lit(0))
    ways = lambda s: factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())  # noqa: E731  (orders in which s comes before a filter)
    values = []  # what depends on the filter alone
    for f in range(n):
        sets = [s for s in range(1 << n) if not s >> f & 1]
        shapley = sum((of(F.lit(s * n + f)) * ways(s) for s in sets), F.lit(0))
        others = (1 << n) - 1 - (1 << f)
        values.append(F.named_struct(F.lit("fails"), of(F.lit(f)), F.lit("alone"), of(F.lit(others * n + f)), F.lit("shapley"), shapley))
    steps_of = by_part.select("part", "m", F.array(*values).alias("v"), F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1))).alias("k"))
    number = F.col("k") % n + 1
    cell = F.element_at(F.lit(steps), F.col("k") + 1)
    path = F.slice(F.lit(steps), F.col("k") - F.col("k") % n + 1, number)
    gone = F.aggregate(path, F.lit(0).cast("long"), lambda acc, c: acc + of(c))
    own = F.element_at("v", F.col("cell") % n + 1)
    return steps_of.select("part", "m", "v", "k", number.alias("step"), cell.alias("cell"), gone.alias("gone")).select(
        "part",
        F.element_at(F.lit(["".join(FILTERS[f] for f in o) for o in orders]), (F.col("k") / n).cast("int") + 1).alias("filter_order"),
        "step",
        (of(F.lit(_ROWS)) - F.col("gone")).alias("kept"),
        of(F.col("cell")).alias("removed"),
        (own["fails"] - of(F.col("cell"))).alias("redundant"),
        own["alone"].alias("unique_fails"),
        of(F.col("cell"), "good_lost").alias("good_lost"),
        of(F.col("cell"), "toxic_lost").alias("toxic_lost"),
        own["shapley"].alias("shapley"),
    )


def run(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``docs`` (doc_id, text, source) against ``labels`` (doc_id, quality, toxic)."""
    return audit(postings(judged(docs, labels, work_dir(docs.sparkSession, "audit"))))


def sql() -> str:
    """DuckDB SQL for :func:`run`: rows counted by the set of filters that they fail."""
    return r"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS bad FROM labels GROUP BY 1),
flags AS (SELECT part, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
  + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
  + 16 * coalesce(b.doc_id > min(b.doc_id) OVER (PARTITION BY t), false)::INT AS mask, coalesce(good, false) AS good, coalesce(bad, false) AS bad
  FROM base b LEFT JOIN marks ON marks.doc_id = b.doc_id),
counted AS (SELECT part, mask, count(*) AS n, count_if(good) AS g, count_if(bad) AS x FROM flags GROUP BY 1, 2),
letter AS (SELECT i::INT AS i, 'ABCDE'[i + 1] AS c FROM range(5) r(i)),
orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o, a.c || b.c || c.c || d.c || e.c AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE list_unique([a.i, b.i, c.i, d.i, e.i]) = 5),
steps AS (SELECT filter_order, (k + 1)::INT AS step, o[k + 1] AS f, list_sum(list_transform(o[1:k], lambda y: 1 << y))::INT AS before FROM orders, range(5) r(k)),
part_step AS (SELECT part, filter_order, step, f, (sum(n) FILTER (mask & (coalesce(before, 0) | (1 << f)) = 0))::BIGINT AS kept,
  (sum(n) FILTER (mask & coalesce(before, 0) = 0 AND mask & (1 << f) <> 0))::BIGINT AS removed,
  (sum(n) FILTER (mask & coalesce(before, 0) <> 0 AND mask & (1 << f) <> 0))::BIGINT AS redundant, (sum(n) FILTER (mask = 1 << f))::BIGINT AS unique_fails,
  (sum(g) FILTER (mask & coalesce(before, 0) = 0 AND mask & (1 << f) <> 0))::BIGINT AS good_lost,
  (sum(x) FILTER (mask & coalesce(before, 0) = 0 AND mask & (1 << f) <> 0))::BIGINT AS toxic_lost FROM counted, steps GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
  coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM part_step"""
