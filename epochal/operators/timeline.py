"""Sums and maxima along each entity's time line, without comparing its rows pairwise.

Questions and facts of an entity meet in one order of time, and what a question wants is a running sum or maximum.
Most keys have few rows and are scanned by a window. A *hot* key, one of the thousand with the most rows over
``CHUNK_ROWS``, is scanned in chunks: its rows are range-partitioned by key and order (Spark cuts at sampled
quantiles, so a chunk is bounded by rows, not by years), each chunk is summed up, and what a chunk needs of earlier ones
enters it as one pre-aggregated row. A key that isn't hot has at most ``CHUNK_ROWS`` rows or a thousandth of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window as W

from ..sources.package import shared_path, ship_package

#: Rows of a chunk, about; the most keys that are scanned in chunks.
CHUNK_ROWS, MOST_HOT = 16_384, 1_000
#: Rows of whole entities that are counted together, about.
ROWS_AT_ONCE = 131_072
_DAY = 86_400_000_000
_NEVER = 2**63 - 1


class Span(NamedTuple):
    """What a row stands for: a span [lo, hi) that counts under each of ``names``, once for each ``code`` if it has one (then one name)."""

    names: tuple[str, ...]
    lo: Column
    hi: Column
    code: Column | None = None
    where: Column | None = None


class Facts(NamedTuple):
    """Rows with an ``entity``, and the spans that each of them stands for; codes have one type."""

    rows: DataFrame
    spans: list[Span]


def micros(c: Column | str) -> Column:
    """Microseconds since the epoch; order and distances are those of the timestamps."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def hot_keys(rows: DataFrame, keys: list[str], each: str | None = None) -> list[Row]:
    """(*keys, n) of the keys with the most rows, if over ``CHUNK_ROWS``; at most ``MOST_HOT``, the largest first. ``each``: a column with what a row counts for."""
    counts = rows.groupBy(*keys).agg((F.sum(each) if each else F.count("*")).alias("n")).where(F.col("n") > CHUNK_ROWS)
    return counts.orderBy(F.desc("n")).limit(MOST_HOT).collect()


def _apart(rows: DataFrame, keys: list[str], hot: list[Row]) -> tuple[DataFrame, DataFrame]:
    """Rows of other keys, and rows of hot keys; nulls are keys like others."""
    kinds = dict(rows.dtypes)
    few = rows.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in hot], ", ".join(f"_{k} {kinds[k]}" for k in keys))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    few = F.broadcast(few)  # at most MOST_HOT rows
    return rows.join(few, same, "left_anti"), rows.join(few, same, "left_semi")


def chunked(rows: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """``rows`` with ``_chunk``: ranges of (*keys, *order) of about ``CHUNK_ROWS`` rows each, of ``n`` rows in all; written once, so that all uses agree."""
    dealt = rows.repartitionByRange(max(1, -(-n // CHUNK_ROWS)), *keys, *order).withColumn("_chunk", F.spark_partition_id())
    path = shared_path(rows.sparkSession, "chunks")
    dealt.write.parquet(path)
    return rows.sparkSession.read.schema(dealt.schema).parquet(path)


def _scan(rows: DataFrame, keys: list[str], order: list[Column | str], values: dict[str, tuple], inclusive: bool) -> DataFrame:
    until = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    return rows.select("*", *(f(c).over(until).alias(n) for n, (f, c) in values.items()))


def _scan_chunks(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, tuple], inclusive: bool) -> DataFrame:
    """``rows`` have ``_chunk``; an earlier chunk's rows enter as one, before the chunk's own."""
    parts = rows.select("*", *(c.alias(f"_v_{n}") for n, (_, c) in values.items()))
    kinds = {n: f for n, (f, _) in values.items()}
    own = parts.groupBy(*keys, "_chunk").agg(*(f(f"_v_{n}").alias(n) for n, f in kinds.items()))
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)  # a row for each chunk
    carried = own.select(*keys, "_chunk", *(f(n).over(before).alias(f"_v_{n}") for n, f in kinds.items()), F.lit(0).alias("_own"))
    both = parts.withColumn("_own", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    out = _scan(both, [*keys, "_chunk"], ["_own", *order], {n: (f, F.col(f"_v_{n}")) for n, f in kinds.items()}, inclusive)
    return out.where("_own = 1").drop("_own", "_chunk", *(f"_v_{n}" for n in values))


def running(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, tuple], inclusive: bool = True, hot: list[Row] | None = None) -> DataFrame:
    """``rows`` with aggregates over all rows of the key up to each row, in ascending ``order``.

    ``values`` are (aggregate, column) of sums, maxima or minima by result name. Rows before a row count, and the row
    itself if ``inclusive``. ``hot`` are the hot keys where they are known; rows of a hot key that tie in ``order`` share a chunk.
    """
    hot = hot_keys(rows, keys) if hot is None else hot
    if not hot:
        return _scan(rows, keys, order, values, inclusive)
    few, many = _apart(rows, keys, hot)
    cut = chunked(many, keys, order, sum(r["n"] for r in hot))
    return _scan(few, keys, order, values, inclusive).unionByName(_scan_chunks(cut, keys, order, values, inclusive))


def _ends(spans: DataFrame) -> DataFrame:
    """(entity, name, at, d): +1 where a span starts, -1 where it ends; one that ends before it starts is undone at its start."""
    end = F.when(F.col("hi").isNotNull(), F.greatest("lo", "hi"))
    return _steps(spans.where("lo is not null"), (F.col("lo"), 1), (end, -1))


def _steps(rows: DataFrame, *steps: tuple[Column, int]) -> DataFrame:
    each = F.explode(F.array(*(F.struct(at.alias("at"), F.lit(d).alias("d")) for at, d in steps)))
    return rows.select("entity", "name", each.alias("x")).select("entity", "name", "x.*").where("at is not null")


def _merged_ends(spans: DataFrame, look: bool) -> DataFrame:
    """The same for spans (entity, name, code, lo, hi), those of one code that overlap or touch made one.

    In the order of starts, a span opens a new one if it starts after all earlier ones of its code have ended; it
    tells then where the one before ended, and a code's last row where the last one ends. ``look`` for hot codes; without
    it, entities are whole in their tasks, also in the result.
    """
    keys = ["entity", "name", "code"]
    rows = spans.where("lo is not null and (hi is null or lo < hi)").select(*keys, "lo", F.coalesce("hi", F.lit(_NEVER)).alias("hi"))
    hot = hot_keys(rows, keys) if look else []
    rows = rows if look else rows.repartition("entity")
    if hot:  # one row for each start, so that a chunk ends anywhere
        rows = rows.groupBy(*keys, "lo").agg(F.max("hi").alias("hi"))
        last = rows.groupBy(*keys).agg(F.max("hi").alias("lo"))
        closes = F.lit(None).cast("long")
    else:
        rows = rows.withColumn("last", F.lead("lo").over(W.partitionBy(*keys).orderBy("lo")).isNull())
        closes = F.when(F.col("last"), F.nullif(F.greatest("until", "hi"), F.lit(_NEVER)))
    seen = running(rows, keys, ["lo"], {"until": (F.max, F.col("hi"))}, inclusive=False, hot=hot)
    opens = F.col("until").isNull() | (F.col("lo") > F.col("until"))
    out = _steps(seen, (F.when(opens, F.col("lo")), 1), (F.when(opens, F.col("until")), -1), (closes, -1))
    return out.unionByName(_steps(last, (F.nullif(F.col("lo"), F.lit(_NEVER)), -1))) if hot else out


def spans_of(facts: Facts) -> list[DataFrame]:
    """A table (entity, name, [code], lo, hi) for each span and name that rows stand for."""
    out = []
    for s in facts.spans:
        rows, code = facts.rows if s.where is None else facts.rows.where(s.where), [] if s.code is None else [s.code.alias("code")]
        out += [rows.select("entity", F.lit(n).alias("name"), *code, s.lo.alias("lo"), s.hi.alias("hi")) for n in s.names]
    return out


def _numbers(c: pa.ChunkedArray, none: int) -> np.ndarray:
    return c.fill_null(none).to_numpy()


def _answered(rows: pa.Table, layout: list[list[tuple]], names: tuple[str, ...]) -> pa.RecordBatch:
    """Ids and counts of the questions (bit 0) among ``rows``, which are of whole entities and in their order.

    A span reaches from the first question that it holds to the first behind it, both places in the order of entity and
    instant; counts are running sums over these places. Of a code's spans, each stands for its part beyond the latest end
    of those that start before.
    """
    bits, entity = rows["bits"].to_numpy(), np.cumsum(rows["nth"].to_numpy() == 1)
    asked = np.flatnonzero(bits == 1)
    instants, place = np.unique(_numbers(rows["t0"], -_NEVER)[asked], return_inverse=True)
    own = entity[asked] * (len(instants) + 1) + place
    order = np.argsort(own)
    own, n = own[order], len(order)
    steps = np.zeros((len(names), n + 1), np.int64)
    step = lambda first, last: np.bincount(first, minlength=n + 1) - np.bincount(last, minlength=n + 1)
    of_codes: dict[int, list] = {}
    for spans in layout:
        used = np.flatnonzero(bits & sum(bit for bit, *_ in spans))
        base, has = entity[used] * (len(instants) + 1), bits[used]
        places = {t: np.searchsorted(own, base + np.searchsorted(instants, _numbers(rows[t], _NEVER)[used])) for t in {t for _, _, lo, hi, _ in spans for t in (lo, hi)}}
        for bit, counted, lo, hi, code in spans:
            held = np.flatnonzero((has & bit != 0) & (places[lo] < places[hi]))
            first, last = places[lo][held], places[hi][held]
            if code is None:
                steps[counted] += step(first, last)
            else:
                of_codes.setdefault(counted[0], []).append((rows[code].take(pa.array(used[held])).combine_chunks(), first, last))
    for i, parts in of_codes.items():
        codes = pa.concat_arrays([code for code, *_ in parts])
        number = codes.dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64) * (n + 1)
        first, last = (np.concatenate([p[x] for p in parts]) + number for x in (1, 2))
        order_of_code = np.argsort(first)
        first, last = first[order_of_code], last[order_of_code]
        first[1:] = np.maximum(first[1:], np.maximum.accumulate(last)[:-1])  # ends of other entities and codes are no later
        beyond = first < last
        steps[i] += step(first[beyond] % (n + 1), last[beyond] % (n + 1))
    counts = np.cumsum(steps[:, :n], axis=1)
    ids = rows["id"].take(pa.array(asked[order])).combine_chunks()
    return pa.RecordBatch.from_arrays([ids, *map(pa.array, counts)], ["id", *names])


def _answers(batches: Iterator[pa.RecordBatch], layout: list[list[tuple]], names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Entities come one after another; those that are complete are answered together, the last one is kept for the next rows."""
    kept, n = [], 0
    for batch in batches:
        kept.append(batch)
        n += batch.num_rows
        if n >= ROWS_AT_ONCE:
            rows = pa.Table.from_batches(kept).combine_chunks()
            begun = np.flatnonzero(rows["nth"].to_numpy() == 1)[-1]
            if begun:
                yield _answered(rows[:begun], layout, names)
                kept, n = rows[begun:].to_batches(), rows.num_rows - begun
    if n:
        yield _answered(pa.Table.from_batches(kept).combine_chunks(), layout, names)


def _among(known: list[Column], c: Column, kind: str) -> str:
    """The name of a column among those of its kind; one that several spans share is sent once."""
    found = [i for i, k in enumerate(known) if k is c]
    if not found:
        known.append(c)
    return f"{kind}{found[0] if found else len(known) - 1}"


def _count_facts(questions: DataFrame, tables: list[Facts], names: tuple[str, ...]) -> DataFrame:
    """The counts of :func:`count_covering` without hot entities. Each row is sent once, to its entity's task; its spans are made there."""
    ship_package(questions.sparkSession)
    sent, layout, bit = [], [], 1
    for t in tables:
        instants, codes, bits, spans = [], [], [], []
        for s in t.spans:
            bit *= 2
            own = F.lit(True) if s.where is None else s.where
            bits.append(F.when(own & (s.lo < F.coalesce(s.hi, F.lit(_NEVER))), F.lit(bit)).otherwise(0).cast("long"))
            spans.append((bit, [names.index(n) for n in s.names], _among(instants, s.lo, "t"), _among(instants, s.hi, "t"), None if s.code is None else _among(codes, s.code, "c")))
        made = [c.alias(f"{kind}{i}") for kind, known in (("t", instants), ("c", codes)) for i, c in enumerate(known)]
        sent.append(t.rows.repartition("entity").select("entity", reduce(Column.__add__, bits).alias("bits"), *made))
        layout.append(spans)
    asked = questions.select("entity", "id", "at").repartition("entity").select("entity", F.lit(1).cast("long").alias("bits"), "id", F.col("at").alias("t0"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*sent, asked])
    # entities are whole and in order: a row's place in its entity needs both
    nth = F.count("*").over(W.partitionBy("entity").rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = rows.withColumn("nth", nth).sortWithinPartitions("entity").drop("entity")
    kinds = [questions.select("id").schema[0], *(StructField(n, LongType()) for n in names)]
    return rows.mapInArrow(lambda batches: _answers(batches, layout, names), StructType(kinds))


def count_covering(questions: DataFrame, spans: DataFrame | list[DataFrame] | list[Facts], names: tuple[str, ...]) -> DataFrame:
    """(id, one count per name): spans [lo, hi) of the entity that hold a question's instant ``at``.

    ``questions`` are (id, entity, at), ``spans`` tables of (entity, name, lo, hi) with a null hi for no end, all
    instants in microseconds; one without a start holds nothing. A table may have a ``code``: spans of one name and code
    count once. A span is +1 at its start and -1 at its end, so a count is a running sum. Without hot entities each span is
    sent once, to its entity's task: its steps are made, merged and scanned there. Of :class:`Facts`, whose rows stand for several
    spans and whose spans may have several names, each row is sent once, and only questions are put in order.
    """
    tables = [spans] if isinstance(spans, DataFrame) else spans
    both = lambda frames: reduce(DataFrame.unionByName, frames)
    packed = isinstance(tables[0], Facts)
    if packed:
        hot = hot_keys(both([t.rows.select("entity", F.lit(sum(len(s.names) for s in t.spans)).alias("n")) for t in tables]), ["entity"], "n")
        tables = [x for t in tables for x in spans_of(t)] if hot else tables
    else:
        hot = hot_keys(both([t.select("entity") for t in tables]), ["entity"])
    if packed and not hot:
        return _count_facts(questions, tables, names)
    plain, coded = ([t for t in tables if ("code" in t.columns) == kind] for kind in (False, True))
    number = reduce(lambda c, n: c.when(F.col("name") == n, F.lit(names.index(n)).cast("byte")), names[1:], F.when(F.col("name") == names[0], F.lit(0).cast("byte")))
    plain, coded = ([t.withColumn("name", number) for t in some] for some in (plain, coded))
    sent = [both(plain) if hot else both(plain).where("lo is not null").select("entity", "name", "lo", "hi").repartition("entity")] if plain else []
    steps = both([*map(_ends, sent), *([_merged_ends(both(coded), bool(hot))] if coded else [])])
    own = {f"_{n}": F.when(F.col("name") == i, F.col("d")).otherwise(0) for i, n in enumerate(names)}
    if hot:  # one row for each instant, so that a chunk ends anywhere
        steps = steps.groupBy("entity", "at").agg(*(F.sum(c).alias(n) for n, c in own.items()))
        own = {n: F.coalesce(n, F.lit(0)) for n in own}
    else:
        steps = steps.select("entity", "at", "name", F.col("d").cast("byte").alias("d"))
    asked = questions.select("entity", "at", "id", F.lit(1).alias("kind"))
    asked = asked if hot else asked.repartition("entity")
    rows = steps.withColumn("kind", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    out = running(rows, ["entity"], ["at", "kind", "id"], dict(zip(names, ((F.sum, c) for c in own.values()), strict=True)), hot=hot)
    return out.where("kind = 1").select("id", *(F.col(n).cast("long").alias(n) for n in names))


def latest_within(questions: DataFrame, facts: DataFrame, width_days: int) -> DataFrame:
    """(id, value): the largest ``value`` of the entity's facts in (at, at + width], null without one.

    With time cut into stretches as long as the width, such a range is the rest of one and the head of the next: two
    running maxima, one of them backwards.
    """
    width, keys = width_days * _DAY, ["entity", "stretch", "back"]
    stretch = F.floor(F.col("at") / width)
    f = facts.groupBy("entity", "at").agg(F.max("value").alias("value")).withColumn("kind", F.lit(0))
    q = questions.select("entity", "at", "id", F.lit(1).alias("kind"))
    ahead = q.withColumn("at", F.col("at") + width)
    sides = [
        f.unionByName(ahead, allowMissingColumns=True).select("*", stretch.alias("stretch"), F.lit(False).alias("back")),  # facts up to the end count
        f.unionByName(q, allowMissingColumns=True).select("entity", (-F.col("at")).alias("at"), "value", (-F.col("kind")).alias("kind"), "id", stretch.alias("stretch"), F.lit(True).alias("back")),
    ]
    hot = hot_keys(facts.unionByName(questions, allowMissingColumns=True).select("entity", stretch.alias("stretch")), ["entity", "stretch"])
    hot = [Row(**r.asDict(), back=b) for r in hot for b in (False, True)][:MOST_HOT]
    seen = running(reduce(DataFrame.unionByName, sides), keys, ["at", "kind", "id"], {"best": (F.max, F.col("value"))}, hot=hot).where("kind <> 0")
    return seen.groupBy("id").agg(F.max("best").alias("value"))
