"""Counts of an index stay's history in a look-back window, as spans that cover the stay's start.

The window of a stay that starts at t is [add_months(date of t, -12 * years), t). Whether a fact counts for t
is a condition on t alone: from a first instant on, and up to the last date whose window still reaches it.
So a fact is a span of instants, a count is the number of spans that cover t, and a count of distinct codes
is that of each code's merged spans; a null code counts for nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import timeline
from .timeline import Facts, Span, micros

# fixed values: names of the counts, in the order of the feature table
NAMES = (
    "prior_encounter_count", "prior_inpatient_count", "prior_emergency_count", "active_condition_count",
    "active_medication_count", "procedure_count_window", "active_careplan_count", "observation_count_window",
)


def reached_until(c: Column | str, years: int = 1) -> Column:
    """The first instant whose window no longer holds ``c``: midnight after the last date that looks back so far.

    Of a month's last days several dates may look back to one date, or none; the later of two candidates is right.
    """
    day, months = F.to_date(c), 12 * years
    last = F.greatest(F.add_months(day, months), F.date_sub(F.add_months(F.date_add(day, 1), months), 1))
    return micros(F.date_add(last, 1).cast("timestamp_ntz"))


def after(c: Column | str) -> Column:
    """The first instant later than ``c``."""
    return micros(c) + 1


def encounters(stays: DataFrame) -> DataFrame:
    """Finished encounters that started in the window: all, inpatient and emergency ones."""
    named = F.array_compact(F.array(
        F.lit("prior_encounter_count"), F.when(F.col("class") == "inpatient", "prior_inpatient_count"), F.when(F.col("class") == "emergency", "prior_emergency_count")
    ))
    done = stays.where("stop is not null")
    return done.select("entity", F.explode(named).alias("name"), F.greatest(after("start"), micros("stop")).alias("lo"), reached_until("start").alias("hi"))


def encounter_facts(stays: DataFrame) -> Facts:
    """The same as facts that are sent once each."""
    lo, hi, kind = F.greatest(after("start"), micros("stop")), reached_until("start"), F.coalesce("class", F.lit(""))
    span = lambda where, *more: Span(("prior_encounter_count", *more), lo, hi, where=where)
    spans = [span(kind == "inpatient", "prior_inpatient_count"), span(kind == "emergency", "prior_emergency_count"), span(~kind.isin("inpatient", "emergency"))]
    return Facts(stays.where("stop is not null").select("entity", "class", "start", "stop"), spans)


def started_span(names: tuple[str, ...], where: Column | None = None) -> Span:
    """The span of a fact that started in the window."""
    return Span(names, after("start"), reached_until("start"), where=where)


def code_span(name: str, by_day: bool, where: Column | None = None) -> Span:
    """The span of a code's record that began before t and had not ended before the window; ``by_day``: before the day of t."""
    begins = micros(F.date_add(F.to_date("start"), 1).cast("timestamp_ntz")) if by_day else after("start")
    known = F.col("code").isNotNull()
    return Span((name,), begins, reached_until("stop"), F.col("code"), known if where is None else known & where)


def started(facts: DataFrame, name: str) -> DataFrame:
    return timeline.spans_of(Facts(facts, [started_span((name,))]))[0]


def active_codes(facts: DataFrame, name: str, by_day: bool) -> DataFrame:
    return timeline.spans_of(Facts(facts, [code_span(name, by_day)]))[0]


def spans_of(roles: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Spans by name of the count; the three counts of encounters come together."""
    return {
        "prior_": encounters(roles["stays"]),
        "active_condition_count": active_codes(roles["conditions"], "active_condition_count", True),
        "active_careplan_count": active_codes(roles["careplans"], "active_careplan_count", True),
        "active_medication_count": active_codes(roles["medications"], "active_medication_count", False),
        "procedure_count_window": started(roles["procedures"], "procedure_count_window"),
        "observation_count_window": started(roles["observations"], "observation_count_window"),
    }


def counts(index: DataFrame, spans: DataFrame | list[DataFrame] | list[Facts], names: tuple[str, ...] = NAMES) -> DataFrame:
    """(id, one column per name) for index rows (id, entity, start), 0 where nothing is covered."""
    return timeline.count_covering(index.select("id", "entity", micros("start").alias("at")), spans, names)


def all_counts(index: DataFrame, roles: dict[str, DataFrame]) -> DataFrame:
    return counts(index, list(spans_of(roles).values()))
