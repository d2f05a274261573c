"""Queries over stays, outcomes, look-back features, the feature table and its split."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import enrich, fingerprint, intervals, lookback, split
from ..sources import tables
from ..sources.adapter import PLANNED_CODES, REFERENCE_END, TEST_START, Roles, instant
from . import registry
from .registry import query


class Plans(registry.Plans):
    @cached_property
    def lines(self) -> DataFrame:
        """Five roles are made of the lines, so the join runs once."""
        return self.landed("lines", lambda: Roles.lines.func(self))

    @cached_property
    def flagged(self) -> DataFrame:
        return self.landed("flagged", lambda: intervals.flag_stays(self.stays, self.procedures, PLANNED_CODES, reference_end=instant(REFERENCE_END)))

    @cached_property
    def candidates(self) -> DataFrame:
        return intervals.index_candidates(self.flagged)

    @cached_property
    def labelled(self) -> DataFrame:
        return intervals.outcome(self.candidates, self.flagged)

    @cached_property
    def horizons(self) -> DataFrame:
        return intervals.label_horizon(self.candidates, self.flagged, instant(REFERENCE_END))

    @cached_property
    def index(self) -> DataFrame:
        return self.landed("index", lambda: intervals.observable(self.labelled, self.entities, instant(REFERENCE_END)))

    @cached_property
    def spans(self) -> dict[str, DataFrame]:
        return lookback.spans_of({n: getattr(self, n) for n in ("stays", "conditions", "careplans", "medications", "procedures", "observations")})

    @cached_property
    def counts(self) -> DataFrame:
        return lookback.counts(self.index, self.parts)

    @cached_property
    def gold(self) -> DataFrame:
        return self.landed("gold", lambda: enrich.gold_table(self.index, self.horizons, self.counts, entities=self.entities, payers=self.payers, suppliers=self.suppliers))

    @cached_property
    def split(self) -> DataFrame:
        return self.landed("split", lambda: split.chronological_split(self.gold, instant(TEST_START), instant(REFERENCE_END)))

    @cached_property
    def scored(self) -> DataFrame:
        """The split with a reproducible score p."""
        return self.split.withColumn("p", (F.col("encounter_id") * 7919 % 1000 + F.lit(0.5)) / 1000 * 0.11)

    @cached_property
    def test(self) -> DataFrame:
        return self.scored.where("partition = 'test'")


registry.Plans = Plans  # queries below and in other modules get the tables that are defined here


@query("scan_typed", """SELECT count(*)::BIGINT AS n, sum(o_totalprice)::DECIMAL(38,2) AS total, min(o_orderdate) AS first, count(DISTINCT o_custkey) AS n_entities,
(SELECT count(*) FROM nation)::BIGINT AS n_nations FROM orders""")
def scan_typed(p):
    """Tables as CSV, read by position with their declared schemas; a missing or an empty one would be refused."""
    folder, wanted = p.shared_path("csv"), ("orders", "nation")
    for name in wanted:
        p.raw(name).write.option("header", True).csv(f"{folder}/{name}.csv")
    found = tables.load_tables(p.spark, folder, {n: p.raw(n).schema for n in wanted}, set(wanted))
    totals = found["orders"].agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"), F.min("o_orderdate").alias("first"), F.countDistinct("o_custkey").alias("n_entities"))
    return totals.crossJoin(F.broadcast(found["nation"].agg(F.count("*").alias("n_nations"))))  # one row each


@query("source_audit", """SELECT 'orders' AS table_name, count(*)::BIGINT AS n, 'ok' AS status FROM orders UNION ALL SELECT 'lineitem', count(*), 'ok' FROM lineitem
UNION ALL SELECT 'customer', count(*), 'ok' FROM customer UNION ALL SELECT 'supplier', count(*), 'ok' FROM supplier""")
def source_audit(p):
    names = ("orders", "lineitem", "customer", "supplier")
    return tables.audit({n: p.raw(n) for n in names}, set(names))


@query("alive_count", "SELECT count(*)::BIGINT AS n_alive FROM ent WHERE death IS NULL")
def alive_count(p):
    return p.entities.where("death is null").agg(F.count("*").alias("n_alive"))


_FLAG = "SELECT id, {0} FROM flg"
for _name, _column in (("planned_flag", "is_planned"), ("terminal_flag", "is_terminal"), ("continuation_flag", "is_continuation")):
    query(_name, _FLAG.format(_column))(lambda p, c=_column: p.flagged.select("id", c))


@query("stay_stats", """SELECT count(*)::BIGINT AS n_stays, count_if(is_planned)::BIGINT AS n_planned, count_if(is_continuation)::BIGINT AS n_continuation,
count_if(NOT is_terminal)::BIGINT AS n_non_terminal, count_if(stop IS NULL)::BIGINT AS n_open FROM flg""")
def stay_stats(p):
    return p.flagged.agg(
        F.count("*").alias("n_stays"),
        F.count_if("is_planned").alias("n_planned"),
        F.count_if("is_continuation").alias("n_continuation"),
        F.count_if(~F.col("is_terminal")).alias("n_non_terminal"),
        F.count_if(F.col("stop").isNull()).alias("n_open"),
    )


@query("index_candidates", "SELECT id, entity, stop, deadline FROM cand")
def index_candidates(p):
    return p.candidates.select("id", "entity", "stop", "deadline")


@query("readmit_label", "SELECT id, label FROM lab")
def readmit_label(p):
    return p.labelled.select("id", "label")


@query("readmit_label_window", "SELECT id, label FROM lab")
def readmit_label_window(p):
    return intervals.last_start(p.candidates, p.flagged).select("id", F.col("last_start").isNotNull().cast("int").alias("label"))


@query("label_horizon", "SELECT id, label_horizon FROM hor")
def label_horizon(p):
    return p.horizons


@query("observable_index", "SELECT id, entity, start, stop, deadline, label FROM obs")
def observable_index(p):
    return p.index.select("id", "entity", "start", "stop", "deadline", "label")


def _lookback(name):
    return lambda p: lookback.counts(p.index, next(f for k, f in p.spans.items() if name.startswith(k)), (name,))


for _key, _name in (
    ("lb_prior_encounters", "prior_encounter_count"), ("lb_prior_inpatient", "prior_inpatient_count"), ("lb_prior_emergency", "prior_emergency_count"),
    ("lb_active_conditions", "active_condition_count"), ("lb_active_careplans", "active_careplan_count"), ("lb_active_medications", "active_medication_count"),
    ("lb_procedures", "procedure_count_window"), ("lb_observations", "observation_count_window"),
):
    query(_key, f"SELECT id, {_name} FROM lb")(_lookback(_name))
query("lb_all", "SELECT * FROM lb")(lambda p: p.counts)


@query("dim_attributes", """SELECT o.id, ownership AS payer_ownership, specialty AS provider_specialty, utilization AS organization_utilization
FROM obs o LEFT JOIN pay ON pay.id = o.payer LEFT JOIN sup ON sup.id = o.provider""")
def dim_attributes(p):
    return enrich.with_star(p.index, payers=p.payers, suppliers=p.suppliers).select("id", "payer_ownership", "provider_specialty", "organization_utilization")


@query("age_at_index", "SELECT encounter_id, round(age_at_index_years, 9) AS age FROM gold")
def age_at_index(p):
    born = p.entities.select(F.col("id").alias("entity"), "birth")
    return p.index.join(born, "entity", "left").select(F.col("id").alias("encounter_id"), F.round(enrich.age_years(F.col("start"), F.col("birth")), 9).alias("age"))


@query("length_of_stay", "SELECT id, round((epoch_us(stop) - epoch_us(start)) / 86400000000.0, 9) AS days FROM obs")
def length_of_stay(p):
    return p.index.select("id", F.round(enrich.stay_days(F.col("start"), F.col("stop")), 9).alias("days"))


_GOLD = "SELECT * REPLACE (round(age_at_index_years, 9) AS age_at_index_years) FROM gold"
_rounded = lambda g: g.withColumn("age_at_index_years", F.round("age_at_index_years", 9))
query("gold_table", _GOLD)(lambda p: _rounded(p.gold))


@query("gold_stats", "SELECT count(*)::BIGINT AS n_rows, sum(is_readmitted)::BIGINT AS n_positive FROM gold")
def gold_stats(p):
    return p.gold.agg(F.count("*").alias("n_rows"), F.sum("is_readmitted").alias("n_positive"))


@query("prepare_features", """SELECT encounter_id, organization_utilization::DOUBLE AS organization_utilization, prior_encounter_count::DOUBLE AS prior_encounter_count,
prior_inpatient_count::DOUBLE AS prior_inpatient_count, prior_emergency_count::DOUBLE AS prior_emergency_count, active_condition_count::DOUBLE AS active_condition_count,
active_medication_count::DOUBLE AS active_medication_count, procedure_count_window::DOUBLE AS procedure_count_window, active_careplan_count::DOUBLE AS active_careplan_count,
observation_count_window::DOUBLE AS observation_count_window, round(age_at_index_years, 9) AS age_at_index_years, coalesce(admission_reason_code, 'MISSING') AS admission_reason_code,
coalesce(payer_ownership, 'MISSING') AS payer_ownership, coalesce(provider_specialty, 'MISSING') AS provider_specialty, coalesce(gender, 'MISSING') AS gender,
coalesce(race, 'MISSING') AS race, coalesce(marital_status, 'MISSING') AS marital_status FROM gold""")
def prepare_features(p):
    return _rounded(enrich.prepare_features(p.gold))


query("chrono_split", "SELECT encounter_id, partition FROM spl")(lambda p: p.split.select("encounter_id", "partition"))


@query("split_summary", """SELECT count(*)::BIGINT AS n_input, count_if(partition = 'censored')::BIGINT AS n_dropped_censored, 0::BIGINT AS n_dropped_before_train_start,
count_if(partition = 'label_window')::BIGINT AS n_dropped_label_window, count_if(partition = 'label_horizon')::BIGINT AS n_dropped_label_horizon,
count_if(partition = 'patient_overlap')::BIGINT AS n_dropped_patient_overlap, """ + ", ".join(f"""count_if(partition = '{s}')::BIGINT AS n_{s},
count_if(partition = '{s}' AND is_readmitted = 1)::BIGINT AS n_{s}_positive, round(avg(is_readmitted) FILTER (partition = '{s}'), 9) AS {s}_positive_rate,
count(DISTINCT patient_id) FILTER (partition = '{s}') AS n_{s}_patients, min(index_start) FILTER (partition = '{s}') AS {s}_start_min,
max(index_start) FILTER (partition = '{s}') AS {s}_start_max""" for s in ("train", "test")) + " FROM spl")  # fmt: skip
def split_summary(p):
    out = split.split_summary(p.split)
    return out.withColumns({f"{s}_positive_rate": F.round(f"{s}_positive_rate", 9) for s in ("train", "test")})


@query("split_consistency", """SELECT count_if(partition = 'test' AND index_start < TIMESTAMP '2000-01-01')::BIGINT AS n_test_early,
count_if(partition = 'train' AND index_start >= TIMESTAMP '2000-01-01')::BIGINT AS n_train_late,
(SELECT count(*) FROM (SELECT patient_id FROM spl WHERE partition IN ('train', 'test') GROUP BY 1 HAVING count(DISTINCT partition) > 1))::BIGINT AS n_entities_both,
(SELECT count_if(encounter_id % 11 = 0) FROM spl)::BIGINT AS n_absent FROM spl WHERE partition IN ('train', 'test')""")
def split_consistency(p):
    """The split as it is, and an assignment some of whose ids the feature table lacks (moved to negative numbers)."""
    stored = p.split.select(F.when(F.col("encounter_id") % 11 == 0, -F.col("encounter_id") - 1).otherwise(F.col("encounter_id")).alias("encounter_id"), "partition")
    absent = split.absent_ids(stored, p.gold)
    return split.split_consistency(p.split, instant(TEST_START)).crossJoin(F.broadcast(absent))  # one row each


@query("assignment_parity", """SELECT count_if(encounter_id % 13 = 0)::BIGINT AS only_stored, count_if(encounter_id % 17 = 0 AND encounter_id % 13 <> 0)::BIGINT AS only_computed,
count_if(encounter_id % 13 <> 0 AND encounter_id % 17 <> 0 AND partition = 'train' AND encounter_id % 2 = 0)::BIGINT AS other_side FROM spl WHERE partition IN ('train', 'test')
AND NOT (encounter_id % 13 = 0 AND encounter_id % 17 = 0)""")
def assignment_parity(p):
    """A stored assignment against a computed one; each lacks some ids, and some stored ids are on the other side."""
    computed = p.split.where("partition in ('train', 'test')").select("encounter_id", "partition")
    moved = F.when((F.col("partition") == "train") & (F.col("encounter_id") % 2 == 0), "test").otherwise(F.col("partition"))
    stored = computed.where("encounter_id % 17 <> 0").select("encounter_id", moved.alias("partition"))
    return split.assignment_parity(stored, computed.where("encounter_id % 13 <> 0"))


@query("grouped_folds", "SELECT encounter_id, (('0x' || substr(md5(patient_id::VARCHAR), 1, 8))::BIGINT % 5)::INT AS fold FROM spl WHERE partition = 'train'")
def grouped_folds(p):
    return split.grouped_folds(p.split.where("partition = 'train'"), 5).select("encounter_id", "fold")


@query("balanced_folds", """SELECT encounter_id, len(list_filter(range(5), lambda f: list_sum(counts[1:f + 1]) <= r))::INT AS fold FROM (SELECT * FROM spl WHERE partition = 'train') t
JOIN (SELECT patient_id, n, row_number() OVER (PARTITION BY n ORDER BY md5(patient_id::VARCHAR)) - 1 AS r FROM bsz) USING (patient_id) JOIN (SELECT n, counts FROM bfd WHERE i > 0) USING (n)""",
"""bsz AS MATERIALIZED (SELECT patient_id, count(*)::BIGINT AS n FROM spl WHERE partition = 'train' GROUP BY 1),
bhs AS MATERIALIZED (SELECT n, count(*)::BIGINT AS m, row_number() OVER (ORDER BY n DESC) AS i FROM bsz GROUP BY n),
bfd AS MATERIALIZED (WITH RECURSIVE st AS (SELECT 0::BIGINT AS i, 0::BIGINT AS n, [0, 0, 0, 0, 0]::BIGINT[] AS counts, [0, 0, 0, 0, 0]::BIGINT[] AS loads
UNION ALL SELECT i, n, c, list_transform(range(5), lambda f: loads[f + 1] + n * c[f + 1]) FROM (SELECT *, list_transform(range(5), lambda f: len(list_filter(e, lambda x: x.f = f))) AS c
FROM (SELECT h.i, h.n, loads, list_sort(flatten(list_transform(range(5), lambda f: list_transform(range(h.m), lambda j: {'w': loads[f + 1] + j * h.n, 'f': f}))))[1:h.m] AS e FROM st JOIN bhs h ON h.i = st.i + 1)))
SELECT * FROM st)""")
def balanced_folds(p):
    return split.balanced_folds(p.split.where("partition = 'train'"), 5).select("encounter_id", "fold")


@query("held_out_window", """SELECT encounter_id, (SELECT count_if(partition = 'train') FROM spl WHERE index_stop >= TIMESTAMP '2000-12-05' AND index_stop < TIMESTAMP '2000-12-12')::BIGINT AS n_train
FROM spl WHERE partition = 'test' AND index_stop >= TIMESTAMP '2000-12-05' AND index_stop < TIMESTAMP '2000-12-12'""")
def held_out_window(p):
    rows, gate = split.held_out_window(p.split, instant("2000-12-05"), instant("2000-12-12"))
    return rows.select("encounter_id").crossJoin(F.broadcast(gate.select("n_train")))  # a gate is one row


@query("fingerprint", """SELECT sha256(coalesce(sum(('0x' || substr(h, 1, 15))::BIGINT::DECIMAL(38,0)), 0)::VARCHAR || '|' || coalesce(sum(('0x' || substr(h, 16, 15))::BIGINT::DECIMAL(38,0)), 0)::VARCHAR
|| '|' || count(*)::VARCHAR) AS fingerprint, count(*)::BIGINT AS n_rows FROM (SELECT sha256(concat_ws(chr(31),
'admission_reason_code=' || coalesce(length(admission_reason_code) || ':' || admission_reason_code, 'null'), 'encounter_id=' || length(encounter_id::VARCHAR) || ':' || encounter_id,
'index_stop=26:' || strftime(index_stop, '%Y-%m-%dT%H:%M:%S.%f'), 'is_readmitted=1:' || is_readmitted)) AS h FROM gold)""")
def fingerprint_(p):
    return fingerprint.fingerprint(p.gold.select("admission_reason_code", "encounter_id", "index_stop", "is_readmitted"))


@query("table_diff", """SELECT column_name, CASE column_name WHEN 'is_readmitted' THEN n ELSE 0 END AS n_different, l AS n_only_left, r AS n_only_right
FROM (SELECT unnest(['patient_id', 'is_readmitted']) AS column_name), (SELECT count_if(encounter_id % 5 = 0 AND encounter_id % 7 <> 0 AND encounter_id % 3 <> 0)::BIGINT AS n,
count_if(encounter_id % 7 = 0 AND encounter_id % 3 <> 0)::BIGINT AS l, count_if(encounter_id % 3 = 0 AND encounter_id % 7 <> 0)::BIGINT AS r FROM gold)""")
def table_diff(p):
    g = p.gold.select("encounter_id", "patient_id", "is_readmitted")
    other = g.where("encounter_id % 7 <> 0").withColumn("is_readmitted", F.when(F.col("encounter_id") % 5 == 0, 1 - F.col("is_readmitted")).otherwise(F.col("is_readmitted")))
    return fingerprint.table_diff(g.where("encounter_id % 3 <> 0"), other, "encounter_id")


_VERDICT = """SELECT column_name, n_different, max_ulp, n_beyond, l AS n_only_left, r AS n_only_right,
CASE WHEN n_beyond + l + r > 0 THEN 'content' WHEN n_different > 0 THEN 'serialisation' ELSE 'equal' END AS kind FROM (
SELECT 'p' AS column_name, count_if(p <> p2)::BIGINT AS n_different, max(CASE WHEN p <> p2 THEN abs(p2 - p) / pow(2, floor(log2(p)) - 52) END)::BIGINT AS max_ulp, count_if(p <> p2)::BIGINT AS n_beyond FROM vcl
UNION ALL SELECT 'q', count_if(p <> q2)::BIGINT, max(CASE WHEN p <> q2 THEN abs(q2 - p) / pow(2, floor(log2(p)) - 52) END)::BIGINT, 0::BIGINT FROM vcl
UNION ALL SELECT 'is_readmitted', 0::BIGINT, NULL, 0::BIGINT), (SELECT 0::BIGINT AS l, 0::BIGINT AS r)"""


@query("table_diff_ulp", _VERDICT, """vcl AS (SELECT p, CASE WHEN encounter_id % 70 = 0 THEN p + 1e-9 ELSE p END AS p2, CASE WHEN encounter_id % 5 = 0 THEN p + p * 2.220446049250313e-16 ELSE p END AS q2 FROM scr)""")
def table_diff_ulp(p):
    """Scores against a copy with some changed values, and against one whose last bits moved, as a text format may do."""
    at = lambda n, c: F.when(F.col("encounter_id") % n == 0, c).otherwise(F.col("p"))
    left = p.scored.select("encounter_id", "p", F.col("p").alias("q"), "is_readmitted")
    right = p.scored.select("encounter_id", at(70, F.col("p") + 1e-9).alias("p"), at(5, F.col("p") + F.col("p") * 2.220446049250313e-16).alias("q"), "is_readmitted")
    return fingerprint.table_verdict(left, right, "encounter_id").withColumn("max_ulp", F.col("max_ulp").cast("long"))


@query("score_parity", """SELECT count(*)::BIGINT AS n_rows, count_if(encounter_id % 19 = 0)::BIGINT AS n_missing, round(max(CASE WHEN encounter_id % 19 <> 0 THEN abs(r) ELSE 0 END), 9) AS max_difference
FROM (SELECT encounter_id, round(p, 3) - p AS r FROM scr)""")
def score_parity(p):
    """Scores against a copy that is rounded and lacks some rows."""
    other = p.scored.where("encounter_id % 19 <> 0").select("encounter_id", F.round("p", 3).alias("p"))
    return fingerprint.score_parity(p.scored, other, "encounter_id", "p").withColumn("max_difference", F.round("max_difference", 9))
