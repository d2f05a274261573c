"""Queries of scoring, publishing, table assertions, monitoring and reports."""

from __future__ import annotations

from functools import cached_property, reduce
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from pyspark.sql.window import Window as W

from ..functions.poisson import garwood, garwood_interval
from ..operators import assertions, evaluate, scoring
from ..operators.enrich import GOLD
from ..operators.fingerprint import mismatches, table_diff, union_all
from ..sources import publication, tables
from ..sources.adapter import FIRST_DATE, LAST_DATE, REFERENCE_END, STEP, TEST_START, TOP_N, WINDOW
from . import registry
from .evaluation import rounded
from .registry import query


#: Fingerprint definitions that predictions may carry; the floor and band of the monitoring rule.
DEFINITIONS, FLOOR, BAND = ("rowhash-1", "rowhash-2"), 10, (0.8, 1.25)


class Plans(registry.Plans):
    @cached_property
    def grid(self) -> DataFrame:
        """Weekly dates of the registered range whose windows can hold stays of the feature table, numbered from the first."""
        day = lambda t: F.lit(t).cast("date")
        seen = self.split.agg(F.to_date(F.min("index_stop")).alias("lo"), F.date_add(F.to_date(F.max("index_stop")), STEP - 1).alias("hi"))  # one row
        dates = F.sequence(day(FIRST_DATE), day(LAST_DATE), F.expr(f"INTERVAL {STEP} DAYS"))
        return self.landed("grid", lambda: seen.select("lo", "hi", F.posexplode(dates).alias("i", "d")).where("d between lo and hi").select("i", "d"))

    @cached_property
    def predictions(self) -> DataFrame:
        """Test rows, without what is only known later, ranked within each run date's window; a window that can't be judged stops the query."""
        stop = scoring.require_observable(F.date_add("d", 1).cast("timestamp_ntz"), F.lit(REFERENCE_END).cast("timestamp_ntz"))
        dates = self.grid.withColumn("d", F.date_sub(F.to_date(stop), 1))
        inputs = scoring.require_label_free(scoring.label_free(self.test))
        hits = scoring.in_windows(inputs, "index_stop", dates, WINDOW - 1)
        ranked = scoring.ranked(hits, "d", "p", "encounter_id", lambda f: self.landed("dealt", lambda: f)).select(
            F.col("d").alias("as_of_date"), "rank", (F.col("rank") <= TOP_N).alias("is_top_n"), "patient_id", "encounter_id", F.col("index_stop").alias("discharge_time"),
            "admission_reason_code", "admission_reason_description", F.lit("unplanned_30d").alias("label_definition"), F.lit("gold-1").alias("gold_fingerprint"),
            F.lit(DEFINITIONS[0]).alias("gold_fingerprint_definition"), F.lit("2001-06-30").cast("date").alias("gold_reference_date"), F.lit("model-1").alias("model_run_id"), F.lit("score").alias("model_name"), F.col("p").alias("risk_score"), F.when(F.col("i") % 20 == 19, "bundle-2").otherwise("bundle-1").alias("model_bundle_id"),
            F.concat(F.lit("run-"), F.date_format("d", "yyyyMMdd")).alias("scoring_run_id"), F.lit(TOP_N).alias("top_n"), F.lit(WINDOW).alias("scoring_window_days"), "partition",
        )
        return self.landed("predictions", lambda: ranked)

    @cached_property
    def metadata(self) -> dict:
        """What the feature table must hold, counted from the index stays that it is made of."""
        return self.index.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum("label"), F.lit(0)).alias("n_positive")).first().asDict()

    @cached_property
    def runs(self) -> DataFrame:
        g = self.grid.select("i", "d", F.explode(F.when(F.col("i") % 9 == 5, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
        n = self.predictions.groupBy(F.col("as_of_date").alias("d")).agg(F.count("*").cast("int").alias("n"))
        start = F.col("d").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("again") + 8)
        good = F.col("i") % 9 != 4
        return g.join(n, "d", "left").select(
            F.concat(F.lit("run-"), F.date_format("d", "yyyyMMdd"), F.when(F.col("again") == 1, "b").otherwise("")).alias("scoring_run_id"), F.col("d").alias("run_date"), start.alias("started_at"),
            (start + F.expr("INTERVAL 10 MINUTES")).alias("finished_at"), F.when(good, "succeeded").otherwise("failed").alias("status"), good.alias("published"),
            F.when(F.col("i") % 20 == 19, "bundle-2").otherwise("bundle-1").alias("model_bundle_id"), F.lit(WINDOW).alias("window_days"), F.lit(TOP_N).alias("top_n"), F.coalesce("n", F.lit(0)).alias("n_predictions"),
            good.alias("predictions_tests_passed"), F.lit(True).alias("history_tests_passed"), F.when(~good, "no result").alias("error_message"), F.lit("gold-1").alias("gold_fingerprint"),
        )

    @cached_property
    def published(self) -> DataFrame:
        """(as_of_date, scoring_run_id, n_rows) of what was published."""
        out = self.runs.where("published").select("scoring_run_id")
        return self.predictions.join(out, "scoring_run_id", "left_semi").groupBy("as_of_date", "scoring_run_id").agg(F.count("*").alias("n_rows"))

    @cached_property
    def found(self) -> DataFrame:
        """(d, scoring_run_id): dates whose published rows come from one run that fits its own record."""
        one = self.published.groupBy("as_of_date").agg(F.count("*").alias("k"), F.min("scoring_run_id").alias("scoring_run_id"), F.min("n_rows").alias("n_rows")).where("k = 1")
        facts = self.runs.where("status = 'succeeded' and published and model_bundle_id = 'bundle-1'").where((F.col("window_days") == WINDOW) & (F.col("top_n") == TOP_N))
        facts = facts.select("scoring_run_id", "run_date", "n_predictions")
        same = (F.col("run_date") == F.col("as_of_date")) & (F.col("n_predictions") == F.col("n_rows"))
        return one.join(facts, "scoring_run_id").where(same).select(F.col("as_of_date").alias("d"), "scoring_run_id")

    @cached_property
    def required(self) -> DataFrame:
        """(d, tick, kind): the weekly dates whose windows overlap each date's matured and immature ranges."""
        back = self.grid.select("d", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("k")).withColumn("tick", F.date_sub("d", F.col("k") * STEP))
        after, begin = F.date_add("tick", 1), F.date_sub("tick", WINDOW - 1)
        end = F.date_add("d", 1)
        ranges = (("matured", F.date_sub(end, 121), F.date_sub(end, 30)), ("immature", F.date_sub(end, 30), end))
        return union_all([back.where((begin < hi) & (after > lo)).select("d", "tick", F.lit(kind).alias("kind")) for kind, lo, hi in ranges])

    @cached_property
    def cohorts(self) -> DataFrame:
        """Every date's matured cohort in one job: counts, exact expected sum, coverage and verdict."""
        runs = self.found.select("scoring_run_id")
        rows = self.predictions.join(runs, "scoring_run_id", "left_semi").select("encounter_id", "discharge_time", "risk_score")
        labels = self.gold.select("encounter_id", "is_readmitted", "label_horizon")
        rows = scoring.with_labels(rows, labels, "encounter_id", "is_readmitted")
        end = F.date_add("d", 1)
        at = lambda n: F.date_sub(end, n).cast("timestamp_ntz")
        rows = rows.select("discharge_time", "risk_score", "is_readmitted", "label_horizon")
        hit = self.landed("hits", lambda: scoring.in_windows(rows, "discharge_time", self.grid.select("d"), 120, 30).drop("discharge_time"))
        stats = hit.groupBy("d").agg(
            F.count("*").alias("n_matured"),
            F.sum("is_readmitted").alias("observed"),
            F.sum(F.col("risk_score").cast("decimal(38,12)")).cast("double").alias("expected"),
            F.count_if(F.col("label_horizon") >= at(0)).alias("n_label_after_sim"),
        )
        need = self.required.select("d", F.col("tick")).distinct().join(self.found.select(F.col("d").alias("tick"), F.lit(1).alias("hit")), "tick", "left")
        cover = need.groupBy("d").agg(F.count("*").alias("coverage_required"), F.count("hit").alias("coverage_found"))
        area = evaluate.auc(hit, "is_readmitted", "risk_score", ("d",))
        out = self.grid.select("d").join(stats, "d", "left").join(cover, "d").join(area, "d", "left")
        zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_matured", "observed")]
        verdict = F.when(F.col("coverage_found") < F.col("coverage_required"), "incomplete_cohort").otherwise("complete")
        rows = out.select("d", *zero, F.coalesce("expected", F.lit(0.0)).alias("expected"), F.coalesce("n_label_after_sim", F.lit(0)).alias("n_label_after_sim"), "coverage_required", "coverage_found", "auc", verdict.alias("coverage"))
        return self.landed("cohorts", lambda: rows)

    @cached_property
    def judged(self) -> DataFrame:
        """Every date's cohort under the rule: an alert needs enough events, an interval off 1 and a ratio outside the band."""
        e, o = F.col("expected"), F.col("observed")
        rows = self.cohorts.withColumn("ci", garwood_interval(o))
        rows = rows.withColumns({"oe_ratio": F.when(e > 0, o / e), "oe_ci_low": F.when(e > 0, F.col("ci.low") / e), "oe_ci_high": F.when(e > 0, F.col("ci.high") / e)}).drop("ci")
        outside = ((F.col("oe_ci_high") < 1) | (F.col("oe_ci_low") > 1)) & ((F.col("oe_ratio") < BAND[0]) | (F.col("oe_ratio") > BAND[1]))
        rule = F.when(e <= 0, F.lit(None)).when(o < FLOOR, "insufficient_data").when(outside, "alert").otherwise("ok")
        verdict = F.when(F.col("coverage") == "incomplete_cohort", F.col("coverage")).otherwise(F.coalesce(rule, F.lit("insufficient_data")))
        return self.landed("judged", lambda: rows.withColumns({"rule": rule, "verdict": verdict}))

    @cached_property
    def ticks(self) -> DataFrame:
        """One monitoring row per grid date."""
        good = F.col("i") % 9 != 4
        start = F.col("d").cast("timestamp_ntz") + F.expr("INTERVAL 8 HOURS")
        kept = lambda c: F.when(good, F.col(c)).alias(c)
        last = self.runs.groupBy(F.col("run_date").alias("d")).agg(F.max_by("scoring_run_id", F.struct("started_at", "scoring_run_id")).alias("scoring_run_id"))
        rows = self.grid.join(self.judged, "d").join(last, "d").select(
            F.concat(F.lit("tick-"), F.date_format("d", "yyyyMMdd")).alias("monitoring_run_id"), F.col("d").alias("sim_date"), start.alias("started_at"), (start + F.expr("INTERVAL 10 MINUTES")).alias("finished_at"),
            F.when(good, "succeeded").otherwise("failed").alias("status"), F.when(~good, "evaluate").alias("failed_stage"), F.lit("weekly").alias("cadence"), "scoring_run_id",
            F.when(F.col("i") % 20 == 19, "bundle-2").otherwise("bundle-1").alias("model_bundle_id"), kept("verdict"),
            kept("n_matured"), kept("observed"), kept("expected"), kept("coverage_required"), kept("coverage_found"), kept("oe_ratio"), kept("oe_ci_low"), kept("oe_ci_high"),
            F.lit(FLOOR).alias("min_positives_floor"), F.lit(BAND[0]).alias("band_low"), F.lit(BAND[1]).alias("band_high"), F.lit(True).alias("history_tests_passed"),
        )
        return self.landed("ticks", lambda: rows)


registry.Plans = Plans

#: The SQL counterpart holds the intervals as a literal table, made by the function that the query uses.
_CI = ", ".join(f"({k}, {lo!r}::DOUBLE, {hi!r}::DOUBLE)" for k in range(400) for lo, hi in [garwood(k)])
COH = f"""cis(k, lo, hi) AS (VALUES {_CI}),
""" + """pub AS MATERIALIZED (SELECT as_of_date, scoring_run_id, count(*)::BIGINT AS n_rows FROM prd WHERE scoring_run_id IN (SELECT scoring_run_id FROM runs WHERE published) GROUP BY ALL),
fnd AS MATERIALIZED (SELECT as_of_date AS d, scoring_run_id FROM pub JOIN runs USING (scoring_run_id) WHERE status = 'succeeded' AND published AND run_date = as_of_date AND runs.model_bundle_id = 'bundle-1' AND n_predictions = n_rows
  AND as_of_date IN (SELECT as_of_date FROM pub GROUP BY 1 HAVING count(*) = 1)),
req AS MATERIALIZED (SELECT d, (d - (7 * k)::INT)::DATE AS tick, kind FROM grid, range(21) r(k), (SELECT unnest([{'kind': 'matured', 'a': 121, 'b': 30}, {'kind': 'immature', 'a': 30, 'b': 0}], recursive := true))
  WHERE (d - (7 * k)::INT - 6)::DATE < (d + 1 - b::INT)::DATE AND (d - (7 * k)::INT + 1)::DATE > (d + 1 - a::INT)::DATE),
hit AS MATERIALIZED (SELECT d, encounter_id, risk_score, g.is_readmitted, g.label_horizon FROM grid JOIN prd ON discharge_time >= (d + 1 - 121)::TIMESTAMP AND discharge_time < (d + 1 - 30)::TIMESTAMP
  JOIN gold g USING (encounter_id) WHERE scoring_run_id IN (SELECT scoring_run_id FROM fnd)),
arc AS (SELECT a.d, sum(CASE WHEN a.risk_score > b.risk_score THEN 1.0 WHEN a.risk_score = b.risk_score THEN 0.5 ELSE 0 END) / count(*) AS auc FROM hit a JOIN hit b ON a.d = b.d AND a.is_readmitted = 1 AND b.is_readmitted = 0 GROUP BY 1),
sta AS (SELECT d, count(*) AS n_matured, sum(is_readmitted) AS observed, sum(risk_score::DECIMAL(38,12))::DOUBLE AS expected, count_if(label_horizon >= (d + 1)::TIMESTAMP) AS n_label_after_sim FROM hit GROUP BY 1),
cov AS (SELECT r.d, count(*) AS coverage_required, count(f.d) AS coverage_found FROM (SELECT DISTINCT d, tick FROM req) r LEFT JOIN fnd f ON f.d = tick GROUP BY 1),
coh AS MATERIALIZED (SELECT i, d, coalesce(n_matured, 0)::BIGINT AS n_matured, coalesce(observed, 0)::BIGINT AS observed, coalesce(expected, 0) AS expected, coalesce(n_label_after_sim, 0)::BIGINT AS n_label_after_sim,
  coverage_required::BIGINT AS coverage_required, coverage_found::BIGINT AS coverage_found, auc, CASE WHEN coverage_found < coverage_required THEN 'incomplete_cohort' ELSE 'complete' END AS coverage
  FROM grid LEFT JOIN sta USING (d) JOIN cov USING (d) LEFT JOIN arc USING (d)),
jud AS MATERIALIZED (SELECT *, CASE WHEN coverage <> 'complete' THEN coverage ELSE coalesce(rule, 'insufficient_data') END AS verdict FROM (SELECT *, CASE WHEN expected <= 0 THEN NULL WHEN observed < 10 THEN 'insufficient_data'
  WHEN (oe_ci_high < 1 OR oe_ci_low > 1) AND (oe_ratio < 0.8 OR oe_ratio > 1.25) THEN 'alert' ELSE 'ok' END AS rule FROM (SELECT coh.*, CASE WHEN expected > 0 THEN observed / expected END AS oe_ratio,
  CASE WHEN expected > 0 THEN lo / expected END AS oe_ci_low, CASE WHEN expected > 0 THEN hi / expected END AS oe_ci_high FROM coh LEFT JOIN cis ON k = observed))),
tik AS MATERIALIZED (SELECT 'tick-' || strftime(d, '%Y%m%d') AS monitoring_run_id, d AS sim_date, d::TIMESTAMP + INTERVAL 8 HOUR AS started_at, d::TIMESTAMP + INTERVAL '8 hours 10 minutes' AS finished_at,
  CASE WHEN i % 9 = 4 THEN 'failed' ELSE 'succeeded' END AS status, CASE WHEN i % 9 = 4 THEN 'evaluate' END AS failed_stage, 'weekly' AS cadence, 'run-' || strftime(d, '%Y%m%d') || CASE WHEN i % 9 = 5 THEN 'b' ELSE '' END AS scoring_run_id,
  CASE WHEN i % 20 = 19 THEN 'bundle-2' ELSE 'bundle-1' END AS model_bundle_id, CASE WHEN i % 9 <> 4 THEN verdict END AS verdict, CASE WHEN i % 9 <> 4 THEN oe_ratio END AS oe_ratio, CASE WHEN i % 9 <> 4 THEN oe_ci_low END AS oe_ci_low, CASE WHEN i % 9 <> 4 THEN oe_ci_high END AS oe_ci_high,
  10 AS min_positives_floor, 0.8::DOUBLE AS band_low, 1.25::DOUBLE AS band_high,
  CASE WHEN i % 9 <> 4 THEN n_matured END AS n_matured, CASE WHEN i % 9 <> 4 THEN observed END AS observed, CASE WHEN i % 9 <> 4 THEN expected END AS expected,
  CASE WHEN i % 9 <> 4 THEN coverage_required END AS coverage_required, CASE WHEN i % 9 <> 4 THEN coverage_found END AS coverage_found, true AS history_tests_passed FROM jud)"""

# --- scoring
query("run_window", """SELECT d, d::TIMESTAMP - INTERVAL 6 DAY AS start, d::TIMESTAMP + INTERVAL 1 DAY AS stop, d::TIMESTAMP + INTERVAL 1 DAY <= TIMESTAMP '2001-06-01' AS observable,
(SELECT count(*) FROM gold WHERE index_stop >= d::TIMESTAMP - INTERVAL 6 DAY AND index_stop < d::TIMESTAMP + INTERVAL 1 DAY)::BIGINT AS n_rows FROM grid""")(
    lambda p: scoring.windows(p.grid, p.gold, WINDOW, F.lit(REFERENCE_END).cast("timestamp_ntz"))
)
query("sim_grid", "SELECT i, d FROM grid")(lambda p: p.grid)
_R = "SELECT * REPLACE (round(risk_score, 8) AS risk_score) FROM prd"
query("predictions", _R)(lambda p: rounded(p.predictions))
query("score_grid", "SELECT as_of_date, count(*)::BIGINT AS n, count_if(is_top_n)::BIGINT AS n_top, round(max(risk_score), 8) AS top FROM prd GROUP BY 1")(
    lambda p: rounded(p.predictions.groupBy("as_of_date").agg(F.count("*").alias("n"), F.count_if("is_top_n").alias("n_top"), F.max("risk_score").alias("top")))
)
query("rank_top_n", "SELECT as_of_date, encounter_id, rank, is_top_n FROM prd")(lambda p: p.predictions.select("as_of_date", "encounter_id", "rank", "is_top_n"))
query("top_n_sample", "SELECT as_of_date, rank, encounter_id FROM prd WHERE rank <= 5")(lambda p: p.predictions.where("rank <= 5").select("as_of_date", "rank", "encounter_id"))


@query("observed_summary", """SELECT as_of_date, count(*)::BIGINT AS n, round(avg(is_readmitted), 8) AS batch_rate, round(avg(is_readmitted) FILTER (is_top_n), 8) AS precision_top,
round(avg(is_readmitted) FILTER (is_top_n) / nullif(avg(is_readmitted), 0), 8) AS lift FROM prd JOIN gold USING (encounter_id) GROUP BY 1""")
def observed_summary(p):
    rows = scoring.with_labels(p.predictions, p.gold.select("encounter_id", "is_readmitted"), "encounter_id", "is_readmitted")
    top = F.avg(F.when(F.col("is_top_n"), F.col("is_readmitted")))
    base = F.avg("is_readmitted")
    return rounded(rows.groupBy("as_of_date").agg(F.count("*").alias("n"), base.alias("batch_rate"), top.alias("precision_top"), F.when(base > 0, top / base).alias("lift")))


query("preflight", """SELECT d, count(encounter_id)::BIGINT AS n, count_if(partition = 'train')::BIGINT AS n_train, CASE WHEN count(encounter_id) = 0 THEN 'empty' WHEN count_if(partition NOT IN ('train', 'test')) > 0 THEN 'unassigned' WHEN count_if(partition = 'train') > 0 THEN 'train' ELSE 'ok' END AS state
FROM grid LEFT JOIN spl ON index_stop >= d::TIMESTAMP - INTERVAL 6 DAY AND index_stop < d::TIMESTAMP + INTERVAL 1 DAY GROUP BY d""")(
    lambda p: scoring.in_windows(p.split.select("index_stop", "partition"), "index_stop", p.grid.select("d"), WINDOW - 1)
    .groupBy("d").agg(F.count("*").alias("n"), F.count_if(F.col("partition") == "train").alias("n_train"), F.count_if(~F.col("partition").isin("train", "test")).alias("u"))
    .join(p.grid.select("d"), "d", "right")
    .select("d", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n_train", F.lit(0)).alias("n_train"), F.when(F.col("n").isNull(), "empty").when(F.col("u") > 0, "unassigned").when(F.col("n_train") > 0, "train").otherwise("ok").alias("state"))
)

# --- sinks: written below the shared folder, read again
query("gold_roundtrip", "SELECT encounter_id, patient_id, index_start, is_readmitted FROM gold")(
    lambda p: tables.write_once(p.gold, p.shared_path("gold")).select("encounter_id", "patient_id", "index_start", "is_readmitted")
)


@query("predictions_partition", "SELECT as_of_date, count(*)::BIGINT AS n FROM prd GROUP BY 1")
def predictions_partition(p):
    path = p.shared_path("predictions")
    rows = tables.write_once(p.predictions, path + "-source")
    tables.replace_partition(rows, path, "as_of_date")
    tables.replace_partition(rows.where("as_of_date = date'2000-05-01'"), path, "as_of_date")  # again: no change
    return p.spark.read.parquet(path).groupBy("as_of_date").agg(F.count("*").alias("n"))


@query("run_log_append", "SELECT count(*)::BIGINT AS n, count(DISTINCT scoring_run_id) AS ids FROM runs")
def run_log_append(p):
    """Two attempts append their rows, and one of them once more."""
    path = p.shared_path("runs")
    failed, others = p.runs.where("status = 'failed'"), p.runs.where("status <> 'failed'")
    for attempt, rows in (("failed", failed), ("others", others), ("failed", failed)):
        publication.append_once(rows, path, attempt)
    return p.spark.read.parquet(path).agg(F.count("*").alias("n"), F.countDistinct("scoring_run_id").alias("ids"))


def publish_run(rows: DataFrame, root: str, run_id: str) -> int:
    """Stage all dates, audit each, publish those that pass every rule together and mark the others; returns the commit."""
    staged = publication.stage(rows, root, run_id, "as_of_date")
    return publication.commit(staged, root, prediction_verdicts(staged.rows).groupBy("as_of_date").agg(F.bool_and("passed").alias("passed")))


def publish_predictions(p, rows: DataFrame) -> DataFrame:
    """What is served after one run on an empty log."""
    root = p.shared_path("serving")
    publish_run(rows, root, "run-1")
    return publication.served(p.spark, root, rows, "as_of_date")


@query("publication_log", """SELECT as_of_date, CASE i % 3 WHEN 1 THEN 'stale' WHEN 2 THEN 'failed' ELSE 'published' END AS state, CASE WHEN i % 3 = 0 THEN 2 WHEN i % 3 = 1 THEN 1 END::BIGINT AS served_commit,
CASE i % 3 WHEN 2 THEN 0 ELSE count(*) END::BIGINT AS n_rows, CASE i % 3 WHEN 2 THEN NULL ELSE count(*) END::BIGINT AS n_served, CASE WHEN i % 3 <> 2 THEN round(sum(risk_score), 6) END AS total
FROM prd JOIN grid ON d = as_of_date GROUP BY as_of_date, i""")
def publication_log(p):
    """Two runs over all dates: every third date fails in both, every other third in the second only; the first run is tried again."""
    root, rows, third = p.shared_path("published"), p.predictions, F.datediff("as_of_date", F.lit(FIRST_DATE).cast("date")) / STEP % 3
    spoiled = lambda bad: rows.withColumn("risk_score", F.when(bad, F.col("risk_score") + 2).otherwise(F.col("risk_score")))
    for run_id, bad in (("run-1", third == 2), ("run-2", third > 0), ("run-1", third == 2)):
        publish_run(spoiled(bad), root, run_id)
    found = publication.served(p.spark, root, rows, "as_of_date").groupBy("as_of_date").agg(F.count("*").alias("n_served"), F.sum("risk_score").alias("total"))
    dates = publication.state(p.spark, root).select(F.col("date").cast("date").alias("as_of_date"), "state", "served_commit", "n_rows")
    return rounded(dates.join(found, "as_of_date", "left"), 6)


for _name in ("wap_predictions", "wap_predictions_dates"):  # all dates are staged, audited and published
    query(_name, "SELECT as_of_date, count(*)::BIGINT AS n FROM prd GROUP BY 1")(
        lambda p: publish_predictions(p, p.predictions).groupBy("as_of_date").agg(F.count("*").alias("n"))
    )


@query("wap_gold", "SELECT count(*)::BIGINT AS n_rows, sum(is_readmitted)::BIGINT AS n_positive, 1::BIGINT AS n_versions FROM gold")
def wap_gold(p):
    """The table is staged, audited and published; a bad one that follows is refused, and the first stays served."""
    root = p.shared_path("gold-served")
    bad = p.gold.withColumn("is_readmitted", F.when(F.col("encounter_id") % 7 == 0, 2).otherwise(F.col("is_readmitted")))
    for rows in (p.gold, bad):
        staged = tables.write_once(rows, p.shared_path("gold-staged"))
        passed = assertions.verdict(judge_gold(p, staged)).first()["passed"]
        tables.publish(staged, root, passed, ("is_readmitted",))
    served, n = tables.served(p.spark, root)
    return served.agg(F.count("*").alias("n_rows"), F.sum("is_readmitted").alias("n_positive"), F.lit(n).cast("long").alias("n_versions"))


# --- assertions
# fixed values: columns that one run's predictions share
CONSTANTS = ("model_bundle_id", "top_n", "scoring_window_days", "gold_fingerprint", "label_definition", "gold_reference_date")


def prediction_rules():
    c, bad = F.col, assertions.bad
    return {
        "PRED-01": F.when(F.count("*") >= 1, 0).otherwise(1),
        "PRED-02": F.when((F.min("rank") == 1) & (F.max("rank") == F.count("*")) & (F.countDistinct("rank") == F.count("*")), 0).otherwise(1),
        "PRED-03": F.count("*") - F.countDistinct("encounter_id"),
        "PRED-04": bad(c("risk_score").between(0, 1)),
        "PRED-05": bad(c("is_top_n") == (c("rank") <= c("top_n"))),
        "PRED-06": sum((assertions.constant(x) for x in CONSTANTS), F.lit(0)),
        "PRED-11": assertions.constant("gold_fingerprint_definition") + bad(c("gold_fingerprint_definition").isin(*DEFINITIONS)),
        "PRED-08": bad(c("partition") == "test"),
        "PRED-09": bad((c("discharge_time") >= F.date_sub("as_of_date", WINDOW - 1).cast("timestamp_ntz")) & (c("discharge_time") < F.date_add("as_of_date", 1).cast("timestamp_ntz"))),
        "PRED-10": bad(c("scoring_run_id") == F.concat(F.lit("run-"), F.date_format("as_of_date", "yyyyMMdd"))),
    }


def prediction_verdicts(rows: DataFrame) -> DataFrame:
    """(as_of_date, rule, n_bad, passed): PRED-01 to 10 for each date that ``rows`` hold."""
    order = assertions.not_increasing(rows, ("as_of_date",), "rank", "risk_score")
    order = order.select("as_of_date", F.lit("PRED-07").alias("rule"), "n_bad", (F.col("n_bad") == 0).alias("passed"))
    return assertions.run(rows, prediction_rules(), ("as_of_date",)).unionByName(order)


def run_rules():
    c, bad = F.col, assertions.bad
    return {
        "RUNS-01": F.count("*") - F.countDistinct("scoring_run_id"),
        "RUNS-02": bad(c("status").isin("succeeded", "data_tests_failed", "refused", "failed")),
        "RUNS-03": bad(c("finished_at") >= c("started_at")),
        "RUNS-04": bad((c("status") != "succeeded") | (c("published") & c("history_tests_passed") & c("predictions_tests_passed") & (c("n_predictions") > 0) & c("model_bundle_id").isNotNull())),
        "RUNS-05": bad((c("status") == "succeeded") | c("error_message").isNotNull()),
        "RUNS-06": bad(~c("published") | c("predictions_tests_passed")),
        "RUNS-07": bad((c("status") != "refused") | ~c("published")),
    }


def tick_rules():
    c, bad = F.col, assertions.bad
    first, last = F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date")
    return {
        "MON-01": F.count("*") - F.countDistinct("monitoring_run_id"),
        "MON-02": bad(c("status").isin("succeeded", "refused", "failed")),
        "MON-03": bad(c("finished_at") >= c("started_at")),
        "MON-04": bad((c("status") == "succeeded") == c("verdict").isNotNull()),
        "MON-05": bad((c("status") != "succeeded") | (c("scoring_run_id").isNotNull() & c("n_matured").isNotNull() & c("coverage_found").isNotNull() & c("history_tests_passed"))),
        "MON-06": bad(F.pmod(F.datediff("sim_date", first), F.lit(STEP)) == 0),
        "MON-07": bad(c("oe_ratio").isNull() | c("oe_ratio").between(c("oe_ci_low"), c("oe_ci_high"))),
        "MON-08": bad(
            c("verdict").isNull() | (c("verdict") != "alert") | ((c("observed") >= c("min_positives_floor")) & ((c("oe_ci_high") < 1) | (c("oe_ci_low") > 1))
            & ((c("oe_ratio") < c("band_low")) | (c("oe_ratio") > c("band_high"))) & (c("coverage_found") == c("coverage_required")))
        ),
        "MON-09": bad(c("verdict").isNull() | c("verdict").isin("ok", "alert", "insufficient_data", "incomplete_cohort")),
        "MON-10": bad(c("sim_date").between(first, last)),
        "MON-11": bad(c("cadence").isin("burn_in", "weekly", "dispatch", "catch_up")),
        "MON-12": bad(((c("status") == "succeeded") == c("failed_stage").isNull()) & (c("failed_stage").isNull() | c("failed_stage").isin("clock", "score", "evaluate"))),
    }


# fixed values: columns that the loader requires, beside the two keys
REQUIRED = (
    "patient_id", "index_start", "is_readmitted", "label_horizon", "prior_encounter_count", "prior_inpatient_count", "prior_emergency_count",
    "active_condition_count", "active_medication_count", "procedure_count_window", "active_careplan_count", "observation_count_window", "age_at_index_years",
)


def gold_rules(metadata: dict):
    """Rules of the feature table; ``metadata`` has the n_rows and n_positive that its maker has counted."""
    c, bad = F.col, assertions.bad
    return {
        "GOLD-01": bad(c("index_stop").isNotNull()),
        "GOLD-02": F.abs(F.count("*") - metadata["n_rows"]),
        "GOLD-03": F.abs(F.coalesce(F.sum("is_readmitted"), F.lit(0)) - metadata["n_positive"]),
        "GOLD-04": F.count("*") - F.countDistinct("encounter_id"),
        "GOLD-05": bad(reduce(lambda a, b: a & b, (c(x).isNotNull() for x in REQUIRED))),
        "GOLD-06": bad(c("is_readmitted").isin(0, 1)),
    }


def judge_gold(p, rows: DataFrame) -> DataFrame:
    """All GOLD rules; GOLD-07: there are predictions, and each is of a row that the table holds."""
    missing = p.predictions.join(rows.select("encounter_id").distinct().withColumn("_held", F.lit(True)), "encounter_id", "left")
    absent = F.when(F.count("*") == 0, 1).otherwise(F.count_if(F.col("_held").isNull()))
    return assertions.run(rows, gold_rules(p.metadata)).unionByName(assertions.run(missing, {"GOLD-07": absent}))


def _rules_sql(table: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS rule, ({v})::BIGINT AS n_bad, ({v}) = 0 AS passed FROM {table}" for k, v in rules.items())


_PRED = "(SELECT * FROM prd WHERE as_of_date = DATE '2000-05-01')"
PRED_SQL = {
    "PRED-01": "CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END", "PRED-02": "CASE WHEN min(rank) = 1 AND max(rank) = count(*) AND count(DISTINCT rank) = count(*) THEN 0 ELSE 1 END",
    "PRED-03": "count(*) - count(DISTINCT encounter_id)", "PRED-04": "count_if((risk_score BETWEEN 0 AND 1) IS NOT TRUE)", "PRED-05": "count_if((is_top_n = (rank <= top_n)) IS NOT TRUE)",
    "PRED-06": " + ".join(f"CASE WHEN count(DISTINCT {x}) = 1 AND count({x}) = count(*) THEN 0 ELSE 1 END" for x in CONSTANTS),
    "PRED-11": "CASE WHEN count(DISTINCT gold_fingerprint_definition) = 1 THEN 0 ELSE 1 END + count_if((gold_fingerprint_definition IN ('rowhash-1', 'rowhash-2')) IS NOT TRUE)", "PRED-08": "count_if((partition = 'test') IS NOT TRUE)",
    "PRED-09": "count_if((discharge_time >= as_of_date::TIMESTAMP - INTERVAL 6 DAY AND discharge_time < as_of_date::TIMESTAMP + INTERVAL 1 DAY) IS NOT TRUE)",
    "PRED-10": "count_if((scoring_run_id = 'run-20000501') IS NOT TRUE)",
}
_ORDER = " UNION ALL SELECT 'PRED-07', count_if(prev IS NOT NULL AND NOT risk_score <= prev)::BIGINT, count_if(prev IS NOT NULL AND NOT risk_score <= prev) = 0 FROM (SELECT risk_score, lag(risk_score) OVER (ORDER BY rank) AS prev FROM " + _PRED + ")"


@query("dq_predictions", _rules_sql(_PRED, PRED_SQL) + _ORDER)
def dq_predictions(p):
    """The rules over all dates: bad counts are summed, so a rule passes only if it does on every date."""
    return prediction_verdicts(p.predictions).groupBy("rule").agg(F.sum("n_bad").alias("n_bad"), F.bool_and("passed").alias("passed"))


_LAG = "(SELECT *, lag(risk_score) OVER (PARTITION BY as_of_date ORDER BY rank) AS prev FROM prd)"
_DATED = PRED_SQL | {"PRED-07": "count_if(prev IS NOT NULL AND NOT risk_score <= prev)", "PRED-10": "count_if((scoring_run_id = 'run-' || strftime(as_of_date, '%Y%m%d')) IS NOT TRUE)"}
query("dq_predictions_dates", " UNION ALL ".join(f"SELECT as_of_date, '{k}' AS rule, ({v})::BIGINT AS n_bad, ({v}) = 0 AS passed FROM {_LAG} GROUP BY as_of_date" for k, v in _DATED.items()))(
    lambda p: prediction_verdicts(p.predictions)
)


RUNS_SQL = {
    "RUNS-01": "count(*) - count(DISTINCT scoring_run_id)", "RUNS-02": "count_if(status NOT IN ('succeeded', 'data_tests_failed', 'refused', 'failed'))", "RUNS-03": "count_if(finished_at < started_at)",
    "RUNS-04": "count_if(status = 'succeeded' AND NOT (published AND n_predictions > 0))", "RUNS-05": "count_if(status <> 'succeeded' AND error_message IS NULL)", "RUNS-06": "count_if(published AND NOT predictions_tests_passed)", "RUNS-07": "count_if(status = 'refused' AND published)",
}
query("dq_scoring_runs", _rules_sql("runs", RUNS_SQL))(lambda p: assertions.run(p.runs, run_rules()))
TICK_SQL = {
    "MON-01": "count(*) - count(DISTINCT monitoring_run_id)", "MON-02": "count_if(status NOT IN ('succeeded', 'refused', 'failed'))", "MON-03": "count_if(finished_at < started_at)", "MON-04": "count_if((status = 'succeeded') <> (verdict IS NOT NULL))",
    "MON-05": "count_if(status = 'succeeded' AND (scoring_run_id IS NULL OR n_matured IS NULL OR coverage_found IS NULL))", "MON-06": "count_if(date_diff('day', DATE '2000-01-10', sim_date) % 7 <> 0)", "MON-07": "count_if(NOT (oe_ratio BETWEEN oe_ci_low AND oe_ci_high))",
    "MON-08": "count_if(verdict = 'alert' AND NOT (observed >= 10 AND (oe_ci_high < 1 OR oe_ci_low > 1) AND (oe_ratio < 0.8 OR oe_ratio > 1.25) AND coverage_found = coverage_required))",
    "MON-09": "count_if(verdict NOT IN ('ok', 'alert', 'insufficient_data', 'incomplete_cohort'))",
    "MON-10": "count_if(sim_date NOT BETWEEN DATE '2000-01-10' AND DATE '2001-05-28')", "MON-11": "count_if(cadence <> 'weekly')", "MON-12": "count_if((status = 'succeeded') <> (failed_stage IS NULL))",
}
query("dq_monitoring", _rules_sql("tik", TICK_SQL), COH)(lambda p: assertions.run(p.ticks, tick_rules()))
GOLD_SQL = {
    "GOLD-01": "count_if(index_stop IS NULL)", "GOLD-02": "abs(count(*) - (SELECT count(*) FROM obs))", "GOLD-03": "abs(coalesce(sum(is_readmitted), 0) - (SELECT coalesce(sum(label), 0) FROM obs))",
    "GOLD-04": "count(*) - count(DISTINCT encounter_id)", "GOLD-05": f"count_if({' OR '.join(f'{x} IS NULL' for x in REQUIRED)})", "GOLD-06": "count_if(is_readmitted NOT IN (0, 1))",
}
_REF = " UNION ALL SELECT 'GOLD-07', n, n = 0 FROM (SELECT (CASE WHEN count(*) = 0 THEN 1 ELSE count_if(encounter_id NOT IN (SELECT encounter_id FROM gold)) END)::BIGINT AS n FROM prd)"

query("dq_gold", _rules_sql("gold", GOLD_SQL) + _REF)(lambda p: judge_gold(p, p.gold))


@query("gold_validate", _rules_sql("gold", GOLD_SQL | {"COLUMNS": "count_if(false)", "EMPTY": "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", "STOP": "count_if(index_stop < index_start)"}))
def gold_validate(p):
    """The written feature table as its reader checks it: exact columns in order, rows, keys, values and the maker's counts."""
    read = tables.write_once(p.gold, p.shared_path("gold-read"))
    more = {"COLUMNS": F.lit(int(tuple(read.columns) != GOLD)) + F.count_if(F.lit(False)), "EMPTY": F.when(F.count("*") == 0, 1).otherwise(0), "STOP": assertions.bad(F.col("index_stop") >= F.col("index_start"))}
    return assertions.run(read, gold_rules(p.metadata) | more)


@query("dq_runner", """SELECT t.copy, f IS NULL AS passed, f AS first_failure FROM (SELECT 'clean' AS copy UNION ALL SELECT 'changed') t LEFT JOIN (SELECT 'changed' AS copy,
CASE WHEN count_if(index_stop IS NULL) > 0 THEN 'GOLD-01' WHEN count(DISTINCT encounter_id) < count(*) THEN 'GOLD-04' WHEN count_if(is_readmitted NOT IN (0, 1)) > 0 THEN 'GOLD-06' END AS f
FROM (SELECT encounter_id, index_stop, CASE WHEN encounter_id % 2 = 0 THEN is_readmitted ELSE 7 - is_readmitted END AS is_readmitted FROM gold UNION ALL SELECT encounter_id, index_stop, is_readmitted FROM gold WHERE encounter_id % 5 = 0)) c USING (copy)""")
def dq_runner(p):
    """(copy, passed, first_failure) of the table and of a copy that breaks several rules: the first in order is the verdict."""
    g = p.gold
    changed = g.withColumn("is_readmitted", F.when(F.col("encounter_id") % 2 == 0, F.col("is_readmitted")).otherwise(7 - F.col("is_readmitted"))).unionByName(g.where("encounter_id % 5 = 0"))
    rules = {k: v for k, v in gold_rules(p.metadata).items() if k not in ("GOLD-02", "GOLD-03")}  # these would see the doubled rows first
    return union_all([assertions.verdict(assertions.run(f, rules)).select(F.lit(n).alias("copy"), "passed", "first_failure") for n, f in (("clean", g), ("changed", changed))])


@query("dq_mutations", "SELECT unnest(['clean', 'label', 'stop', 'twice']) AS mutation, unnest([NULL, 'GOLD-06', 'GOLD-01', 'GOLD-04']) AS first_failure FROM (SELECT count(*) FROM gold)")
def dq_mutations(p):
    """A clean copy and three changes of the gold table, as the SQL has them; dq_mutations_all has every rule."""
    g = p.gold
    first = g.agg(F.min("encounter_id").alias("m"))
    marked = g.crossJoin(F.broadcast(first))
    at = F.col("encounter_id") == F.col("m")
    changed = {
        "clean": marked,
        "label": marked.withColumn("is_readmitted", F.when(at, 2).otherwise(F.col("is_readmitted"))),
        "stop": marked.withColumn("index_stop", F.when(~at, F.col("index_stop"))),
        "twice": marked.unionByName(marked.where(at)),
    }
    rules = {k: v for k, v in gold_rules(p.metadata).items() if k not in ("GOLD-02", "GOLD-03")}  # counts change with rows and labels
    return union_all([assertions.verdict(assertions.run(f, rules)).select(F.lit(n).alias("mutation"), "first_failure") for n, f in changed.items()])


def mutations(p) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Name of each rule (or ``clean-`` and a suite) to the rule table of a copy with one targeted change."""
    c, bad = F.col, assertions.bad
    out = {}

    def suite(name: str, rows: DataFrame, key: list, judge, changes: dict, add: dict | None = None) -> None:
        """``changes``: rule to {column: value at the one marked row}; ``add``: rule to a whole changed table."""
        one = F.broadcast(rows.orderBy(*key).limit(1).select(*(c(k).alias(f"_{k}") for k in key)))
        marked = rows.crossJoin(one)
        at = reduce(lambda a, b: a & b, (c(k) == c(f"_{k}") for k in key))
        keep = lambda f: f.select(*rows.columns)
        out[f"clean-{name}"] = judge(rows)
        for rule, new in changes.items():
            kinds = dict(rows.dtypes)
            out[rule] = judge(keep(marked.withColumns({k: F.when(at, F.lit(v) if not isinstance(v, Column) else v).otherwise(c(k)).cast(kinds[k]) for k, v in new.items()})))
        for rule, make in (add or {}).items():
            out[rule] = judge(make(rows, keep(marked.where(at))))

    whole = lambda rows: judge_gold(p, rows)
    sized = lambda rows: judge_gold(SimpleNamespace(predictions=p.predictions, metadata=rows.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum("is_readmitted"), F.lit(0)).alias("n_positive")).first().asDict()), rows)
    twice = lambda rows, one: rows.unionByName(one)
    known = p.predictions.agg(F.min("encounter_id").alias("encounter_id"))
    unseen = p.gold.join(p.predictions, "encounter_id", "left_anti").where("is_readmitted = 0").agg(F.min("encounter_id").alias("encounter_id"))
    flip = lambda rows, one: rows.withColumn("is_readmitted", F.when(c("encounter_id") == one.first()["encounter_id"], 1 - c("is_readmitted")).otherwise(c("is_readmitted")))
    suite("gold", p.gold, ["encounter_id"], whole, {"GOLD-01": {"index_stop": None}, "GOLD-05": {"patient_id": None}},
          {"GOLD-02": lambda rows, one: rows.join(F.broadcast(unseen), "encounter_id", "left_anti"), "GOLD-03": flip})
    # changes of rows or labels, with metadata that has counted them
    suite("gold-sized", p.gold, ["encounter_id"], sized, {"GOLD-06": {"is_readmitted": 2}}, {"GOLD-04": twice, "GOLD-07": lambda rows, one: rows.join(F.broadcast(known), "encounter_id", "left_anti")})

    def judge(rows: DataFrame) -> DataFrame:
        """A rule passes if it does on every date, and there is one."""
        one = prediction_verdicts(rows).groupBy("rule").agg(F.sum("n_bad").alias("n_bad"), F.bool_and("passed").alias("passed"))
        empty = assertions.run(rows, {"PRED-01": F.when(F.count("*") == 0, 1).otherwise(0)})
        return one.where("rule <> 'PRED-01'").unionByName(empty)

    suite("predictions", p.predictions, ["as_of_date", "rank"], judge, {"PRED-02": {"rank": 0}, "PRED-04": {"risk_score": 2.0}, "PRED-05": {"is_top_n": False}, "PRED-06": {"model_bundle_id": "other"},
          "PRED-07": {"risk_score": 0.0}, "PRED-08": {"partition": "train"}, "PRED-09": {"discharge_time": F.lit("1999-01-01").cast("timestamp_ntz")}, "PRED-10": {"scoring_run_id": "other"}, "PRED-11": {"gold_fingerprint_definition": "unknown"}},
          {"PRED-01": lambda rows, one: rows.limit(0), "PRED-03": lambda rows, one: rows.withColumn("encounter_id", F.when(c("rank") == 2, F.first("encounter_id").over(W.partitionBy("as_of_date").orderBy("rank"))).otherwise(c("encounter_id")))})

    suite("runs", p.runs.where("status = 'succeeded'"), ["scoring_run_id"], lambda rows: assertions.run(rows, run_rules()), {"RUNS-02": {"status": "other", "error_message": "x"}, "RUNS-03": {"finished_at": c("started_at") - F.expr("INTERVAL 1 HOUR")},
          "RUNS-04": {"n_predictions": 0}, "RUNS-05": {"status": "failed"}, "RUNS-06": {"status": "failed", "error_message": "x", "predictions_tests_passed": False}, "RUNS-07": {"status": "refused", "error_message": "x"}}, {"RUNS-01": twice})
    suite("ticks", p.ticks.where("status = 'succeeded' and oe_ratio is not null"), ["monitoring_run_id"], lambda rows: assertions.run(rows, tick_rules()), {"MON-02": {"status": "other", "verdict": None, "failed_stage": "clock"}, "MON-03": {"finished_at": c("started_at") - F.expr("INTERVAL 1 HOUR")},
          "MON-04": {"verdict": None}, "MON-05": {"n_matured": None}, "MON-06": {"sim_date": F.date_add("sim_date", 1)}, "MON-07": {"oe_ratio": c("oe_ci_high") + 1, "verdict": "ok"}, "MON-08": {"verdict": "alert", "observed": 1}, "MON-09": {"verdict": "other"}, "MON-10": {"sim_date": F.date_sub("sim_date", 70000)},
          "MON-11": {"cadence": "other"}, "MON-12": {"failed_stage": "clock"}}, {"MON-01": twice})
    return out


@query("dq_mutations_all")
def dq_mutations_all(p):
    """(mutation, fired): every rule of the four suites by the change that is made for it, and the rules that it fires."""
    fired = F.concat_ws(",", F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("rule")))))  # at most a suite's rules
    return union_all([f.agg(fired.alias("fired")).select(F.lit(n).alias("mutation"), "fired") for n, f in mutations(p).items()])


# --- population checks
query("check_structure", "SELECT count(*)::BIGINT AS n, round(avg(is_readmitted), 8) AS positive_rate, round(avg((admission_reason_code IS NULL)::INT), 8) AS null_reason FROM gold")(
    lambda p: rounded(p.gold.agg(F.count("*").alias("n"), F.avg("is_readmitted").alias("positive_rate"), F.avg(F.col("admission_reason_code").isNull().cast("int")).alias("null_reason")))
)
query("check_ids", "SELECT count(*)::BIGINT AS n, count(DISTINCT id) AS n_ids FROM ent")(lambda p: p.entities.agg(F.count("*").alias("n"), F.countDistinct("id").alias("n_ids")))
query("check_latest", "SELECT max(start) AS latest, count_if(start IS NULL)::BIGINT AS n_null FROM stay")(lambda p: p.stays.agg(F.max("start").alias("latest"), F.count_if(F.col("start").isNull()).alias("n_null")))
query("check_posthumous", "SELECT count(*)::BIGINT AS n FROM stay JOIN ent ON ent.id = entity WHERE death <= start::DATE")(
    lambda p: p.stays.join(p.entities.select(F.col("id").alias("entity"), "death"), "entity").where(F.col("death") <= F.to_date("start")).agg(F.count("*").alias("n"))
)
query("check_horizon", "SELECT count_if(label_horizon > index_stop + INTERVAL 30 DAY)::BIGINT AS n_late, count_if(partition = 'train' AND label_horizon >= TIMESTAMP '2000-01-01')::BIGINT AS n_train_exposed FROM spl")(
    lambda p: p.split.agg(
        F.count_if(F.col("label_horizon") > F.col("index_stop") + F.expr("INTERVAL 30 DAYS")).alias("n_late"),
        F.count_if((F.col("partition") == "train") & (F.col("label_horizon") >= F.lit("2000-01-01").cast("timestamp_ntz"))).alias("n_train_exposed"),
    )
)
query("check_disjoint", "SELECT count(*)::BIGINT AS n_both FROM (SELECT patient_id FROM spl WHERE partition = 'train' INTERSECT SELECT patient_id FROM spl WHERE partition = 'test')")(
    lambda p: p.split.where("partition = 'train'").select("patient_id").intersect(p.split.where("partition = 'test'").select("patient_id")).agg(F.count("*").alias("n_both"))
)


@query("population_checks", """SELECT 'ids' AS check_name, CASE WHEN count(*) = count(DISTINCT id) THEN 'PASS' ELSE 'FAIL' END AS status, (count(*) - count(DISTINCT id))::BIGINT AS n FROM ent
UNION ALL SELECT 'posthumous', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'WARN' END, count(*) FROM stay JOIN ent ON ent.id = entity WHERE death <= start::DATE
UNION ALL SELECT 'power', CASE WHEN sum(is_readmitted) >= 50 THEN 'PASS' ELSE 'FAIL' END, sum(is_readmitted)::BIGINT FROM tst
UNION ALL SELECT 'label', CASE WHEN count_if(is_readmitted NOT IN (0, 1)) = 0 THEN 'PASS' ELSE 'FAIL' END, count_if(is_readmitted NOT IN (0, 1))::BIGINT FROM gold""")
def population_checks(p):
    late = p.stays.join(p.entities.select(F.col("id").alias("entity"), "death"), "entity").where(F.col("death") <= F.to_date("start"))
    checks = (
        ("ids", p.entities.agg((F.count("*") - F.countDistinct("id")).alias("n")), F.col("n") == 0, "FAIL"),
        ("posthumous", late.agg(F.count("*").alias("n")), F.col("n") == 0, "WARN"),
        ("power", p.test.agg(F.sum("is_readmitted").alias("n")), F.col("n") >= 50, "FAIL"),
        ("label", p.gold.agg(F.count_if(~F.col("is_readmitted").isin(0, 1)).alias("n")), F.col("n") == 0, "FAIL"),
    )
    return union_all([f.select(F.lit(n).alias("check_name"), F.when(ok, "PASS").otherwise(bad).alias("status"), "n") for n, f, ok, bad in checks])


@query("population_checks_all")
def population_checks_all(p):
    """population_checks, whose SQL holds four, with structure, latest start, label horizon and disjointness."""
    end = F.lit(REFERENCE_END).cast("timestamp_ntz")
    start = F.lit(TEST_START).cast("timestamp_ntz")
    g, s = p.gold, p.split
    empty = reduce(lambda a, b: a + b, (F.when(F.count(c) == 0, 1).otherwise(0) for c in g.columns))
    rate = F.avg("is_readmitted")
    both = s.where("partition = 'train'").select("patient_id").intersect(s.where("partition = 'test'").select("patient_id"))
    late = F.count_if((F.col("label_horizon") > F.col("index_stop") + F.expr("INTERVAL 30 DAYS")) & (F.col("partition") == "test"))
    exposed = F.count_if((F.col("partition") == "train") & (F.col("label_horizon") >= start))
    checks = (
        ("structure", g.agg((empty + F.when((rate > 0) & (rate < 1), 0).otherwise(1)).cast("long").alias("n")), "FAIL"),
        ("latest", p.stays.agg((F.count_if(F.col("start").isNull()) + F.count_if(F.col("start") >= end)).alias("n")), "WARN"),
        ("horizon", s.agg(exposed.alias("n")), "FAIL"),
        ("late_labels", s.agg(late.alias("n")), "INFO"),
        ("disjoint", both.agg(F.count("*").alias("n")), "FAIL"),
    )
    more = [f.select(F.lit(n).alias("check_name"), F.when(F.col("n") == 0, "PASS").otherwise(bad).alias("status"), "n") for n, f, bad in checks]
    return union_all([population_checks(p), *more])


query("run_constants", "SELECT as_of_date, count(DISTINCT model_bundle_id) = 1 AND count(DISTINCT scoring_run_id) = 1 AND count_if(partition <> 'test') = 0 AS constant FROM prd GROUP BY 1")(
    lambda p: p.predictions.groupBy("as_of_date").agg(((assertions.constant("model_bundle_id") + assertions.constant("scoring_run_id") == 0) & (F.count_if(F.col("partition") != "test") == 0)).alias("constant"))
)

# --- monitoring
query("required_ticks", "SELECT d, tick, kind FROM req", COH)(lambda p: p.required)
query("published_runs", "SELECT as_of_date, scoring_run_id, n_rows FROM pub", COH)(lambda p: p.published)
query("found_ticks", "SELECT d, scoring_run_id FROM fnd", COH)(lambda p: p.found)
_COHORT = "SELECT d, n_matured, observed, round(expected, 8) AS expected, n_label_after_sim, coverage_required, coverage_found, round(auc, 8) AS auc, coverage FROM coh"
query("cohort_eval", _COHORT, COH)(lambda p: rounded(p.cohorts))
query("monitor_replay", "SELECT d, n_matured, observed, round(expected, 8) AS expected, round(oe_ratio, 6) AS oe_ratio, coverage, verdict FROM jud", COH)(
    lambda p: rounded(p.judged.select("d", "n_matured", "observed", "expected", F.round("oe_ratio", 6).alias("oe_ratio"), "coverage", "verdict"))
)
query("oe_rule", "SELECT d, round(oe_ratio, 6) AS ratio, round(oe_ci_low, 6) AS ci_low, round(oe_ci_high, 6) AS ci_high, rule AS verdict FROM jud", COH)(
    lambda p: rounded(p.judged.select("d", F.col("oe_ratio").alias("ratio"), F.col("oe_ci_low").alias("ci_low"), F.col("oe_ci_high").alias("ci_high"), F.col("rule").alias("verdict")), 6)
)


@query("tick_gate", """SELECT r.run_date, n = 1 AND good AND coalesce(one, false) AS ok FROM (SELECT run_date, count(*) AS n, min(scoring_run_id) AS scoring_run_id,
bool_and(status = 'succeeded' AND published AND model_bundle_id = 'bundle-1' AND window_days = 7 AND top_n = 10) AS good FROM runs GROUP BY 1) r
LEFT JOIN (SELECT scoring_run_id, count(DISTINCT gold_fingerprint_definition) = 1 AND bool_and(gold_fingerprint = 'gold-1') AND count(DISTINCT as_of_date) = 1 AS one FROM prd GROUP BY 1) c USING (scoring_run_id)""")
def tick_gate(p):
    """A date may be evaluated if its one run is as configured and its predictions carry one definition and the labels' fingerprint."""
    as_set = (F.col("status") == "succeeded") & F.col("published") & (F.col("model_bundle_id") == "bundle-1") & (F.col("window_days") == WINDOW) & (F.col("top_n") == TOP_N)
    runs = p.runs.groupBy("run_date").agg(F.count("*").alias("n"), F.min("scoring_run_id").alias("scoring_run_id"), F.bool_and(as_set).alias("good"))
    one = (F.countDistinct("gold_fingerprint_definition") == 1) & F.bool_and(F.col("gold_fingerprint") == "gold-1") & (F.countDistinct("as_of_date") == 1)
    carried = p.predictions.groupBy("scoring_run_id").agg(one.alias("one"))
    return runs.join(carried, "scoring_run_id", "left").select("run_date", ((F.col("n") == 1) & F.col("good") & F.coalesce("one", F.lit(False))).alias("ok"))


_CLOCK = """bnd AS (SELECT model_bundle_id FROM tik WHERE status = 'succeeded' ORDER BY started_at DESC, monitoring_run_id DESC LIMIT 1), clk AS (SELECT max(sim_date) AS sim_date, any_value(model_bundle_id) AS bundle FROM tik JOIN bnd USING (model_bundle_id) WHERE status = 'succeeded')"""


def clock(p) -> DataFrame:
    """One row: the bundle of the newest succeeded tick and that bundle's latest date."""
    good = p.ticks.where("status = 'succeeded' and sim_date is not null and model_bundle_id is not null")
    newest = good.agg(F.max_by("model_bundle_id", F.struct("started_at", "monitoring_run_id")).alias("bundle"))
    return good.join(F.broadcast(newest), F.col("model_bundle_id") == F.col("bundle")).groupBy("bundle").agg(F.max("sim_date").alias("sim_date"))


query("simulated_clock", "SELECT bundle, sim_date FROM clk", COH, _CLOCK)(clock)
query("monitoring_points", "SELECT sim_date, verdict, observed, round(expected, 8) AS expected FROM tik WHERE status = 'succeeded' AND model_bundle_id = 'bundle-1'", COH)(
    lambda p: rounded(
        p.ticks.where("status = 'succeeded' and model_bundle_id = 'bundle-1' and verdict is not null").groupBy("sim_date")
        .agg(F.max_by(F.struct("verdict", "observed", "expected"), F.struct("started_at", "monitoring_run_id")).alias("x")).select("sim_date", "x.*")
    )
)
query("other_runs", "SELECT scoring_run_id, started_at FROM runs WHERE scoring_run_id NOT IN (SELECT scoring_run_id FROM tik) ORDER BY started_at DESC LIMIT 50", COH)(
    lambda p: p.runs.join(p.ticks.select("scoring_run_id"), "scoring_run_id", "left_anti").orderBy(F.desc("started_at")).limit(50).select("scoring_run_id", "started_at")
)
query("heartbeat", """SELECT max(sim_date) AS newest, (date_trunc('week', max(started_at)) + INTERVAL 11 DAY)::TIMESTAMP AS late_after, max(started_at) + INTERVAL 14 DAY AS stale_after,
CASE WHEN max(started_at) + INTERVAL 14 DAY < TIMESTAMP '2001-06-10' THEN 'stale' WHEN date_trunc('week', max(started_at)) + INTERVAL 11 DAY < TIMESTAMP '2001-06-10' THEN 'late' ELSE 'fresh' END AS state FROM tik WHERE status = 'succeeded'""", COH)(
    lambda p: p.ticks.where("status = 'succeeded'").agg(F.max("sim_date").alias("newest"), F.max("started_at").alias("at"))
    .select("newest", (F.date_trunc("week", "at").cast("timestamp_ntz") + F.expr("INTERVAL 11 DAYS")).alias("late_after"), (F.col("at") + F.expr("INTERVAL 14 DAYS")).alias("stale_after"))
    .withColumn("state", F.when(F.col("stale_after") < F.lit("2001-06-10").cast("timestamp_ntz"), "stale").when(F.col("late_after") < F.lit("2001-06-10").cast("timestamp_ntz"), "late").otherwise("fresh"))
)

# --- views and reports
VIEW = ("scoring_run_id", "run_date", "started_at", "status", "published", "model_bundle_id", "n_predictions")
query("view_scoring_runs", f"SELECT {', '.join(VIEW)} FROM runs")(lambda p: p.runs.select(*VIEW))
TICK_VIEW = ("monitoring_run_id", "sim_date", "started_at", "status", "verdict", "n_matured", "observed", "coverage_required", "coverage_found")
query("view_monitoring", f"SELECT {', '.join(TICK_VIEW)} FROM tik", COH)(lambda p: p.ticks.select(*TICK_VIEW))
query("recent_runs", "SELECT scoring_run_id, started_at, status FROM runs ORDER BY started_at DESC, scoring_run_id LIMIT 50")(
    lambda p: p.runs.orderBy(F.desc("started_at"), "scoring_run_id").limit(50).select("scoring_run_id", "started_at", "status")
)


def visible(runs: DataFrame, clock_date: Column, fingerprint: str) -> DataFrame:
    """``runs`` without published ones that are after the clock or of another table, and how many these are (``n_hidden``)."""
    hidden = F.coalesce(F.col("published") & ((F.col("run_date") > clock_date) | (F.col("gold_fingerprint") != fingerprint)), F.lit(False))
    return runs.where(~hidden).crossJoin(F.broadcast(runs.agg(F.count_if(hidden).alias("n_hidden"))))  # one row


def latest(p) -> DataFrame:
    newest = W.partitionBy("run_date").orderBy(F.desc("started_at"), F.desc("scoring_run_id"))
    return p.runs.where("published").withColumn("rn", F.row_number().over(newest)).where("rn = 1").drop("rn")


query("published_dates", """SELECT run_date, scoring_run_id, n_predictions, c.sim_date AS clock_sim_date FROM (SELECT *, row_number() OVER (PARTITION BY run_date ORDER BY started_at DESC, scoring_run_id DESC) AS rn FROM runs WHERE published) CROSS JOIN clk c
WHERE rn = 1 AND run_date <= c.sim_date ORDER BY run_date DESC LIMIT 500""", COH, _CLOCK)(
    lambda p: latest(p).crossJoin(F.broadcast(clock(p).select(F.col("sim_date").alias("clock_sim_date")))).where("run_date <= clock_sim_date").orderBy(F.desc("run_date")).limit(500)
    .select("run_date", "scoring_run_id", "n_predictions", "clock_sim_date")
)
query("visible_runs", """SELECT scoring_run_id, run_date, (SELECT count_if(published AND (run_date > DATE '2001-03-01' OR gold_fingerprint <> 'gold-1')) FROM runs)::BIGINT AS n_hidden FROM runs
WHERE NOT (published AND (run_date > DATE '2001-03-01' OR gold_fingerprint <> 'gold-1'))""")(
    lambda p: visible(p.runs, F.lit("2001-03-01").cast("date"), "gold-1").select("scoring_run_id", "run_date", "n_hidden")
)
_SHEET = """rat AS (SELECT coalesce(admission_reason_code, 'MISSING') AS k, count(*)::BIGINT AS n, avg(is_readmitted) AS r FROM gold WHERE index_stop < TIMESTAMP '2000-01-01' AND label_horizon < TIMESTAMP '2000-01-01' GROUP BY 1),
sht AS (SELECT as_of_date, rank, is_top_n, p.encounter_id, g.index_stop AS discharge_time, p.admission_reason_code, round(risk_score, 8) AS risk_score, round((epoch_us(g.index_stop) - epoch_us(g.index_start)) / 86400000000.0, 8) AS length_of_stay_days,
g.prior_inpatient_count, n AS reason_history_n, CASE WHEN n >= 30 THEN round(r, 8) END AS reason_history_rate FROM prd p JOIN gold g USING (encounter_id) LEFT JOIN rat ON k = coalesce(p.admission_reason_code, 'MISSING'))"""


def call_sheet(p) -> DataFrame:
    from ..operators.enrich import stay_days

    g = p.gold.select("encounter_id", "index_start", "index_stop", "prior_inpatient_count")
    rates = evaluate.settled_rates(p.gold, F.lit("2000-01-01").cast("timestamp_ntz"))
    rates = rates.select("reason_key", F.col("n").alias("reason_history_n"), F.col("rate").alias("reason_history_rate"))
    rows = p.predictions.join(g, "encounter_id").withColumn("reason_key", F.coalesce("admission_reason_code", F.lit("MISSING"))).join(rates, "reason_key", "left")
    days = stay_days(F.col("index_start"), F.col("index_stop")).alias("length_of_stay_days")
    return rounded(rows.select("as_of_date", "rank", "is_top_n", "encounter_id", F.col("index_stop").alias("discharge_time"), "admission_reason_code", "risk_score", days, "prior_inpatient_count", "reason_history_n", "reason_history_rate"))


query("call_sheet", "SELECT * FROM sht", _SHEET)(call_sheet)
def landed_sheet(p) -> DataFrame:
    """The sheet as its reader finds it, written by date: a filter on ``as_of_date`` opens that date's files only."""
    path, sheet = p.shared_path("sheet"), call_sheet(p)
    sheet.hint("rebalance", F.col("as_of_date")).write.partitionBy("as_of_date").parquet(path)
    return p.spark.read.schema(sheet.schema).parquet(path)


def recomputed_sheet(p) -> DataFrame:
    """What the sheet must hold, not made of predictions: stays, their scores and features, and the date by arithmetic."""
    from ..operators.enrich import stay_days

    since = F.datediff(F.col("stop"), F.lit(FIRST_DATE).cast("date"))
    date = F.date_add(F.lit(FIRST_DATE).cast("date"), (F.ceil(since / STEP) * STEP).cast("int"))  # the first run date from the stop's day on
    stays = p.stays.select(F.col("id").alias("encounter_id"), F.col("start"), F.col("stop"), F.col("reason").alias("admission_reason_code"))
    more = p.test.select("encounter_id", F.col("p").alias("risk_score"), "prior_inpatient_count")
    rows = stays.join(more, "encounter_id").withColumn("as_of_date", date).where(F.col("as_of_date").between(F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date")) & (F.datediff("as_of_date", "stop") < WINDOW))
    return rows.select("as_of_date", "encounter_id", F.col("stop").alias("discharge_time"), "admission_reason_code", "risk_score", stay_days(F.col("start"), F.col("stop")).alias("length_of_stay_days"), "prior_inpatient_count")


@query("sheet_check", """SELECT as_of_date, count(*)::BIGINT AS n_rows, 0::BIGINT AS n_wrong, count_if(encounter_id % 7 = 0)::BIGINT AS n_planted, count_if(encounter_id % 5 = 0)::BIGINT AS n_lost,
((SELECT count(*) FROM prd) - count(*))::BIGINT AS n_unfiltered FROM prd GROUP BY 1""")
def sheet_check(p):
    """The landed sheet against its recomputation, by date: what is wrong with it, and what is found wrong with copies
    that have changed scores or lost rows; ``n_unfiltered`` counts the rows of other dates, which a reader without the filter would get."""
    sheet, wanted = landed_sheet(p), recomputed_sheet(p)
    planted = sheet.withColumn("risk_score", F.when(F.col("encounter_id") % 7 == 0, F.col("risk_score") + 1e-3).otherwise(F.col("risk_score")))
    sides = {"n_planted": planted, "n_lost": sheet.where("encounter_id % 5 <> 0")}
    faults = F.col("n_missing") + F.col("n_extra") + F.col("n_different")
    out = mismatches(sheet, wanted, "as_of_date", "encounter_id").select("as_of_date", F.col("n_wanted").alias("n_rows"), F.col("n_found").alias("_found"), faults.alias("n_wrong"))
    for name in ("n_planted", "n_lost"):
        out = out.join(mismatches(sides[name], wanted, "as_of_date", "encounter_id").select("as_of_date", faults.alias(name)), "as_of_date")
    total = sheet.agg(F.count("*").alias("_total"))  # one row
    return out.crossJoin(F.broadcast(total)).withColumn("n_unfiltered", F.col("_total") - F.col("_found")).drop("_total", "_found")


query("call_sheet_parity", "SELECT unnest(['rank', 'risk_score']) AS column_name, 0::BIGINT AS n_different, 0::BIGINT AS n_only_left, 0::BIGINT AS n_only_right FROM (SELECT count(*) FROM prd)")(
    lambda p: table_diff(call_sheet(p).select("encounter_id", "rank", "risk_score"), rounded(p.predictions.select("encounter_id", "rank", "risk_score")), "encounter_id")
)
query("sheet_warnings", "SELECT as_of_date, count(*) <> any_value(n_predictions) AS wrong_count, count_if(is_top_n) <> least(10, count(*)) AS wrong_flags FROM prd JOIN runs USING (scoring_run_id) GROUP BY 1")(
    lambda p: p.predictions.join(p.runs.select("scoring_run_id", "n_predictions"), "scoring_run_id").groupBy("as_of_date")
    .agg((F.count("*") != F.max("n_predictions")).alias("wrong_count"), (F.count_if("is_top_n") != F.least(F.lit(TOP_N), F.count("*"))).alias("wrong_flags"))
)
query("ledger_rows", "SELECT strftime(sim_date, '%Y-%m-%d') AS week, coalesce(verdict, status) AS verdict_text, CASE WHEN observed IS NULL THEN '-' ELSE observed || ' of ' || n_matured END AS observed_text FROM tik", COH)(
    lambda p: p.ticks.select(F.date_format("sim_date", "yyyy-MM-dd").alias("week"), F.coalesce("verdict", "status").alias("verdict_text"),
                             F.coalesce(F.concat(F.col("observed").cast("string"), F.lit(" of "), F.col("n_matured").cast("string")), F.lit("-")).alias("observed_text"))
)
