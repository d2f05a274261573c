"""Queries over scored rows: metrics, calibration, bootstrap, gates, encodings and models."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import enrich, evaluate, models, parameters, split
from ..operators.fingerprint import score_parity, union_all
from ..sources import package, tables
from . import registry
from .registry import query

RESAMPLES, FOLDS, ROUNDS = 2000, 5, 300  # of the reference
NUMBERS = ("organization_utilization", *enrich.NAMES, "age_at_index_years")


class Plans(registry.Plans):
    @cached_property
    def train(self) -> DataFrame:
        return self.scored.where("partition = 'train'")

    @cached_property
    def arms(self) -> DataFrame:
        """Test rows with a challenger p, a champion q and the smoothed code rate."""
        q = (F.col("encounter_id") * 104729 % 1000 + F.lit(0.5)) / 1000 * 0.11
        return self.landed("arms", lambda: evaluate.reason_lookup(self.train, self.test.withColumn("q", q), "is_readmitted", "admission_reason_code"))

    @cached_property
    def blocks(self) -> DataFrame:
        return self.landed("blocks", lambda: evaluate.block_rows(self.arms, "is_readmitted", ["p", "q", "lookup"], "patient_id"))

    @cached_property
    def sums(self) -> DataFrame:
        return self.landed("sums", lambda: evaluate.block_sums(self.blocks, RESAMPLES))

    @cached_property
    def samples(self) -> DataFrame:
        return self.landed("samples", lambda: evaluate.resampled_metrics(self.sums))

    @cached_property
    def curve(self) -> DataFrame:
        return evaluate.calibration(self.test, "is_readmitted", "p")


registry.Plans = Plans


def rounded(frame: DataFrame, digits: int = 8) -> DataFrame:
    return frame.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in frame.dtypes))


query("eval_validate", """SELECT count(*)::BIGINT AS n, 0::BIGINT AS bad_label, count_if(NOT (p BETWEEN 0 AND 1))::BIGINT AS bad_score, count(DISTINCT is_readmitted) AS n_classes, true AS valid FROM tst""")(
    lambda p: evaluate.validate(p.test, "is_readmitted", "p")
)


@query("eval_scalar", """SELECT n, n_positive, round(brier, 8) AS brier, round(log_loss, 8) AS log_loss, round(mean_score, 8) AS mean_score, round(prevalence, 8) AS prevalence,
round(oe_ratio, 8) AS oe_ratio, round(1 - brier / base, 8) AS brier_skill, round(mean_score - prevalence, 8) AS gap, round(abs(mean_score - prevalence), 8) AS abs_gap FROM (
SELECT count(*)::BIGINT AS n, sum(is_readmitted)::BIGINT AS n_positive, avg((p - is_readmitted) ** 2) AS brier, avg((r - is_readmitted) ** 2) AS base,
avg(-(is_readmitted * ln(p) + (1 - is_readmitted) * ln(1 - p))) AS log_loss, avg(p) AS mean_score, avg(is_readmitted) AS prevalence, sum(is_readmitted) / sum(p) AS oe_ratio
FROM tst, (SELECT avg(is_readmitted) AS r FROM spl WHERE partition = 'train'))""")
def eval_scalar(p):
    base = F.broadcast(p.train.agg(F.avg("is_readmitted").alias("base")))
    return rounded(evaluate.scalars(p.test.crossJoin(base), "is_readmitted", "p", F.col("base")))


query("eval_auc", """SELECT round(sum(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END) / count(*), 8) AS auc FROM tst a, tst b WHERE a.is_readmitted = 1 AND b.is_readmitted = 0""")(
    lambda p: rounded(evaluate.auc(p.test, "is_readmitted", "p"))
)
query("eval_ap", """SELECT round(sum(pos * c / m) / sum(pos), 8) AS average_precision FROM (SELECT pos, sum(pos) OVER w AS c, sum(n) OVER w AS m
FROM (SELECT p, sum(is_readmitted) AS pos, count(*) AS n FROM tst GROUP BY p) WINDOW w AS (ORDER BY p DESC))""")(
    lambda p: rounded(evaluate.average_precision(p.test, "is_readmitted", "p"))
)

_CURVE = """edg AS (SELECT list_sort(list_distinct(quantile_cont(p, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]))) AS e FROM tst),
crv AS (SELECT bin, count(*)::BIGINT AS n, sum(is_readmitted)::BIGINT AS n_positive, avg(p) AS mean_score, avg(is_readmitted) AS rate FROM (SELECT *, greatest(0, least(len(list_filter(e, lambda x: x <= p)) - 1, len(e) - 2))::INT AS bin
FROM tst, edg) GROUP BY bin)"""
query("calibration_curve", "SELECT bin, n, n_positive, round(mean_score, 8) AS mean_score, round(rate, 8) AS rate FROM crv", _CURVE)(lambda p: rounded(p.curve))
query("ece", "SELECT round(sum(n * abs(mean_score - rate)) / sum(n), 8) AS ece FROM crv", _CURVE)(lambda p: rounded(evaluate.ece(p.curve)))
query("reliability_bins", """SELECT bin, n, n_positive, round(mean_score, 8) AS mean_score, round(rate, 8) AS rate,
round(CASE WHEN n_positive = 0 THEN 0.0 ELSE (rate + zz / (2 * n) - z * sqrt(rate * (1 - rate) / n + zz / (4 * n * n))) / (1 + zz / n) END, 8) AS low,
round(CASE WHEN n_positive = n THEN 1.0 ELSE (rate + zz / (2 * n) + z * sqrt(rate * (1 - rate) / n + zz / (4 * n * n))) / (1 + zz / n) END, 8) AS high
FROM crv, (SELECT 1.959963984540054::DOUBLE AS z, 1.959963984540054::DOUBLE ** 2 AS zz)""", _CURVE)(lambda p: rounded(evaluate.wilson(p.curve)))

_LOOK = """lok AS MATERIALIZED (SELECT t.*, ((encounter_id * 104729) % 1000 + 0.5::DOUBLE) / 1000 * 0.11 AS q, coalesce((s + 10 * base) / (n + 10), base) AS lookup
FROM tst t CROSS JOIN (SELECT avg(is_readmitted) AS base FROM spl WHERE partition = 'train') LEFT JOIN (SELECT coalesce(admission_reason_code, 'MISSING') AS k, sum(is_readmitted) AS s, count(*) AS n
FROM spl WHERE partition = 'train' GROUP BY 1) ON k = coalesce(admission_reason_code, 'MISSING'))"""
query("reason_lookup", "SELECT encounter_id, round(lookup, 8) AS lookup FROM lok", _LOOK)(lambda p: rounded(p.arms.select("encounter_id", "lookup")))
query("reason_rates", """SELECT coalesce(admission_reason_code, 'MISSING') AS reason_key, count(*)::BIGINT AS n, CASE WHEN count(*) >= 30 THEN round(avg(is_readmitted), 8) END AS rate
FROM gold WHERE index_stop < TIMESTAMP '2000-01-01' AND label_horizon < TIMESTAMP '2000-01-01' GROUP BY 1""")(
    lambda p: rounded(evaluate.settled_rates(p.gold, F.lit("2000-01-01").cast("timestamp_ntz")))
)

def _mixed(rows: str) -> str:
    """``rows`` with their column x mixed; 32-bit numbers multiply without overflow as unsigned 64-bit ones."""
    for shift, times in ((16, evaluate._MIX_1), (13, evaluate._MIX_2), (16, 1)):
        rows = f"(SELECT * REPLACE ((xor(x, x >> {shift}) * {times}::UBIGINT) % 4294967296::UBIGINT AS x) FROM {rows})"
    return rows


_WEIGHT = " + ".join(f"(x >= {t})::BIGINT" for t in evaluate.POISSON)
_BOOT = (_LOOK, f"""eix AS (SELECT patient_id, ('0x' || substr(h, 1, 8))::UBIGINT AS e1, ('0x' || substr(h, 9, 8))::UBIGINT AS e2 FROM (SELECT DISTINCT patient_id, md5(patient_id::VARCHAR) AS h FROM tst)),
mxd AS (SELECT patient_id, b, {_WEIGHT} AS w FROM {_mixed("(SELECT * REPLACE (xor(x, e2) AS x) FROM " + _mixed(f"(SELECT *, (e1 + b::UBIGINT * {evaluate._GOLDEN}::UBIGINT) % 4294967296::UBIGINT AS x FROM eix, range({RESAMPLES}) r(b))") + ")")}),
wgt AS MATERIALIZED (SELECT b, w, is_readmitted AS y, p, q, lookup FROM mxd JOIN lok USING (patient_id) WHERE w > 0),
lng AS (SELECT b, w, y, 'p' AS arm, p FROM wgt UNION ALL SELECT b, w, y, 'q', q FROM wgt UNION ALL SELECT b, w, y, 'lookup', lookup FROM wgt),
are AS (SELECT b, arm, sum(pos * (below + neg / 2)) / nullif(sum(pos) * sum(neg), 0) AS auc FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY b, arm ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
FROM (SELECT b, arm, p, sum(w * y)::DOUBLE AS pos, sum(w * (1 - y))::DOUBLE AS neg FROM lng GROUP BY ALL)) GROUP BY ALL),
smp AS MATERIALIZED (SELECT * FROM are JOIN (SELECT b, arm, sum(w * (p - y) ** 2) / sum(w) AS brier, sum(w * y) / sum(w * p) AS oe FROM lng GROUP BY ALL) USING (b, arm))""")  # fmt: skip


@query("bootstrap_ci", """SELECT arm, round(quantile_cont(auc, 0.025), 8) AS auc_low, round(quantile_cont(auc, 0.975), 8) AS auc_high, round(quantile_cont(brier, 0.025), 8) AS brier_low,
round(quantile_cont(brier, 0.975), 8) AS brier_high, count(auc) AS n_used FROM smp GROUP BY arm""", *_BOOT)
def bootstrap_ci(p):
    s = p.samples
    ends = [c.alias(f"{m}_{e}") for m in ("auc", "brier") for c, e in zip(evaluate.interval(s, F.col(m)), ("low", "high"), strict=True)]
    return rounded(s.groupBy("arm").agg(*ends, F.count("auc").alias("n_used")))


_ECE = """rcn AS (SELECT b, arm, p, sum(w)::BIGINT AS n, sum(w * (p - y)) AS d FROM lng GROUP BY ALL),
rcu AS MATERIALIZED (SELECT *, sum(n) OVER w - n AS below, sum(n) OVER (PARTITION BY b, arm) AS total FROM rcn WINDOW w AS (PARTITION BY b, arm ORDER BY p)),
rqt AS (SELECT b, arm, i, min(CASE WHEN below <= floor(place) AND floor(place) < below + n THEN p END) AS low, min(CASE WHEN below <= ceil(place) AND ceil(place) < below + n THEN p END) AS high,
max(place - floor(place)) AS share FROM (SELECT b, arm, p, n, below, i, (total - 1) * i / 10 AS place FROM rcu, range(11) r(i)) GROUP BY ALL),
red AS (SELECT b, arm, list_sort(list_distinct(list(low + (high - low) * share))) AS e FROM rqt GROUP BY ALL),
ees AS (SELECT b, arm, sum(abs(d)) / sum(n) AS ece FROM (SELECT b, arm, sum(n) AS n, sum(d) AS d
FROM (SELECT rcu.*, greatest(0, least(len(list_filter(e, lambda x: x <= p)) - 1, len(e) - 2)) AS bin FROM rcu JOIN red USING (b, arm)) GROUP BY b, arm, bin) GROUP BY ALL)"""


@query("bootstrap_ece", """SELECT arm, round(quantile_cont(ece, 0.025), 8) AS ece_low, round(quantile_cont(ece, 0.975), 8) AS ece_high, round(avg(ece), 8) AS ece_mean, count(ece) AS n_used
FROM ees GROUP BY arm""", *_BOOT, _ECE)
def bootstrap_ece(p):
    """Intervals of the calibration error, over each resample's own quantile bins."""
    s = evaluate.resampled_ece(p.blocks, p.sums)
    low, high = evaluate.interval(s, F.col("ece"))
    return rounded(s.groupBy("arm").agg(low.alias("ece_low"), high.alias("ece_high"), F.avg("ece").alias("ece_mean"), F.count("ece").alias("n_used")))


@query("promotion_gate", """SELECT round(a, 8) AS auc_gain_low, round(b, 8) AS auc_over_lookup_low, round(c, 8) AS brier_loss_high, n_used, CASE WHEN a > 0 AND b > 0 AND c <= 0.05 * (SELECT avg((q - is_readmitted) ** 2) FROM lok) THEN 'PROMOTE' ELSE 'REFUSE' END AS decision
FROM (SELECT quantile_cont(p.auc - q.auc, 0.025) AS a, quantile_cont(p.auc - l.auc, 0.025) AS b, quantile_cont(p.brier - q.brier, 0.975) AS c, count(p.auc - q.auc) AS n_used
FROM smp p JOIN smp q ON q.b = p.b AND q.arm = 'q' JOIN smp l ON l.b = p.b AND l.arm = 'lookup' WHERE p.arm = 'p')""", *_BOOT)
def promotion_gate(p):
    brier = p.arms.agg(F.avg((F.col("q") - F.col("is_readmitted")) * (F.col("q") - F.col("is_readmitted"))).alias("v")).first()["v"]  # one number
    return rounded(evaluate.promotion_gate(p.samples, "p", "q", "lookup", F.lit(brier)))


@query("negative_control", """SELECT round(a, 8) AS auc_gain_low, round(b, 8) AS auc_over_lookup_low, round(c, 8) AS brier_loss_high, n_used, CASE WHEN a > 0 AND b > 0 AND c <= 0.05 * (SELECT avg((q - is_readmitted) ** 2) FROM lok) THEN 'PROMOTE' ELSE 'REFUSE' END AS decision
FROM (SELECT quantile_cont(CASE WHEN two THEN 0.5 END - q.auc, 0.025) AS a, quantile_cont(CASE WHEN two THEN 0.5 END - l.auc, 0.025) AS b, quantile_cont(k.brier - q.brier, 0.975) AS c, count(CASE WHEN two THEN 0.5 END - q.auc) AS n_used
FROM (SELECT b, sum(w * y) * sum(w * (1 - y)) > 0 AS two, sum(w * (base - y) ** 2) / sum(w) AS brier FROM wgt, (SELECT avg(is_readmitted) AS base FROM spl WHERE partition = 'train') GROUP BY b) k
JOIN smp q ON q.b = k.b AND q.arm = 'q' JOIN smp l ON l.b = k.b AND l.arm = 'lookup')""", *_BOOT)
def negative_control(p):
    """The constant score of the train prevalence as challenger: the gate must refuse it."""
    base = p.train.agg(F.avg("is_readmitted").alias("v")).first()["v"]  # one number
    constant = evaluate.bootstrap(p.arms.withColumn("constant", F.lit(base)), "is_readmitted", ["constant"], "patient_id", RESAMPLES)
    samples = p.samples.where("arm <> 'p'").unionByName(constant)
    brier = p.arms.agg(F.avg((F.col("q") - F.col("is_readmitted")) * (F.col("q") - F.col("is_readmitted"))).alias("v")).first()["v"]  # one number
    return rounded(evaluate.promotion_gate(samples, "constant", "q", "lookup", F.lit(brier)))


query("acceptance", """SELECT round(a, 8) AS auc_low, round(l, 8) AS oe_low, round(h, 8) AS oe_high, a >= 0.4 AND l <= 1.25 AND h >= 0.8 AS accepted
FROM (SELECT quantile_cont(auc, 0.025) AS a, quantile_cont(oe, 0.025) AS l, quantile_cont(oe, 0.975) AS h FROM smp WHERE arm = 'p')""", *_BOOT)(
    lambda p: rounded(evaluate.acceptance(p.samples, "p", 0.4, (0.8, 1.25)))
)


_ENCODED = ("provider_specialty", "gender", "admission_reason_code")


def _encode_sql(c: str) -> str:
    """A frequent value of train stays, others are the rare one if train has one."""
    counts = f"(SELECT coalesce({c}, 'MISSING') AS k, count(*) AS n FROM spl WHERE partition = 'train' GROUP BY 1)"
    return f"""CASE WHEN coalesce({c}, 'MISSING') IN (SELECT k FROM {counts} WHERE n >= 20) THEN coalesce({c}, 'MISSING')
WHEN (SELECT count_if(n < 20) FROM {counts}) > 0 THEN '__infrequent__' END AS {c}"""


query("category_encode", f"SELECT encounter_id, {', '.join(map(_encode_sql, _ENCODED))} FROM tst")(
    lambda p: models.encode_categories(enrich.prepare_features(p.train), enrich.prepare_features(p.test), _ENCODED).select("encounter_id", *_ENCODED)
)
query("prep_linear", """SELECT encounter_id, round((ln(1 + prior_encounter_count) - m) / CASE WHEN s > 0 THEN s ELSE 1 END, 6) AS prior_encounter_count, round((age_at_index_years - ma) / CASE WHEN sa > 0 THEN sa ELSE 1 END, 6) AS age_at_index_years
FROM tst, (SELECT avg(ln(1 + prior_encounter_count)) AS m, stddev_pop(ln(1 + prior_encounter_count)) AS s, avg(age_at_index_years) AS ma, stddev_pop(age_at_index_years) AS sa FROM spl WHERE partition = 'train')""")(
    lambda p: rounded(models.standardize(enrich.prepare_features(p.train), enrich.prepare_features(p.test), ("prior_encounter_count",), ("age_at_index_years",)).select("encounter_id", "prior_encounter_count", "age_at_index_years"), 6)
)
query("linear_score", """SELECT encounter_id, round(1 / (1 + exp(-(-3 + 0.4 * ln(1 + prior_inpatient_count) + 0.01 * age_at_index_years))), 8) AS risk_score FROM tst""")(
    lambda p: rounded(p.test.withColumn("x", F.log1p("prior_inpatient_count")).select("encounter_id", models.linear_score({"x": 0.4, "age_at_index_years": 0.01}, -3.0).alias("risk_score")))
)


def _prepared(p, linear: bool = True) -> list[DataFrame]:
    """Train and test model inputs with label and fold, landed; ``linear`` standardises numbers, trees take them as they are."""

    def ready(rows: DataFrame) -> DataFrame:
        x = enrich.prepare_features(rows)
        if linear:
            x = models.standardize(enrich.prepare_features(p.train), x, enrich.NAMES, ("organization_utilization", "age_at_index_years"))
        y = split.balanced_folds(rows, FOLDS).select("encounter_id", "patient_id", F.col("is_readmitted").cast("double").alias("label"), "fold")
        return x.na.fill(0.0).join(y, "encounter_id")

    kind = "linear" if linear else "tree"
    return [p.landed(f"{kind}-{side}", lambda rows=rows: ready(rows)) for side, rows in (("train", p.train), ("test", p.test))]


@query("isotonic_calibration", """SELECT encounter_id, round(CASE WHEN a.x IS NULL THEN b.f WHEN b.x IS NULL OR a.x = b.x THEN a.f ELSE a.f + (b.f - a.f) * (p - a.x) / (b.x - a.x) END, 8) AS calibrated
FROM tst ASOF LEFT JOIN isf a ON tst.p >= a.x ASOF LEFT JOIN isf b ON tst.p <= b.x""",
"""iso AS MATERIALIZED (SELECT x, k, s, n, sum(s) OVER (ORDER BY k) AS cs, sum(n) OVER (ORDER BY k) AS cn FROM (SELECT p AS x, sum(is_readmitted)::DOUBLE AS s, count(*) AS n, row_number() OVER (ORDER BY p) AS k FROM scr WHERE partition = 'train' GROUP BY p)),
ism AS (SELECT a.k AS i, b.k, min((b.cs - a.cs + a.s) / (b.cn - a.cn + a.n)) OVER (PARTITION BY a.k ORDER BY b.k DESC) AS m FROM iso a JOIN iso b ON a.k <= b.k),
isf AS MATERIALIZED (SELECT x, f FROM iso JOIN (SELECT k, max(m) AS f FROM ism GROUP BY k) USING (k))""")
def isotonic_calibration(p):
    """Test scores through the non-decreasing function fitted on train."""
    model = models.fit_isotonic(p.train, "p", "is_readmitted")
    return rounded(model.transform(p.test.select("encounter_id", "p")).select("encounter_id", "calibrated"))


@query("train_lr")
def train_lr(p):
    train, test = _prepared(p)
    return models.score_logistic(models.fit_logistic(train, NUMBERS, enrich.CATEGORICAL, "label"), test, "encounter_id")


_OTHERS = ("organization_utilization", "age_at_index_years")
_NUMBER_ROWS = ", ".join(f"{{'c': '{c}', 'x': {'ln(1 + ' + c + ')' if c in enrich.NAMES else c + '::DOUBLE'}}}" for c in NUMBERS)
_VALUE_ROWS = ", ".join(f"{{'c': '{c}', 'v': coalesce({c}, 'MISSING')}}" for c in enrich.CATEGORICAL)
EVIDENCE = f"""sin AS (SELECT encounter_id, partition, is_readmitted AS y, unnest([{_NUMBER_ROWS}], recursive := true) FROM spl WHERE partition IN ('train', 'test')),
siv AS (SELECT encounter_id, partition, is_readmitted AS y, unnest([{_VALUE_ROWS}], recursive := true) FROM spl WHERE partition IN ('train', 'test')),
sba AS MATERIALIZED (SELECT ln((sum(y) + 0.5) / (count(*) - sum(y) + 0.5)) AS base FROM (SELECT is_readmitted AS y FROM spl WHERE partition = 'train')),
snu AS MATERIALIZED (SELECT c, avg(x) AS m, CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1 END AS s, covar_pop(x, y) / CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1 END AS w FROM sin WHERE partition = 'train' GROUP BY c),
sct AS (SELECT c, v, count(*) AS n, sum(y) AS pos FROM siv WHERE partition = 'train' GROUP BY c, v),
sca AS MATERIALIZED (SELECT c, CASE WHEN n >= 20 THEN v ELSE '__infrequent__' END AS v, ln((sum(pos) + 0.5) / (sum(n) - sum(pos) + 0.5)) - any_value(base) AS w FROM sct, sba GROUP BY 1, 2),
szn AS (SELECT encounter_id, sum(coalesce((x - m) / s, 0) * w) AS z FROM sin JOIN snu USING (c) WHERE partition = 'test' GROUP BY 1),
szc AS (SELECT encounter_id, sum(coalesce(a.w, b.w, 0)) AS z FROM siv LEFT JOIN sca a ON a.c = siv.c AND a.v = siv.v LEFT JOIN sca b ON b.c = siv.c AND b.v = '__infrequent__' WHERE partition = 'test' GROUP BY 1)"""


@query("parameter_score", "SELECT encounter_id, round(1 / (1 + exp(-(base + szn.z + szc.z))), 8) AS risk_score FROM szn JOIN szc USING (encounter_id), sba", EVIDENCE)
def parameter_score(p):
    """Test rows scored from a stored scorecard of all columns, made of train."""
    train = enrich.prepare_features(p.train).join(p.train.select("encounter_id", "is_readmitted"), "encounter_id")
    made = parameters.evidence_parameters(train, "is_readmitted", enrich.NAMES, _OTHERS, enrich.CATEGORICAL)
    table = tables.write_once(made, p.shared_path("parameters"))
    return rounded(enrich.prepare_features(p.test).select("encounter_id", parameters.score(table).alias("risk_score")))


@query("parameter_parity")
def parameter_parity(p):
    """(n_rows, n_missing, max_difference): the fitted logistic model against its own stored parameters, over the test rows."""
    train, test = _prepared(p)
    model = models.fit_logistic(train, NUMBERS, enrich.CATEGORICAL, "label")
    scaled = parameters.scaling(enrich.prepare_features(p.train), enrich.NAMES, _OTHERS)
    table = tables.write_once(parameters.fitted_parameters(model, scaled, NUMBERS, enrich.CATEGORICAL), p.shared_path("parameters"))
    stored = enrich.prepare_features(p.test).select("encounter_id", parameters.score(table).alias("risk_score"))
    return score_parity(models.score_logistic(model, test, "encounter_id"), stored, "encounter_id", "risk_score")


def _boosted(p, method: str = "sigmoid") -> DataFrame:
    """Calibrated scores of the test rows, landed: models of hundreds of rounds are fitted once."""

    def scores() -> DataFrame:
        train, test = _prepared(p, linear=False)
        if p.spark.sparkContext.getCheckpointDir() is None:  # rounds cut their lineage there
            p.spark.sparkContext.setCheckpointDir(p.shared_path("boosting"))
        return models.score_boosted(models.fit_boosted(train, NUMBERS, enrich.CATEGORICAL, "label", "fold", FOLDS, ROUNDS, method=method), test, "encounter_id")

    return p.landed(f"boosted-{method}-{FOLDS}-{ROUNDS}", scores)


query("train_gbt_cal")(_boosted)


@query("score_batch")
def score_batch(p):
    """Counts that a scored batch must satisfy, beside the batch's size."""
    train, test = _prepared(p)
    scored = models.score_logistic(models.fit_logistic(train, NUMBERS, enrich.CATEGORICAL, "label"), test.drop("label"), "encounter_id")
    return scored.agg(F.count("*").alias("n"), F.count_if(~F.col("risk_score").between(0, 1) | F.isnan("risk_score")).alias("bad"))


def report(rows: DataFrame, y: str, arms: tuple[str, str], entity: str, base_rate: float, resamples: int = RESAMPLES) -> DataFrame:
    """(model, metric, value, low, high, n_used): both arms' metrics, and the second's less the first's as ``difference``.

    Intervals are of the clustered bootstrap, paired for the difference; metrics that it doesn't hold have none.
    """
    points = []
    for a in arms:
        one = evaluate.scalars(rows, y, a, F.lit(base_rate)).crossJoin(evaluate.auc(rows, y, a)).crossJoin(evaluate.average_precision(rows, y, a))
        one = one.crossJoin(evaluate.ece(evaluate.calibration(rows, y, a)))
        points.append(one.select(F.lit(a).alias("model"), *(F.col(c).cast("double").alias(c) for c in one.columns)))
    metrics = [c for c in points[0].columns if c != "model"]
    pair = points[0].alias("x").crossJoin(points[1].alias("y"))
    points.append(pair.select(F.lit("difference").alias("model"), *((F.col(f"y.{c}") - F.col(f"x.{c}")).alias(c) for c in metrics if c not in ("n", "n_positive", "prevalence"))))
    value = union_all([f.unpivot("model", [c for c in f.columns if c != "model"], "metric", "value") for f in points])

    land = lambda name, frame: tables.write_once(frame, package.shared_path(rows.sparkSession, name))
    blocks = land("report-blocks", evaluate.block_rows(rows, y, list(arms), entity))
    sums = land("report-sums", evaluate.block_sums(blocks, resamples))
    samples = evaluate.resampled_metrics(sums).where("auc is not null").join(evaluate.resampled_ece(blocks, sums), ["b", "arm"])
    samples = samples.select("b", F.col("arm").alias("model"), "auc", "brier", F.col("oe").alias("oe_ratio"), "gap", F.abs("gap").alias("abs_gap"), "ece")
    drawn = samples.unpivot(["b", "model"], ["auc", "brier", "oe_ratio", "gap", "abs_gap", "ece"], "metric", "v")
    paired = drawn.groupBy("b", "metric").pivot("model", list(arms)).agg(F.first("v"))
    drawn = drawn.unionByName(paired.select("b", F.lit("difference").alias("model"), "metric", (F.col(arms[1]) - F.col(arms[0])).alias("v")))
    low, high = evaluate.interval(drawn, F.col("v"))
    ends = drawn.groupBy("model", "metric").agg(low.alias("low"), high.alias("high"), F.count("v").alias("n_used"))
    return value.join(ends, ["model", "metric"], "left")


@query("train_report")
def train_report(p):
    """Both models fitted on train, their metrics on test and the paired intervals."""
    train, test = _prepared(p)
    linear = models.score_logistic(models.fit_logistic(train, NUMBERS, enrich.CATEGORICAL, "label"), test, "encounter_id")
    boosted = _boosted(p)
    names = ("logistic_regression", "boosted_calibrated")
    scored = linear.withColumnRenamed("risk_score", names[0]).join(boosted.withColumnRenamed("risk_score", names[1]), "encounter_id")
    rows = test.select("encounter_id", "patient_id", F.col("label").cast("int").alias("y")).join(scored, "encounter_id")
    rows = tables.write_once(rows, p.shared_path("report-scores"))
    base = train.agg(F.avg("label").alias("v")).first()["v"]  # one number
    return report(rows, "y", names, "patient_id", base)
