"""Discrimination, calibration, clustered bootstrap and rule-based gates over (y, score) rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources.package import ship_package

EPSILON = 1e-15


def validate(rows: DataFrame, y: str, score: str) -> DataFrame:
    """One row of counts; ``valid`` if labels are 0/1 with both classes and scores are finite and in [0, 1]."""
    p, t = F.col(score), F.col(y)
    out = rows.agg(
        F.count("*").alias("n"),
        F.count_if(~F.coalesce(t.isin(0, 1), F.lit(False))).alias("bad_label"),
        F.count_if(~F.coalesce(~F.isnan(p) & p.between(0, 1), F.lit(False))).alias("bad_score"),
        F.countDistinct(t).alias("n_classes"),
    )
    return out.withColumn("valid", (F.col("n") > 0) & (F.col("bad_label") == 0) & (F.col("bad_score") == 0) & (F.col("n_classes") == 2))


def scalars(rows: DataFrame, y: str, score: str, base_rate: Column) -> DataFrame:
    p, t = F.col(score), F.col(y).cast("double")
    q = F.least(F.greatest(p, F.lit(EPSILON)), F.lit(1 - EPSILON))
    out = rows.agg(
        F.count("*").alias("n"),
        F.sum(F.col(y)).alias("n_positive"),
        F.avg((p - t) * (p - t)).alias("brier"),
        F.avg((base_rate - t) * (base_rate - t)).alias("_base"),
        F.avg(-(t * F.ln(q) + (1 - t) * F.ln(1 - q))).alias("log_loss"),
        F.avg(p).alias("mean_score"),
        F.avg(t).alias("prevalence"),
        (F.sum(t) / F.sum(p)).alias("oe_ratio"),
    )
    gap = F.col("mean_score") - F.col("prevalence")
    return out.withColumn("brier_skill", 1 - F.col("brier") / F.col("_base")).withColumn("gap", gap).withColumn("abs_gap", F.abs(gap)).drop("_base")


CHUNKS = 256


def ranked(rows: DataFrame, score: str, values: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct score (within ``by``): sums of ``values``, and of each its total and its sum ``below_*`` the score.

    Scores are cut into about ``CHUNKS`` ranges of equally many distinct ones, and sums of whole ranges are added
    to those within a range, so no task orders more than a range.
    """
    g = rows.groupBy(*by, score).agg(*(c.alias(n) for n, c in values.items()))
    edges = g.agg(F.percentile_approx(score, F.array(*(F.lit(i / CHUNKS) for i in range(1, CHUNKS))), F.lit(10 * CHUNKS)).alias("_edges"))  # one row
    g = g.crossJoin(F.broadcast(edges)).withColumn("_chunk", F.size(F.filter("_edges", lambda e: e < F.col(score)))).drop("_edges")
    own = g.groupBy(*by, "_chunk").agg(*(F.sum(n).alias(n) for n in values))  # at most CHUNKS rows for each ``by``
    everything = W.partitionBy(*by)
    before = everything.orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    base = own.select(*by, "_chunk", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in values), *(F.sum(n).over(everything).alias(f"total_{n}") for n in values))
    inside = W.partitionBy(*by, "_chunk").orderBy(score).rowsBetween(W.unboundedPreceding, -1)
    g = g.withColumns({f"below_{n}": F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in values}).join(base, [*by, "_chunk"])
    return g.withColumns({f"below_{n}": F.col(f"below_{n}") + F.col(f"_{n}") for n in values}).drop("_chunk", *(f"_{n}" for n in values))


def auc(rows: DataFrame, y: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; null with one class. Rows shrink to distinct scores first."""
    g = ranked(rows, score, {"pos": F.sum(y), "neg": F.sum(1 - F.col(y))}, by)
    pairs = F.sum(F.col("pos") * (F.col("below_neg") + F.col("neg") / 2))
    all_pairs = F.sum("pos") * F.sum("neg")
    return g.groupBy(*by).agg(F.when(all_pairs > 0, pairs / all_pairs).alias("auc"))


def average_precision(rows: DataFrame, y: str, score: str) -> DataFrame:
    """Sum of recall steps times precision over distinct thresholds, from the highest score down."""
    g = ranked(rows, score, {"pos": F.sum(y), "n": F.count("*")})
    precision = (F.col("total_pos") - F.col("below_pos")) / (F.col("total_n") - F.col("below_n"))
    return g.agg((F.sum(F.col("pos") * precision) / F.sum("pos")).alias("average_precision"))


def quantile_edges(g: DataFrame, score: str, bins: int, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, edges): distinct interpolated quantiles i / bins of rows counted by score (n, below_n, total_n)."""
    out = []
    for i in range(bins + 1):
        place = (F.col("total_n") - 1) * i / bins
        at = lambda k: F.min(F.when((F.col("below_n") <= k) & (k < F.col("below_n") + F.col("n")), F.col(score)))
        low, high, part = at(F.floor(place)), at(F.ceil(place)), F.max(place - F.floor(place))
        out.append(low + (high - low) * part)
    return g.groupBy(*by).agg(F.array_distinct(F.array(*out)).alias("edges"))


def bin_of(score: Column, edges: Column) -> Column:
    """Left-closed bins, the last closed; equal edges make one bin."""
    return F.greatest(F.lit(0), F.least(F.size(F.filter(edges, lambda e: e <= score)) - 1, F.size(edges) - 2))


def calibration(rows: DataFrame, y: str, score: str, bins: int = 10) -> DataFrame:
    """(bin, n, mean_score, rate) over quantile bins, left-closed, the last closed; equal edges merge."""
    edges = quantile_edges(ranked(rows, score, {"n": F.count("*")}), score, bins)  # one row
    binned = rows.crossJoin(F.broadcast(edges)).select(F.col(y).alias("y"), F.col(score).alias("p"), bin_of(F.col(score), F.col("edges")).alias("bin"))
    return binned.groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("n_positive"), F.avg("p").alias("mean_score"), F.avg("y").alias("rate"))


def ece(curve: DataFrame) -> DataFrame:
    return curve.agg((F.sum(F.col("n") * F.abs(F.col("mean_score") - F.col("rate"))) / F.sum("n")).alias("ece"))


def wilson(curve: DataFrame, z: float = 1.959963984540054) -> DataFrame:
    """Curve with a 95 % Wilson interval of each bin's rate (0 and 1 exactly at the borders)."""
    n, r = F.col("n").cast("double"), F.col("n_positive") / F.col("n")
    centre, half = (r + z * z / (2 * n)) / (1 + z * z / n), z / (1 + z * z / n) * F.sqrt(r * (1 - r) / n + z * z / (4 * n * n))
    low = F.when(F.col("n_positive") == 0, 0.0).otherwise(centre - half)
    return curve.withColumn("low", low).withColumn("high", F.when(F.col("n_positive") == F.col("n"), 1.0).otherwise(centre + half))


def reason_lookup(train: DataFrame, rows: DataFrame, y: str, code: str, smoothing: float = 10.0) -> DataFrame:
    """``rows`` with ``lookup``: the smoothed rate of their code in ``train``; unseen codes get its prevalence."""
    key = F.coalesce(code, F.lit("MISSING"))
    base = F.broadcast(train.agg(F.avg(y).alias("_base")))
    rates = train.groupBy(key.alias("_key")).agg(F.sum(y).alias("_s"), F.count("*").alias("_n"))
    joined = rows.withColumn("_key", key).join(rates, "_key", "left").crossJoin(base)
    value = F.coalesce((F.col("_s") + smoothing * F.col("_base")) / (F.col("_n") + smoothing), F.col("_base"))
    return joined.withColumn("lookup", value).drop("_key", "_s", "_n", "_base")


def settled_rates(gold: DataFrame, cutoff: Column, least: int = 30) -> DataFrame:
    """(reason_key, n, rate) over rows settled before a date; the rate is withheld below ``least`` rows."""
    g = gold.where((F.col("index_stop") < cutoff) & (F.col("label_horizon") < cutoff)).groupBy(F.coalesce("admission_reason_code", F.lit("MISSING")).alias("reason_key"))
    return g.agg(F.count("*").alias("n"), F.avg("is_readmitted").alias("rate")).withColumn("rate", F.when(F.col("n") >= least, F.col("rate")))


#: Rows that one task of the bootstrap holds (ties of one score go to several tasks).
BLOCK_ROWS = 4_096
# fixed values: multipliers of a 32-bit mixing function
_GOLDEN, _MIX_1, _MIX_2 = 0x9E3779B9, 0x85EBCA6B, 0xC2B2AE35
#: A 32-bit number below the k-th of these has a Poisson(1) weight of at most k.
POISSON = tuple(int(2**32 * math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1))) for k in range(10))


#: Weights that one step of the bootstrap draws: they and their numbers stay in a core's cache.
DRAWN_AT_ONCE = 2**17


def _weights(x: np.ndarray) -> np.ndarray:
    """How many borders a number reaches."""
    w = np.zeros(x.shape, np.uint8)
    for border in POISSON:
        w += x >= np.uint32(border)
    return w


def entity_words(entity: Column) -> list[Column]:
    """Two 32-bit numbers of an entity's text, from its md5."""
    digest = F.md5(entity.cast("string").cast("binary"))
    return [F.conv(F.substring(digest, i, 8), 16, 10).cast("long") for i in (1, 9)]


def mixed(e1: np.ndarray, e2: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """32-bit numbers of entities (two words each) and ``numbers`` that broadcast against each other, mixed in place."""
    x = e1 + numbers * np.uint32(_GOLDEN)
    shifted = np.empty_like(x)

    def mix() -> None:
        for shift, times in ((16, _MIX_1), (13, _MIX_2), (16, None)):
            np.right_shift(x, np.uint32(shift), out=shifted)
            np.bitwise_xor(x, shifted, out=x)
            if times:
                np.multiply(x, np.uint32(times), out=x)

    mix()
    np.bitwise_xor(x, e2, out=x)
    mix()
    return x


def _drawn(e1: np.ndarray, e2: np.ndarray, resamples: np.ndarray) -> np.ndarray:
    """Weights of entities and resamples that broadcast against each other."""
    return _weights(mixed(e1, e2, resamples))


def poisson_weights(e1: np.ndarray, e2: np.ndarray, resamples: np.ndarray) -> np.ndarray:
    """Weights (entities, resamples)."""
    return _drawn(e1[:, None], e2[:, None], resamples[None, :])


def _long(rows: DataFrame, y: str, arms: list[str], entity: str) -> DataFrame:
    """(arm, p, y, e1, e2): a row of each arm."""
    e1, e2 = entity_words(F.col(entity))
    kinds = F.explode(F.array(*(F.struct(F.lit(a).alias("arm"), F.col(a).cast("double").alias("p")) for a in arms)))
    return rows.select(F.col(y).cast("double").alias("y"), e1.alias("e1"), e2.alias("e2"), kinds.alias("x")).select("x.arm", "x.p", "y", "e1", "e2")


def block_rows(rows: DataFrame, y: str, arms: list[str], entity: str) -> DataFrame:
    """(arm, p, y, e1, e2, block, tied, part): a row of each arm, dealt into blocks of neighbouring scores.

    All rows of a score are in one block of at most twice ``BLOCK_ROWS`` rows. A score with more rows than that is
    ``tied``: it comes after the others of its block, and its rows lie in several parts.
    """
    long = _long(rows, y, arms, entity)
    places = ranked(long, "p", {"n": F.count("*")}, ("arm",)).select("arm", "p", "n", F.floor(F.col("below_n") / BLOCK_ROWS).alias("block"), (F.col("n") > BLOCK_ROWS).alias("tied"))
    part = F.when(F.col("tied"), F.pmod(F.xxhash64("e1", "e2"), F.ceil(F.col("n") / BLOCK_ROWS))).otherwise(0)
    return long.join(places, ["arm", "p"]).select("arm", "p", "y", "e1", "e2", "block", "tied", part.alias("part"))


def _spread(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt by ``keys`` to twice as many tasks as there are cores, or more.

    A block is few bytes and thousands of resamples of work, so tasks of a usual number of bytes would leave cores idle.
    """
    spark = rows.sparkSession
    return rows.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def _words(frame: pd.DataFrame) -> list[np.ndarray]:
    return [frame[c].to_numpy().astype(np.uint32) for c in ("e1", "e2")]


def _sums_of_block(frame: pd.DataFrame, resamples: int) -> pd.DataFrame:
    """Each resample's sums over one block; all of them are sums over rows of one score and label, so weights are added up by these first."""
    frame = frame.sort_values(["p", "y"])
    p, y = frame["p"].to_numpy(), frame["y"].to_numpy()
    e1, e2 = _words(frame)
    starts = lambda *columns: np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)]))
    alike = starts(p, y)
    p, y = p[alike], y[alike]
    first = starts(p)  # of each distinct score
    step = max(8, DRAWN_AT_ONCE // len(e1))
    found = []
    for start in range(0, resamples, step):
        b = np.arange(start, min(start + step, resamples), dtype=np.uint32)
        w = np.add.reduceat(_drawn(e1, e2, b[:, None]), alike, axis=1, dtype=np.float64)
        pos, neg = (np.add.reduceat(w * side, first, axis=1) for side in (y, 1 - y))
        within = (pos * (np.cumsum(neg, axis=1) - neg / 2)).sum(axis=1)
        found.append(np.column_stack([b, pos.sum(axis=1), neg.sum(axis=1), within, w @ p, w @ ((p - y) ** 2)]))
    out = pd.DataFrame(np.vstack(found), columns=["b", "pos", "neg", "within", "wp", "wsq"]).astype({"b": "int64"})
    return out.assign(p=p[0], arm=frame["arm"].iloc[0], block=frame["block"].iloc[0], tied=frame["tied"].iloc[0])


def block_sums(blocks: DataFrame, resamples: int) -> DataFrame:
    """(arm, b, block, tied, p, pos, neg, within, wp, wsq): weighted sums of a block in each resample.

    ``within`` counts the pairs that the block orders by itself; ``p`` is its lowest score. An entity's weight in a
    resample is Poisson(1), the limit of drawing with replacement: it follows from a hash of the two, so no draws
    are stored or joined.
    """
    ship_package(blocks.sparkSession)

    kinds = "b long, pos double, neg double, within double, wp double, wsq double, p double, arm string, block long, tied boolean"
    keys = ("arm", "block", "tied", "part")
    g = _spread(blocks, *keys).groupBy(*keys).applyInPandas(lambda frame: _sums_of_block(frame, resamples), kinds)
    totals = [F.sum(c).alias(c) for c in ("pos", "neg", "within", "wp", "wsq")]
    return g.groupBy("arm", "b", "block", "tied").agg(F.min("p").alias("p"), *totals)


def resampled_metrics(sums: DataFrame) -> DataFrame:
    """(b, arm, auc, brier, oe, gap) from :func:`block_sums`; auc is null where one class is missing."""
    before = W.partitionBy("arm", "b").orderBy("block", "tied").rowsBetween(W.unboundedPreceding, -1)
    pairs = F.when(F.col("tied"), F.col("pos") * F.col("neg") / 2).otherwise(F.col("within")) + F.col("pos") * F.coalesce(F.col("below"), F.lit(0.0))
    n, both = F.sum(F.col("pos") + F.col("neg")), F.sum("pos") * F.sum("neg")
    return sums.withColumn("below", F.sum("neg").over(before)).groupBy("b", "arm").agg(
        F.when(both > 0, F.sum(pairs) / both).alias("auc"),
        F.try_divide(F.sum("wsq"), n).alias("brier"),
        F.try_divide(F.sum("pos"), F.sum("wp")).alias("oe"),
        F.try_divide(F.sum("wp") - F.sum("pos"), n).alias("gap"),
    )


def bootstrap(rows: DataFrame, y: str, arms: list[str], entity: str, resamples: int) -> DataFrame:
    """(b, arm, auc, brier, oe, gap): every arm on the same entity resamples (see :func:`block_sums`)."""
    return resampled_metrics(block_sums(block_rows(rows, y, arms, entity), resamples))


def _quantile_places(sums: DataFrame, bins: int) -> DataFrame:
    """Where the quantiles i / bins of each resample lie: the block, and the place among its weighted rows.

    Two rows for each arm, resample and i: the places on both sides of the quantile (``upper``). With them come what
    lies below the block: its weighted count is taken off the place, its excess of scores over labels is ``below_d``.
    """
    own = W.partitionBy("arm", "b")
    before = own.orderBy("block", "tied").rowsBetween(W.unboundedPreceding, -1)
    g = sums.select("arm", "b", "block", "tied", "p", (F.col("pos") + F.col("neg")).cast("long").alias("n"), (F.col("wp") - F.col("pos")).alias("d"))
    g = g.withColumns({f"below_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("n", "d")} | {f"total_{c}": F.sum(c).over(own) for c in ("n", "d")})
    place = lambda i: (F.col("total_n") - 1) * i / bins

    def side(rounded, upper: bool) -> Column:
        one = lambda i: F.struct(i.alias("i"), F.lit(upper).alias("upper"), rounded(place(i)).alias("k"), (place(i) - F.floor(place(i))).alias("share"))
        return F.transform(F.sequence(F.lit(0), F.lit(bins)), one)

    here = F.filter(F.concat(side(F.floor, False), side(F.ceil, True)), lambda x: (F.col("below_n") <= x["k"]) & (x["k"] < F.col("below_n") + F.col("n")))
    found = g.where("n > 0").withColumn("x", F.explode(here))
    return found.select("arm", "b", "block", "tied", "p", "d", "below_d", "total_n", "total_d", "x.i", "x.upper", "x.share", (F.col("x.k") - F.col("below_n")).alias("k"))


def resampled_ece(blocks: DataFrame, sums: DataFrame, bins: int = 10) -> DataFrame:
    """(b, arm, ece) over each resample's own quantile bins; a resample without any weight has no row.

    A bin's part is a difference of sums of (score - label) below its two edges. An edge lies in one block, or between
    two neighbours: sums of whole blocks give what is below it, and only blocks that hold an edge of some resample are
    opened again. Their number, as that of the places looked up, is bounded by arms, resamples and bins, not by rows.
    """
    ship_package(blocks.sparkSession)
    places = _quantile_places(sums, bins)
    opened = F.broadcast(places.where("not tied").select("arm", "block").distinct())

    def look_up(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        """Scores at the wanted places of a block, and the sums of its rows below (``lt``) and up to (``le``) them."""
        rows = rows.sort_values("p", kind="stable")
        p, y = rows["p"].to_numpy(), rows["y"].to_numpy()
        e1, e2 = _words(rows)
        wanted = wanted.sort_values("b", kind="stable")
        numbers, starts = np.unique(wanted["b"].to_numpy(), return_index=True)
        groups = np.split(wanted["k"].to_numpy(), starts[1:])
        found = []
        for start in range(0, len(numbers), 256):
            w = poisson_weights(e1, e2, numbers[start : start + 256].astype(np.uint32))
            reached = np.cumsum(w, axis=0, dtype=np.int64)
            excess = np.vstack([np.zeros(w.shape[1]), np.cumsum(w * (p - y)[:, None], axis=0)])
            for j, places_of_one in enumerate(groups[start : start + 256]):
                value = p[np.searchsorted(reached[:, j], places_of_one, side="right")]
                low, high = (np.searchsorted(p, value, side=s) for s in ("left", "right"))
                found.append(np.column_stack([value, excess[low, j], excess[high, j]]))
        value, lt, le = np.vstack(found).T
        names = ["arm", "b", "i", "upper", "share", "total_n", "total_d"]
        return wanted[names].assign(value=value, lt=lt + wanted["below_d"].to_numpy(), le=le + wanted["below_d"].to_numpy())

    kinds = "arm string, b long, i int, upper boolean, share double, total_n long, total_d double, value double, lt double, le double"
    rows = blocks.where("not tied").join(opened, ["arm", "block"], "left_semi")
    by = lambda f: _spread(f, "arm", "block").groupBy("arm", "block")
    inside = by(rows).cogroup(by(places.where("not tied"))).applyInPandas(lambda r, x: look_up(r, x) if len(x) else pd.DataFrame(columns=[c.split()[0] for c in kinds.split(", ")]), kinds)
    ties = places.where("tied").select("arm", "b", "i", "upper", "share", "total_n", "total_d", F.col("p").alias("value"), F.col("below_d").alias("lt"), (F.col("below_d") + F.col("d")).alias("le"))

    at = lambda c, upper: F.max(F.when(F.col("upper") == upper, F.col(c)))
    one = inside.unionByName(ties).groupBy("arm", "b", "i", "total_n", "total_d", "share").agg(at("value", False).alias("low"), at("value", True).alias("high"), at("lt", False).alias("lt"), at("le", False).alias("le"))
    one = one.withColumn("edge", F.col("low") + (F.col("high") - F.col("low")) * F.col("share"))
    one = one.withColumn("cut", F.when(F.col("edge") > F.col("low"), F.col("le")).otherwise(F.col("lt")))  # no row weighs anything between low and high
    g = one.groupBy("b", "arm", "total_n", "total_d").agg(F.min("edge").alias("first"), F.max("edge").alias("last"), F.array_sort(F.collect_list(F.struct("i", "edge", "cut"))).alias("cuts"))  # bins + 1 each
    inner = F.filter("cuts", lambda x: (x["edge"] > F.col("first")) & (x["edge"] < F.col("last")))  # equal edges make one bin
    cuts = F.concat(F.transform(inner, lambda x: x["cut"]), F.array("total_d"))
    off = F.aggregate(cuts, F.struct(F.lit(0.0).alias("at"), F.lit(0.0).alias("off")), lambda a, x: F.struct(x.alias("at"), (a["off"] + F.abs(x - a["at"])).alias("off")), lambda a: a["off"])
    return g.select("b", "arm", (off / F.col("total_n")).alias("ece"))


def bootstrap_ece(rows: DataFrame, y: str, arms: list[str], entity: str, resamples: int, bins: int = 10) -> DataFrame:
    """(b, arm, ece) over each resample's own quantile bins, for the resamples of :func:`bootstrap`."""
    blocks = block_rows(rows, y, arms, entity)
    return resampled_ece(blocks, block_sums(blocks, resamples), bins)


def interval(samples: DataFrame, value: Column, alpha: float = 0.05) -> tuple[Column, Column]:
    return F.percentile(value, F.lit(alpha / 2)), F.percentile(value, F.lit(1 - alpha / 2))


def promotion_gate(samples: DataFrame, challenger: str, champion: str, lookup: str, champion_brier: Column, margin: float = 0.05) -> DataFrame:
    """PROMOTE iff the AUC gains' lower bounds over both others are above 0 and the Brier loss is small."""
    wide = samples.groupBy("b").pivot("arm", [challenger, champion, lookup]).agg(F.first("auc").alias("auc"), F.first("brier").alias("brier"))
    gain = F.col(f"{challenger}_auc") - F.col(f"{champion}_auc")
    over = F.col(f"{challenger}_auc") - F.col(f"{lookup}_auc")
    loss = F.col(f"{challenger}_brier") - F.col(f"{champion}_brier")
    out = wide.agg(interval(wide, gain)[0].alias("auc_gain_low"), interval(wide, over)[0].alias("auc_over_lookup_low"), interval(wide, loss)[1].alias("brier_loss_high"), F.count(gain).alias("n_used"))
    ok = (F.col("auc_gain_low") > 0) & (F.col("auc_over_lookup_low") > 0) & (F.col("brier_loss_high") <= margin * champion_brier)
    return out.withColumn("decision", F.when(F.coalesce(ok, F.lit(False)), "PROMOTE").otherwise("REFUSE"))


def acceptance(samples: DataFrame, arm: str, least_auc: float, band: tuple[float, float]) -> DataFrame:
    own = samples.where(F.col("arm") == arm)
    out = own.agg(interval(own, F.col("auc"))[0].alias("auc_low"), *(c.alias(n) for c, n in zip(interval(own, F.col("oe")), ("oe_low", "oe_high"), strict=True)))
    return out.withColumn("accepted", F.coalesce((F.col("auc_low") >= least_auc) & (F.col("oe_low") <= band[1]) & (F.col("oe_high") >= band[0]), F.lit(False)))
