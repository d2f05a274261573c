"""Approximate nearest neighbours (cosine) through learned partitions.

1. *Fit* on a bounded sample (at most ``sample`` vectors, by a hash of vec_id): its k-nearest-neighbour
   graph is cut into balanced parts by recursive bisection and rounds of size-constrained moves to the
   part that holds most of a vector's neighbours; a softmax classifier learns the part of a vector. How
   many most probable parts a query must visit is read off sample queries held against brute force on
   the sample, so that ``aim`` of their neighbours are found.
2. *Index*: every row goes to its most probable part. A part over twice the mean size is dealt into
   shards, and a part's queries into blocks, so that no group holds more than a bounded number of rows
   or queries, however many rows are alike.
3. *Search*: each (part, shard, query block) is compared by matrix products; what comes near a query's
   k best is scored again in double precision on the original vectors, row by row, so that equal vectors
   get equal scores and ties go to the smaller vec_id. The blocks' best are merged.

The model (a matrix of parts by dimensions) and the parts' sizes are bounded by ``MAX_PARTS``.

Edge cases: vectors that are null, zero, or hold a null or non-finite component take no part, nor do
those of another length than the most common one (ties: the longer), or rows without vec_id; rows that share a vec_id
are one candidate (its best score); queries visit further parts until these hold k other rows, or all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialize, ship_package, work_dir

SAMPLE, MAX_PARTS, GRAPH, AIM = 8_192, 512, 10, 0.95
QUERY_BLOCK, SHARD = 1_024, 8_192
_SLACK = 1.15


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of each unit vector's k nearest others, in blocks."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        near = x[a : a + 1024] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        out[a : a + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A balanced partition of the graph that cuts few edges."""
    n = len(x)
    part = np.zeros(n, np.int64)
    todo = [(np.arange(n), 0, parts)]
    while todo:  # recursive bisection along the main direction
        own, first, count = todo.pop()
        if count < 2:
            part[own] = first
            continue
        y = x[own] - x[own].mean(axis=0)
        v = np.ones(x.shape[1]) / np.sqrt(x.shape[1])
        for _ in range(12):
            v = y.T @ (y @ v)
            v /= np.linalg.norm(v) or 1.0
        low = count // 2
        at = np.argsort(y @ v, kind="stable")
        cut = len(own) * low // count
        todo += [(own[at[:cut]], first, low), (own[at[cut:]], first + low, count - low)]
    limit = int(np.ceil(_SLACK * n / parts))
    both = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])
    other = np.concatenate([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])
    for _ in range(rounds):  # moves to the part of most neighbours, where there is room
        votes = np.zeros((n, parts), np.float32)
        np.add.at(votes, (both, part[other]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < limit:
                sizes[best[i]] += 1
                sizes[part[i]] -= 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


def train_router(x: np.ndarray, part: np.ndarray, parts: int, rounds: int = 150, rate: float = 0.05) -> np.ndarray:
    """Softmax regression (Adam) of a unit vector's part; the last column is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros((parts, x.shape[1]))
    for p in range(parts):  # starts at the parts' centres
        if (part == p).any():
            w[p] = 8 * x[part == p].mean(axis=0)
    w[:, -1] = 0
    m, v = np.zeros_like(w), np.zeros_like(w)
    target = np.zeros((len(x), parts))
    target[np.arange(len(x)), part] = 1
    for t in range(1, rounds + 1):
        z = x @ w.T
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (p - target).T @ x / len(x) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


@dataclass
class Router:
    """Weights (parts, dimensions + 1) and how many parts a query visits."""

    weights: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return _unit(x) @ self.weights[:, :-1].T + self.weights[:, -1]


def fit_router(x: np.ndarray, n_rows: int, k: int, aim: float = AIM) -> Router:
    """A router for ``n_rows`` vectors of which ``x`` is a sample."""
    parts = int(np.clip(round(np.sqrt(n_rows) / 2), 1, min(MAX_PARTS, max(1, len(x) // 16))))
    if parts == 1:
        return Router(np.zeros((1, x.shape[1] + 1)), 1)
    x = _unit(x)
    graph = neighbour_graph(x, GRAPH)
    router = Router(train_router(x, balanced_parts(x, graph, parts), parts), parts)
    z = router.logits(x)
    home = z.argmax(axis=1)
    asked = np.arange(0, len(x), max(1, len(x) // 1024))
    order = np.argsort(-z[asked], axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
    needed = np.take_along_axis(place, home[graph[asked, :k]], axis=1).ravel()
    router.probes = int(np.quantile(needed, aim, method="higher")) + 1
    return router


def exact_scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines of one vector and rows, each row summed alone, so equal rows get equal scores.

    Vectors are first scaled by powers of two to components under 1, which changes no bit of the cosine and lets no square overflow or vanish.
    """
    query, rows = (np.ldexp(v, -np.frexp(np.abs(v).max(axis=-1, keepdims=True))[1]) for v in (query, rows))
    return (rows * query).sum(axis=1) / (np.sqrt((query * query).sum()) * np.sqrt((rows * rows).sum(axis=1)))


def nearest(q_ids, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, id, score) of each query's k nearest other ids; rows of one id count once, by their best score."""
    out = []
    ux, uq = _unit(x), _unit(q)
    own, of = np.unique(ids, return_inverse=True)
    repeated = len(own) < len(ids)
    for a in range(0, len(q), 256):
        near = uq[a : a + 256] @ ux.T
        for i, row in enumerate(near, a):
            row[ids == q_ids[i]] = -np.inf
            best = row
            if repeated:
                best = np.full(len(own), -np.inf)
                np.maximum.at(best, of, row)
            some = min(k, len(best))
            least = np.partition(best, len(best) - some)[len(best) - some]
            at = np.flatnonzero(row >= max(least, -2.0) - 1e-9)
            score = exact_scores(q[i], x[at])
            seen = set()
            for j in np.lexsort((ids[at], -score)):
                if ids[at[j]] not in seen:
                    seen.add(ids[at[j]])
                    out.append((q_ids[i], ids[at[j]], score[j]))
                if len(seen) == k:
                    break
    return out


def valid_vectors(table: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v, dim) of rows whose id isn't null and whose vector is finite and not zero."""
    v = F.transform(F.col(vector), lambda e: e.cast("double"))
    usable = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("v", lambda e: e != 0)
    rows = table.select(F.col(id_column).cast("long").alias("id"), v.alias("v"))
    return rows.where("id is not null and v is not null").where(usable).withColumn("dim", F.size("v"))


def search(table: DataFrame, *, query: Column, k: int = 5, id_column: str = "vec_id", vector: str = "embedding",
           sample: int = SAMPLE, aim: float = AIM) -> DataFrame:
    """The k nearest found of every row where ``query`` (over ``id``) holds: query_id, rank, vec_id, score."""
    spark = table.sparkSession
    ship_package(spark)
    folder = work_dir(spark, "ann")
    result = "query_id long, rank int, vec_id long, score double"
    rows = valid_vectors(table, id_column, vector)
    dims = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if dims is None:
        return spark.createDataFrame([], result)
    rows, dim = rows.where(F.col("dim") == dims["dim"]).select("id", "v"), dims["dim"]
    bounded = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()
    router = fit_router(np.array(bounded.column("v").combine_chunks().flatten()).reshape(-1, dim), dims["count"], k, aim)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(-1, dim)
            part = router.logits(x).argmax(axis=1) if len(x) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], ["id", "v", "part"])

    indexed = materialize(rows.mapInArrow(home, "id long, v array<double>, part int"), folder, "index")
    parts = len(router.weights)
    sizes, held_ids = np.zeros(parts, np.int64), np.zeros(parts, np.int64)
    for r in indexed.groupBy("part").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids")).collect():  # at most MAX_PARTS rows
        sizes[r["part"]], held_ids[r["part"]] = r["n"], r["ids"]
    # ids that lie in several parts are counted in each: so many more must be reached to be sure of k others
    twice = int(held_ids.sum()) - indexed.select("id").distinct().count()
    shard_rows = int(np.clip(2 * -(-sizes.sum() // parts), 64, SHARD))
    shards = np.maximum(1, -(-sizes // shard_rows))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(-1, dim)
            who, where = [], []
            if len(x):
                order = np.argsort(-router.logits(x), axis=1, kind="stable")
                enough = (np.cumsum(held_ids[order], axis=1) <= k + twice).sum(axis=1) + 1
                for i, n in enumerate(np.maximum(enough, router.probes)):
                    chosen = order[i, :n][sizes[order[i, :n]] > 0]
                    who += [i] * len(chosen)
                    where += chosen.tolist()
            picked = pa.array(who, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(picked) for c in batch.columns), pa.array(where, pa.int32())], ["id", "v", "part"])

    asked = materialize(indexed.where(query).select("id", "v").mapInArrow(visits, "id long, v array<double>, part int"), folder, "queries")
    load = np.zeros(parts, np.int64)
    for r in asked.groupBy("part").count().collect():  # at most MAX_PARTS rows
        load[r["part"]] = r["count"]
    blocks = np.maximum(1, -(-load // QUERY_BLOCK))

    def dealt(column: str, counts: np.ndarray) -> Column:
        n = F.array(*(F.lit(int(c)) for c in counts))[F.col("part")]
        return F.pmod(F.xxhash64("id"), n).cast("int").alias(column)

    def copies(column: str, counts: np.ndarray) -> Column:
        n = F.array(*(F.lit(int(c)) for c in counts))[F.col("part")]
        return F.explode(F.sequence(F.lit(0), n - 1)).alias(column)

    held = indexed.select("id", "v", "part", dealt("shard", shards), copies("block", blocks), F.lit(False).alias("asks"))
    ask = asked.select("id", "v", "part", copies("shard", shards), dealt("block", blocks), F.lit(True).alias("asks"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        q, r = frame[frame["asks"]], frame[~frame["asks"]]
        found = []
        if len(q) and len(r):
            found = nearest(q["id"].to_numpy(), np.stack(q["v"].to_numpy()), r["id"].to_numpy(), np.stack(r["v"].to_numpy()), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    near = held.unionByName(ask).groupBy("part", "shard", "block").applyInPandas(compare, "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
