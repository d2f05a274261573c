"""Toxicity: a counterfactual-regularised classifier.

A sparse logistic model over the distinct words of a text, with classes weighted equally and an L1
penalty. Where a labelled text names an identity group, each such term is swapped for the others of its
group; the squared change of the model's logit is penalised, so that neutral mentions of a group don't
raise the score. Spark counts words by class over a sample of labelled rows (``per_class`` of each label: the
smallest hashes of doc_id) and picks ``features`` of them; the model is fitted on the driver from these rows, of
which only their places among the picked words get there. Its few weights score all documents.

Edge cases: labels of a doc_id that several rows share teach each of these texts, of which the fit takes the
first ``4 * per_class`` by a hash of their words; null and empty texts get the model's base score; labels other than 0 and 1 don't teach; a
label whose document is missing teaches nothing; several labels of one document all count; with one
class only, every score is that class's share (0 or 1), and 0.5 with no label at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship_package, unused, with_fields, work_dir

# fixed values: terms that may stand for each other in a neutral sentence
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"), ("she", "he"),
    ("gay", "lesbian", "straight", "bisexual"), ("transgender", "cisgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("african", "american", "european", "mexican", "chinese", "indian"),
    ("deaf", "blind", "disabled"), ("old", "young"), ("immigrants", "natives"),
)
PER_CLASS, FEATURES, MIN_TEXTS, L1, SWAP, ROUNDS = 5_000, 1_000, 4, 0.0001, 1.0, 400
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’…–—¿¡"
_WORD = re.compile(r"\w+")


def words(text: str | None) -> set[str]:
    """Distinct lower-cased words (runs of letters, digits and ``_``)."""
    out: set[str] = set()
    for piece in set(text.lower().split()) if text else ():
        w = piece.strip(_EDGE)
        if w.isalnum():
            out.add(w)
        elif w:
            out.update(_WORD.findall(w))
    return out


def _numbers(found) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def swaps(found: set[str], groups) -> list[tuple[str, str]]:
    """(term, replacement) for every identity term in a text."""
    return [(t, o) for group in groups for t in group if t in found for o in group if o != t and o not in found]


@dataclass
class Model:
    """Weights of word numbers, and the logit of a text without any of them."""

    base: float
    weights: dict[int, float]

    def score(self, text: str | None) -> float:
        get = self.weights.get
        z = self.base + sum(filter(None, map(get, map(xxhash.xxh3_64_intdigest, words(text)))))
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def _labelled(docs: DataFrame, labels: DataFrame, per_class: int, groups) -> DataFrame:
    """(toxic, numbers, swaps, place) of the labelled sample; ``place`` orders rows by their content alone."""
    labels = labels.where("toxic in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    near = F.xxhash64("doc_id")
    chosen = [labels.where(F.col("toxic") == c).orderBy(near, "doc_id").limit(per_class) for c in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])  # at most 2 * per_class rows of 12 bytes, hence broadcast

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [words(t.as_py()) for t in batch.column(1)]
            swapped = [_numbers([w for pair in swaps(s, groups) for w in pair]).tobytes() for s in sets]
            numbers = [np.sort(_numbers(s)) for s in sets]
            place = [xxhash.xxh3_64_intdigest(n.tobytes()) >> 1 for n in numbers]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n.view(np.int64) for n in numbers], pa.list_(pa.int64())), pa.array(swapped, pa.binary()), pa.array(place, pa.int64())],
                ["toxic", "numbers", "swaps", "place"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text")
    return rows.mapInArrow(features, "toxic int, numbers array<long>, swaps binary, place long")


def select_words(rows: DataFrame, features: int, min_texts: int) -> tuple[np.ndarray, dict[int, int]]:
    """Numbers of the words that part the classes most (two-proportion z-score), and texts by class; counted by Spark."""
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return np.empty(0, np.uint64), sizes
    counts = rows.select("toxic", F.explode("numbers").alias("word")).groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    p = F.col("n") / F.lit(pos + neg)
    spread = F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * F.lit(1 / pos + 1 / neg))
    z = F.abs(F.col("t") / F.lit(pos) - (F.col("n") - F.col("t")) / F.lit(neg)) / spread
    top = counts.where(F.col("n") >= min_texts).orderBy(z.desc(), "word").limit(features).select("word")
    return np.array([r["word"] for r in top.collect()], np.int64).view(np.uint64), sizes  # at most ``features`` rows


def _sample(rows: DataFrame, chosen: np.ndarray, most: int) -> tuple[list, np.ndarray]:
    """(words' places in ``chosen``, swaps) and labels of at most ``most`` rows, in order of content: a short row each."""

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.flatnonzero(np.isin(chosen, n.values.to_numpy(zero_copy_only=False).view(np.uint64))).astype(np.int16) for n in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o.tobytes() for o in own], pa.binary()), batch.column(2), batch.column(3)], ["toxic", "own", "swaps", "place"]
            )

    got = rows.mapInArrow(narrow, "toxic int, own binary, swaps binary, place long").orderBy("place", "toxic", "own").limit(most).toArrow()
    column = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for c in got.column(name).chunks for x in c]
    return list(zip(column("own", np.int16), column("swaps", np.uint64), strict=True)), got.column("toxic").to_numpy()


def fit(rows: list, y: np.ndarray, chosen: np.ndarray, *, l1: float, swap: float, rounds: int) -> Model:
    """Accelerated proximal gradient on the weighted log loss, the swap penalty and an L1 penalty.

    ``rows`` hold each text's places in ``chosen`` (sorted word numbers) and the numbers of its swapped terms.
    """
    if len(y) == 0 or y.min() == y.max():
        share = 0.5 if len(y) == 0 else float(y[0])
        return Model(float(np.clip(60 * (share - 0.5), -30, 30)), {})
    y = y.astype(float)
    pos, neg = y.sum(), len(y) - y.sum()
    row, to = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows]), np.concatenate([r[0] for r in rows]).astype(np.int64)
    pairs = np.concatenate([r[1] for r in rows]).reshape(-1, 2)
    gone, come = (np.searchsorted(chosen, pairs[:, i]) for i in (0, 1))
    weight = np.where(y == 1, 0.5 / pos, 0.5 / neg)

    def slope(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        logit = b + np.bincount(row, w[to], len(y))
        r = weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y)
        g = np.bincount(to, r[row], len(chosen))
        if len(pairs):
            change = 2 * swap / len(pairs) * (w[gone] - w[come])
            g += np.bincount(gone, change, len(chosen)) - np.bincount(come, change, len(chosen))
        return g, float(r.sum())

    # a bound on the curvature by power iteration
    v, vb = np.ones(len(chosen)) / np.sqrt(len(chosen)), 1.0
    for _ in range(25):
        image = weight * (vb + np.bincount(row, v[to], len(y)))
        v, vb = np.bincount(to, image[row], len(chosen)), float(image.sum())
        norm = np.sqrt(v @ v + vb * vb)
        v, vb = v / norm, vb / norm
    step = 1 / (0.3 * norm + (8 * swap if len(pairs) else 0))
    w = wy = np.zeros(len(chosen))
    b = by = 0.0
    t = 1.0
    for _ in range(rounds):
        g, gb = slope(wy, by)
        new = wy - step * g
        new, nb = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0), by - step * gb
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        wy, by = new + (t - 1) / t2 * (new - w), nb + (t - 1) / t2 * (nb - b)
        w, b, t = new, nb, t2
    return Model(float(b), {int(k): float(x) for k, x in zip(chosen, w, strict=True) if x})


def learn(docs: DataFrame, labels: DataFrame, *, groups=IDENTITY, per_class: int = PER_CLASS, features: int = FEATURES,
          min_texts: int = MIN_TEXTS, l1: float = L1, swap: float = SWAP, rounds: int = ROUNDS) -> Model:
    """A model from (doc_id, text) and (doc_id, toxic)."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = materialize(_labelled(docs, labels, per_class, groups), work_dir(spark, "toxicity"), "labelled")
    top, sizes = select_words(rows, features, min_texts)
    named = np.array([xxhash.xxh3_64_intdigest(t) for g in groups for t in g], np.uint64)
    chosen = np.unique(np.concatenate([top, named]))
    if len(sizes) < 2:  # nothing to tell apart
        return fit([], np.array(list(sizes)), chosen, l1=l1, swap=swap, rounds=rounds)
    return fit(*_sample(rows, chosen, 4 * per_class), chosen, l1=l1, swap=swap, rounds=rounds)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with one more column at the end: toxicity (double), ``_`` appended if the name is taken."""
    ship_package(docs.sparkSession)
    name = unused("toxicity", docs.columns)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(t.as_py()) for t in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, name])

    return docs.mapInArrow(run, with_fields(docs.schema, **{name: "double"}))


def is_toxic(column: Column, threshold: float = 0.7) -> Column:
    return column >= threshold
