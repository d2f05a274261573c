"""Language identification by rank-order profiles of character n-grams.

Letters are lower-cased, everything else parts words; words are padded with a blank. A profile holds a
language's ``top`` most frequent 1- to 3-grams, over all learning texts (counted in parts on each task,
summed by Spark). A document's own ``top`` n-grams are compared with each profile by the out-of-place
distance: the sum of rank differences, ``top`` for each n-gram that the profile lacks. The nearest
language wins; the score is 1 - distance / largest possible distance.

Three code points of 21 bits fit into one 64-bit integer, so n-grams are exact numbers, not hashes.

Edge cases: null texts and texts without a letter get ``und`` with score 0; ties go to the smaller
n-gram or language name; rows without a language don't teach; with nothing learned all are ``und``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import ship_package, with_fields

TOP = 300
MAX_LANGUAGES = 1_000
_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Code point -> lower-cased code point of a letter, else the border 1 (no letter has this code)."""
    if not _FOLD:
        table = np.ones(sys.maxunicode + 1, np.uint32)
        for c in range(sys.maxunicode + 1):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(table)
    return _FOLD[0]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A text's distinct 1- to 3-grams as integers, and their counts."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.concatenate([[np.uint32(1)], _fold()[codes], [np.uint32(1)]])
    blank = letters == 1
    letters = letters[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
    if len(letters) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    present, dense = np.unique(letters, return_inverse=True)
    size = len(present)
    if size > 96:
        wide = letters.astype(np.int64)
        found = [np.unique(g, return_counts=True) for g in (wide[1:-1], (wide[:-1] << 21) | wide[1:], (wide[:-2] << 42) | (wide[1:-1] << 21) | wide[2:])]
        grams, counts = (np.concatenate(x) for x in zip(*found, strict=True))
    else:
        one = np.bincount(dense, minlength=size)
        two = np.bincount(dense[:-1] * size + dense[1:], minlength=size * size)
        three = np.bincount((dense[:-2] * size + dense[1:-1]) * size + dense[2:], minlength=size**3)
        known, parts = present.astype(np.int64), []
        for counted, n in ((one, 1), (two, 2), (three, 3)):
            at = np.flatnonzero(counted)
            code, rest = np.zeros(len(at), np.int64), at
            for i in range(n):
                code |= known[rest % size] << np.int64(21 * i)
                rest = rest // size
            parts.append((code, counted[at]))
        grams, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    middle = (grams >> 21) & ((1 << 21) - 1)
    keep = (grams != 1) & ~((grams >> 42 != 0) & (middle == 1))  # a border alone, or between two words
    return grams[keep], counts[keep]


def ranked(grams: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent n-grams, most frequent first, ties by n-gram."""
    if len(grams) > top:  # only those that can be among the first
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))][:top]


def learn(docs: DataFrame, *, top: int = TOP) -> DataFrame:
    """(lang, gram, rank) from all rows of (lang, text) whose lang isn't null; rank counts from 0."""
    ship_package(docs.sparkSession)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, texts in frame.groupby("lang")["text"]:
                found = [ngram_counts(t) for t in texts]
                grams, counts = (np.concatenate(x) for x in zip(*found, strict=True))
                kinds, at = np.unique(grams, return_inverse=True)
                yield pd.DataFrame({"lang": lang, "gram": kinds, "n": np.bincount(at, counts, len(kinds)).astype(np.int64)})

    counted = docs.where("lang is not null and text is not null").select("lang", "text")
    counted = counted.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    first = counted.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < top)
    return first.select("lang", "gram", "rank")


def profile_arrays(profiles: DataFrame, max_languages: int = MAX_LANGUAGES) -> dict[str, np.ndarray]:
    """Profiles on the driver, where their size is bounded: ``max_languages`` of ``TOP`` n-grams each; more raise an error."""
    most = max_languages * TOP
    rows = profiles.orderBy("lang", "rank").limit(most + 1).toPandas()
    if len(rows) > most or rows["lang"].nunique() > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    return {lang: g["gram"].to_numpy(np.int64) for lang, g in rows.groupby("lang")}


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], *, top: int = TOP, keep: dict[str, Column] | None = None) -> DataFrame:
    """Per row of (doc_id, text): doc_id, the columns of ``keep``, lang_pred, score."""
    ship_package(docs.sparkSession)
    names = sorted(profiles)
    grams = np.unique(np.concatenate([profiles[n] for n in names])) if names else np.empty(0, np.int64)
    ranks = np.full((len(names), len(grams)), -1, np.int64)
    for i, n in enumerate(names):
        ranks[i, np.searchsorted(grams, profiles[n])] = np.arange(len(profiles[n]))

    def best(text: str | None) -> tuple[str, float]:
        own = ranked(*ngram_counts(text), top)
        if not len(own) or not names:
            return "und", 0.0
        at = np.searchsorted(grams, own)
        at[at == len(grams)] = 0
        place = np.where(grams[at] == own, ranks[:, at], -1)
        away = np.where(place < 0, top, np.abs(place - np.arange(len(own)))).sum(axis=1)
        first = int(np.argmin(away))
        return names[first], 1.0 - float(away[first]) / (top * len(own))

    kept = keep or {}
    kept_names = list(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [best(t.as_py()) for t in batch.column(1)]
            langs, scores = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", *kept_names, "lang_pred", "score"],
            )

    chosen = docs.select("doc_id", "text", *(c.alias(n) for n, c in kept.items()))
    out = with_fields(chosen.drop("text").schema, lang_pred="string", score="double")
    return chosen.mapInArrow(run, out)
