"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over a text's bytes ends a chunk wherever its value is -1 modulo the block size, so a change moves
no border but those near it. A chunk's signature is two characters of its checksum. The block size is the smallest
3 * 2**k that gives at most ``CHUNKS`` chunks, so no chunk is ever left out; a second signature is made with the
doubled size, so fingerprints whose sizes differ by one step can still be compared.

A fingerprint is ``size:signature:signature of the doubled size``. Likeness is 1 less the edit distance (insertions and
removals of chunks) over the number of chunks of both, at the size that the two have in common; where they share
both sizes the larger likeness counts; without a common size it is 0. Equal fingerprints have likeness 1.

Edge cases: null texts are empty; an empty text has no chunks; rows of equal doc_id are ordered by text, rows
without one come last; equal rows are rows of their own; a text of any length is hashed as a whole, two at a time; a
table of one row has itself as its next; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialize, ship_package, work_dir

#: Chunks of a fingerprint; bytes of the rolling window; the smallest block size.
CHUNKS, WINDOW, SMALLEST = 64, 7, 3
_M = 0x01000193  # an odd multiplier of the rolling hash
_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_PAIRS = [a + b for a in _DIGITS for b in _DIGITS]


def rolling(data: bytes) -> np.ndarray:
    """The rolling hash after each byte: a polynomial of the last ``WINDOW`` bytes, mixed, as unsigned 32-bit numbers."""
    h = np.frombuffer(data, np.uint8).astype(np.uint32) + np.uint32(1)

    def add(low: np.ndarray, high: np.ndarray, by: int) -> np.ndarray:
        """``low`` of the newest ``by`` bytes and ``high`` of those before them."""
        out = low.copy()
        out[by:] += high[: len(low) - by] * np.uint32(pow(_M, by, 1 << 32))
        return out

    two = add(h, h, 1)
    out = add(add(h, two, 1), add(two, two, 2), 3)  # 3 bytes, then the 4 before them
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    out ^= out >> np.uint32(13)
    return out


def _signature(data: bytes, ends: np.ndarray) -> str:
    """Two characters for each chunk; ``ends`` are the places of the last bytes of all chunks but the rest."""
    cuts = [0, *(ends + 1).tolist()]
    if cuts[-1] < len(data):
        cuts.append(len(data))
    return "".join([_PAIRS[zlib.crc32(data[a:b]) & 0xFFF] for a, b in zip(cuts[:-1], cuts[1:], strict=True)])


def fingerprint(data: bytes) -> str:
    if not data:
        return f"{SMALLEST}::"
    value = rolling(data).astype(np.uint64) + np.uint64(1)
    at = np.flatnonzero(value % np.uint64(SMALLEST) == 0)
    triple = value[at] // np.uint64(SMALLEST)
    low = triple & (~triple + np.uint64(1))  # the lowest bit: the largest power of two that divides it
    size = np.uint64(1)
    while int((low >= size).sum()) >= CHUNKS:
        size *= np.uint64(2)
    one, two = at[low >= size], at[low >= size * np.uint64(2)]
    return f"{SMALLEST * int(size)}:{_signature(data, one)}:{_signature(data, two)}"


def _shared(left: str, right: str) -> int:
    """Length of the longest common subsequence of two signatures' chunks, bit by bit in one integer."""
    places: dict[str, int] = {}
    for i in range(0, len(left), 2):
        places[left[i : i + 2]] = places.get(left[i : i + 2], 0) | 1 << i // 2
    full = row = (1 << len(left) // 2) - 1
    for i in range(0, len(right), 2):
        hit = row & places.get(right[i : i + 2], 0)
        row = (row + hit | row - hit) & full
    return len(left) // 2 - row.bit_count()


def _alike(left: str, right: str) -> float:
    n = (len(left) + len(right)) // 2
    return 2 * _shared(left, right) / n if n else 1.0


def likeness(left: str, right: str) -> float:
    """0 to 1, from two fingerprints alone."""
    if left == right:
        return 1.0
    a, b = left.split(":"), right.split(":")
    n, m = int(a[0]), int(b[0])
    if n == m:
        return max(_alike(a[1], b[1]), _alike(a[2], b[2]) if a[2] and b[2] else 0.0)
    if 2 * n == m:
        return _alike(a[2], b[1])
    return _alike(a[1], b[2]) if n == 2 * m else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the head of ``following``."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def _fields(text: str, own: str, following: str, next_print: str) -> tuple:
    changed = edited(text, following).encode()
    other = fingerprint(changed)
    return len(text), hashlib.sha256(changed).hexdigest(), own, other, likeness(own, other), likeness(own, next_print)


_RESULT = pa.schema([
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_DDL = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _print(text: str) -> str:
    return fingerprint(text.encode())


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text) in order to results; a partition's first and last row also go out with their texts, as its edges."""
    kind, before, part = None, None, TaskContext.get().partitionId()

    def made(ids: list, rows: list[tuple], edges: list, texts: list) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RESULT, strict=True)] if rows else [pa.array([], f.type) for f in _RESULT]
        marks = [pa.array([part] * len(rows), pa.int32()), pa.array(edges, pa.string()), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), *columns, *marks], ["doc_id", *_RESULT.names, "part", "edge", "edge_text"])

    blank = (None,) * len(_RESULT)
    for batch in batches:
        kind = batch.schema.field(0).type
        ids, rows, edges, texts = [], [], [], []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = t.as_py() or ""
            own = _print(text)
            if before is None:
                ids, rows, edges, texts = [i], [blank], ["first"], [text]
            else:
                ids.append(before[0])
                rows.append(_fields(before[1], before[2], text, own))
                edges.append(None)
                texts.append(None)
            before = (i, text, own)
        yield made(ids, rows, edges, texts)
    if before is not None:
        yield made([before[0]], [blank], ["last"], [before[1]])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, following) to results."""
    for batch in batches:
        rows = [_fields(t, _print(t), f, _print(f)) for t, f in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RESULT, strict=True)] if rows else [pa.array([], f.type) for f in _RESULT]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *_RESULT.names])


def compare_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row of (doc_id, text).

    Rows are dealt by ranges of descending doc_id, so a row's next one mostly follows in its own task, which keeps two
    texts at a time. Only each task's last row has its next one in the following task that has rows (the last
    task's in the first); these few are joined by the number of the task.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = [F.desc_nulls_last("doc_id")]
    dealt = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order, "text")
    made = dealt.mapInArrow(_in_order, f"doc_id {kind}, {_DDL}, part int, edge string, edge_text string")
    made = materialize(made, work_dir(spark, "fingerprints"), "rows")
    whole = made.where("edge is null").drop("part", "edge", "edge_text")
    heads = made.where("edge = 'first'").select("part", F.col("edge_text").alias("following"))
    parts = made.where("edge = 'first'").select("part")  # a number for each task that has rows
    following = parts.select("part", F.coalesce(F.lead("part").over(W.orderBy("part")), F.min("part").over(W.orderBy("part"))).alias("next_part"))
    ends = made.where("edge = 'last'").select("part", "doc_id", F.col("edge_text").alias("text")).join(following, "part")
    ends = ends.join(heads.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "text", "following")
    return whole.unionByName(ends.mapInArrow(_ends, f"doc_id {kind}, {_DDL}"))
