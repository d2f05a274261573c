"""Token-id shards with a minimal perfect hash index.

Layout of a store: ``shard-*.bin`` hold raw ids in ascending document order; ``index-*.mph`` hold the
hash index; two Parquet tables (``shards``, ``indexes``) name the files of the tasks that succeeded.

* Shard: 32-byte head (magic, bytes of an id), the ids (2 bytes each where the vocabulary
  allows it, else 4), then one 8-byte end offset per record.
* Index: keys are dealt into buckets of about 32,768 by a hash; each bucket's file is a minimal perfect
  hash: keys fall into small groups, and a group's displacement moves its keys to free slots. A slot
  holds the key's 8-byte fingerprint, its shard, its first record and its number of records. A lookup
  reads one displacement and one slot, and a wrong key is told apart by its fingerprint.

Documents are dealt by ranges of doc_id, so shards follow each other in ascending order, and a
record's start is its shard's start (a sum over the short shard list) plus its offset in the shard. Their number
grows with the text, so what a task holds of a shard (8 bytes a record) is bounded.

Edge cases: null and empty texts hold the end id alone; rows with a null doc_id come first; rows that
share a doc_id are records side by side in one shard, in order of their text; an empty table makes an
empty store; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .bpe import LibraryBpe, bpe
from .common import NewFile, commit_file, file_system, materialize, ship_package

_HEAD = struct.Struct("<8sIIQQ")
_SHARD, _INDEX = b"EPTOKEN1", b"EPINDEX1"
_SLOT = np.dtype([("print", "<u8"), ("shard", "<u4"), ("records", "<u4"), ("record", "<u8")])
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)  # fixed values: hash multipliers
_PER_GROUP = 4
_READ = 8 << 20
SHARD_BYTES = 128 << 20


def _hashes(column: str) -> list:
    """Two independent 64-bit hashes of a key."""
    return [F.xxhash64(column).alias("h"), F.xxhash64(F.lit("fingerprint"), column).alias("fp")]


def _spread(h: np.ndarray, displacement: np.ndarray, slots: int) -> np.ndarray:
    x = (h + (displacement + np.uint64(1)) * _C1) * _C2
    x ^= x >> np.uint64(31)
    return (x * _C1 >> np.uint64(11)) % np.uint64(slots)


def build_mph(h: np.ndarray, groups: int) -> np.ndarray:
    """Displacements of a minimal perfect hash over distinct 64-bit hashes; -s-1 puts a lone key in slot s."""
    n = len(h)
    group = (h >> np.uint64(7)) % np.uint64(groups)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group.astype(np.int64), minlength=groups)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    displacement, used = np.zeros(groups, np.int64), np.zeros(n, bool)
    for g in np.argsort(-sizes, kind="stable"):
        if sizes[g] < 2:
            break
        keys = h[order[begins[g] : begins[g + 1]]]
        for start in range(0, 1 << 30, 64):
            d = np.arange(start, start + 64, dtype=np.uint64)[:, None]
            at = np.sort(_spread(keys[None, :], d, n), axis=1)
            good = ~used[at].any(axis=1) & (at[:, 1:] != at[:, :-1]).all(axis=1)
            if good.any():
                first = int(np.argmax(good))
                displacement[g] = start + first
                used[at[first]] = True
                break
    lone = np.flatnonzero(sizes == 1)
    displacement[lone] = -np.flatnonzero(~used)[: len(lone)] - 1
    return displacement


def find_slots(h: np.ndarray, displacement: np.ndarray, slots: int) -> np.ndarray:
    d = displacement[((h >> np.uint64(7)) % np.uint64(len(displacement))).astype(np.int64)]
    moved = _spread(h, np.maximum(d, 0).astype(np.uint64), slots).astype(np.int64)
    return np.where(d < 0, -d - 1, moved)


def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int, width: int) -> Iterator[pa.RecordBatch]:
    """Writes one shard; yields a row per distinct document, batch by batch, and one for the shard (``path`` set)."""
    shard, coder = TaskContext.get().partitionId(), bpe(path, LibraryBpe)
    end = np.array([end_id], f"<u{width}").tobytes()
    names = ["doc_id", "shard", "record", "records", "path", "ids"]

    def rows(keys: list, records: list, counts: list, uri: str | None = None, total: int | None = None) -> pa.RecordBatch:
        n = len(keys)
        columns = [(keys, pa.int64()), ([shard] * n, pa.int32()), (records, pa.int64()), (counts, pa.int64()), ([uri] * n, pa.string()), ([total] * n, pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)

    with NewFile(f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.bin") as out:
        ends, key, begin = array("Q"), None, None  # end offsets; the last document, which the next batch may continue
        for batch in batches:
            made, done = [], ([], [], [])
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if begin is None or own != key:
                    if begin is not None:
                        for column, value in zip(done, (key, begin, len(ends) - begin), strict=True):
                            column.append(value)
                    key, begin = own, len(ends)
                ids = np.frombuffer(coder.encode(text.as_py()), "<u4")
                made += [ids.astype(f"<u{width}").tobytes(), end]
                ends.append((ends[-1] if ends else 0) + len(ids) + 1)
            if not len(ends):
                continue
            if not out.opened:
                out.write(_HEAD.pack(_SHARD, width, 0, 0, 0))
            out.write(b"".join(made))
            if done[0]:
                yield rows(*done)
        if len(ends):
            out.write(np.array(ends, "<u8").tobytes())
            out.commit()
            yield rows([key], [begin], [len(ends) - begin])
            yield rows([None], [len(ends)], [0], out.uri, ends[-1])


def _write_index(frame: pd.DataFrame, folder: str) -> pd.DataFrame:
    h = frame["h"].to_numpy().view(np.uint64)
    displacement = build_mph(h, max(1, len(h) // _PER_GROUP))
    slots = np.zeros(len(h), _SLOT)
    at = find_slots(h, displacement, len(h))
    slots["print"][at] = frame["fp"].to_numpy().view(np.uint64)
    for name in ("shard", "record", "records"):
        slots[name][at] = frame[name].to_numpy()
    bucket = int(frame["bucket"].iloc[0])
    uri = f"{folder}/index-{bucket:08d}-{uuid.uuid4().hex}.mph"

    def write(out) -> None:
        out.write(_HEAD.pack(_INDEX, len(displacement), 0, len(h), 0))
        out.write(displacement.astype("<i8").tobytes() + slots.tobytes())

    commit_file(uri, write)
    return pd.DataFrame({"bucket": [bucket], "path": [uri]})


def read_index(uri: str) -> tuple[np.ndarray, np.ndarray]:
    """(displacements, slots) of an index file."""
    fs, path = file_system(uri)
    with fs.open_input_stream(path) as f:
        data = f.read()
    magic, groups, _, n, _ = _HEAD.unpack_from(data)
    if magic != _INDEX:
        raise ValueError(f"{uri} is no index file")
    at = _HEAD.size + 8 * groups
    return np.frombuffer(data, "<i8", groups, _HEAD.size), np.frombuffer(data, _SLOT, n, at)


def _look_up(frame: pd.DataFrame) -> pd.DataFrame:
    """Locations of a bucket's keys; keys whose fingerprint differs from their slot's are left out."""
    displacement, slots = read_index(frame["path"].iloc[0])
    hit = slots[find_slots(frame["h"].to_numpy().view(np.uint64), displacement, len(slots))]
    found = hit["print"] == frame["fp"].to_numpy().view(np.uint64)
    out = pd.DataFrame({c: hit[c].astype(np.int64) for c in ("shard", "record", "records")})
    out = out.assign(doc_id=frame["doc_id"].to_numpy(), none=frame["none"].to_numpy())[found]
    return out[["doc_id", "none", "shard", "record", "records"]]


def _read_records(frames: Iterator[pd.DataFrame], wide: bool) -> Iterator[pd.DataFrame]:
    """Rows in order of path and record -> the ids of each record; one open shard, 8 MB read at a time."""
    uri = file = None
    for frame in frames:
        rows = []
        for key, none, path, n_records, base, record, records in frame.itertuples(index=False):
            if path != uri:
                if file:
                    file.close()
                fs, inner = file_system(path)
                uri, file, low, held = path, fs.open_input_file(inner), 0, b""
                magic, width, _, _, _ = _HEAD.unpack(file.read_at(_HEAD.size, 0))
                if magic != _SHARD:
                    raise ValueError(f"{path} is no shard")
                ends = np.frombuffer(file.read_at(8 * n_records, file.size() - 8 * n_records), "<u8")
            for r in range(record, record + records):
                start, stop = int(ends[r - 1]) if r else 0, int(ends[r])
                a, b = _HEAD.size + width * start, _HEAD.size + width * stop
                if a < low or b > low + len(held):
                    low, held = a, file.read_at(max(_READ, b - a), a)
                ids = held[a - low : b - low]
                rows.append((key, none, base + start, as_u4(ids, width) if wide else ids, 4 if wide else width))
        yield pd.DataFrame(rows, columns=["doc_id", "none", "start", "ids", "width"])


class TokenStore:
    """A written store: ``shards`` (shard, path, n_records, base) and ``indexes`` (bucket, path)."""

    def __init__(self, shards: DataFrame, indexes: DataFrame, buckets: int):
        self.shards, self.indexes, self.buckets = shards, indexes, buckets

    def locate(self, keys: DataFrame) -> DataFrame:
        """(doc_id, shard, record, records) of the stored ones among ``keys`` (doc_id), through the index."""
        named = keys.select("doc_id").distinct().select("doc_id", *_hashes("doc_id"))
        named = named.withColumn("bucket", F.pmod("h", F.lit(self.buckets))).join(self.indexes, "bucket")
        # pandas would turn ids beside a null into floats, so a null travels as a flag
        flagged = named.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.isnull("doc_id").alias("none"), "h", "fp", "bucket", "path")
        found = flagged.groupBy("bucket").applyInPandas(
            _look_up, "doc_id long, none boolean, shard long, record long, records long"
        )
        return found.select(F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "shard", "record", "records")

    def read(self, keys: DataFrame, *, wide: bool = False) -> DataFrame:
        """Each stored record of ``keys``: doc_id, start (ids of all records before it), ids (raw), width.

        ``wide``: ids are little-endian unsigned 32-bit integers, whatever the store's width.
        """
        at = self.locate(keys).join(self.shards, "shard")
        at = at.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.isnull("doc_id").alias("none"), "path", "n_records", "base", "record", "records")
        got = at.repartition("path").sortWithinPartitions("path", "record").mapInPandas(
            lambda frames: _read_records(frames, wide), "doc_id long, none boolean, start long, ids binary, width int"
        )
        return got.select(F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "start", "ids", "width")


def shard_count(docs: DataFrame, least: int, shard_bytes: int = SHARD_BYTES) -> int:
    """So many shards that each holds about ``shard_bytes`` of text, however large the table, and ``least`` at least."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(least, -(-total // shard_bytes))


def write_store(
    docs: DataFrame, path: str, folder: str, *, end_id: int, vocabulary: int, shards: int | None = None, bucket: int = 32_768
) -> TokenStore:
    """Encode (doc_id, text), append ``end_id`` to each document and write a store below ``folder``."""
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    shards = shards or shard_count(docs, int(spark.conf.get("spark.sql.shuffle.partitions")))
    width = 2 if vocabulary <= 1 << 16 else 4
    written = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(
            lambda b: _write_shard(b, folder, path, end_id, width),
            "doc_id long, shard int, record long, records long, path string, ids long",
        ),
        folder,
        "written",
    )
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row per shard file
    listed = materialize(
        written.where("path is not null").select(
            F.col("shard").cast("long").alias("shard"),
            "path",
            F.col("record").alias("n_records"),
            F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"),
        ),
        folder,
        "shards",
    )
    entries = written.where("path is null").select("shard", "record", "records", *_hashes("doc_id"))
    buckets = max(1, -(-entries.count() // bucket))
    indexes = materialize(
        entries.withColumn("bucket", F.pmod("h", F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandas(lambda f: _write_index(f, folder), "bucket long, path string"),
        folder,
        "indexes",
    )
    return TokenStore(listed, indexes, buckets)


def as_u4(ids: bytes, width: int) -> bytes:
    """A record's raw ids as little-endian unsigned 32-bit integers."""
    return np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
