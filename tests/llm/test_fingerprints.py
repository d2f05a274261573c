"""Fingerprints against a byte-by-byte twin with a table of edit distances."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from epochal.llm import fingerprints, queries

DIGITS = fingerprints._DIGITS


def twin(data: bytes) -> str:
    """One window at a time."""
    values = []
    for i in range(len(data)):
        h = sum((data[i - k] + 1) * 0x01000193**k for k in range(min(i + 1, 7))) % 2**32
        h ^= h >> 15
        h = h * 0x2C1B3C6D % 2**32
        values.append(h ^ h >> 13)

    def chunks(size):
        out, start = [], 0
        for i, v in enumerate(values):
            if v % size == size - 1:
                out.append(data[start : i + 1])
                start = i + 1
        return out, data[start:]

    size = 3
    while len(chunks(size)[0]) >= 64:
        size *= 2
    code = lambda b: DIGITS[(zlib.crc32(b) & 0xFFF) >> 6] + DIGITS[zlib.crc32(b) & 63]
    whole = lambda s: "".join(map(code, chunks(s)[0] + [r for r in [chunks(s)[1]] if r]))
    return f"{size}:{whole(size)}:{whole(2 * size)}"


def distance(left: str, right: str) -> int:
    """Chunks to insert or remove."""
    a, b = ([s[i : i + 2] for i in range(0, len(s), 2)] for s in (left, right))
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last if x == y else 1 + min(row[j], row[j - 1])
    return row[-1]


def alike(left: str, right: str) -> float:
    if left == right:
        return 1.0
    (n, a, b), (m, c, d) = (x.split(":") for x in (left, right))
    pairs = {1.0: [(a, c)] + [(b, d)] * bool(b and d), 2.0: [(b, c)], 0.5: [(a, d)]}.get(int(m) / int(n), [])
    return max([1 - distance(x, y) * 2 / (len(x) + len(y)) if x or y else 1.0 for x, y in pairs], default=0.0)


def texts():
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefé中😀", k=rnd.randint(1, 9))) for _ in range(300)]
    out = [" ".join(rnd.choices(words, k=rnd.choice([1, 2, 5, 30, 200]))) for _ in range(60)]
    return [*out, None, "", "a", "ab", "\n", "As " * 900, "x" * 5000, out[3], out[3] + " end", "tail " + out[4]]


def by_hand(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    out = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, u = t or "", u or ""
        changed = t[: len(t) - len(t) // 3] + u[: len(t) // 3]
        a, b, c = (twin(x.encode()) for x in (t, changed, u))
        out.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), a, b, pytest.approx(alike(a, b), abs=1e-12), pytest.approx(alike(a, c), abs=1e-12)))
    return out


def check(spark, tmp_path, rows, parts):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(max(1, parts))
    frame.withColumns({c: F.lit("x") for c in ("part", "edge", "edge_text", "fingerprint", "n_chars")}).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op12_fingerprints(spark, f"file://{tmp_path}").collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3], r[4])
    want = sorted(by_hand(rows), key=key)
    assert sorted(got, key=key) == want


@pytest.mark.parametrize("copies", [1, 3])
def test_fingerprints_equal_the_twin(spark, tmp_path, copies):
    """Ids with gaps, below 0, repeated and null; null, empty, equal, repetitive and odd texts."""
    rows = [(7 * i - 100, t) for i, t in enumerate(texts())]
    rows += [(None, "no id"), (None, None), (5, "again"), (5, "again")] * (copies - 1)
    check(spark, tmp_path, rows, 4)


@pytest.mark.parametrize("rows", [[], [(1, "alone in the world")], [(1, None), (2, None)], [(1, "one"), (2, "two")]])
def test_small_tables(spark, tmp_path, rows):
    check(spark, tmp_path, rows, 1)


def test_a_long_text_is_hashed_whole():
    rnd = random.Random(9)
    text = " ".join(str(rnd.random()) for _ in range(60_000))
    own, other = fingerprints._print(text), fingerprints._print(fingerprints.edited(text, "x" * 10**6))
    assert 0.5 < fingerprints.likeness(own, other) < 1
    assert fingerprints.likeness(own, fingerprints._print(text[::-1])) < 0.2
    assert own == fingerprints._print(str(text))
