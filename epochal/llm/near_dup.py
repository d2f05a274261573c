"""MinHash near-duplicate detection with bottom-k sketches from one hash function.

Steps, each a Spark job over all documents:

1. *Sketch*: a document's word shingles become a set of 64-bit hashes; the ``k`` smallest are its
   bottom-k sketch. Documents with equal sets form one class, and only the class goes on.
2. *Inverted lists* of retained values. A pair over the threshold shares at least ``min_shared`` values
   of its sketches, so it also shares one of each side's ``size - min_shared + 1`` globally rarest values;
   only those are listed. A passage that thousands of otherwise different documents share is common,
   hence never listed. Sets of up to ``k`` shingles are kept whole, so their bound is exact; as the smaller set of a
   pair shares more of itself, its value is even among fewer of its rarest ones (``leads``), and lists that no
   set leads are left out.
3. *Links* come from the lists without spelling out all pairs of a list: members meet the list's hub
   first; members of the hub that are still apart from its largest component are compared with all its
   other members, in blocks. Every pair that could join two components is compared; pairs within one
   component need no further check.
4. *Union-sketch estimate*: the overlap within the bottom-k of the union must reach ``min_shared``; pairs
   of blocks go through the same estimate as those of the hub.
5. *Exact Jaccard* on full sets confirms each link; components follow by hooking labels onto smaller ones.

Chance enters only in steps 2 and 4: for a pair exactly at 0.8, the overlap of 64 sampled values falls
below 32 with a probability under 2e-7, and less for more similar pairs.

Edge cases: null or word-less texts have an empty set and are linked with nothing; rows that share an id share
its component, so texts under one id are joined whatever they hold; rows with a null id have the component of
their text's copies (null if no row with an id is among them), and are kept only if that is null; ties go to the
smallest id; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialize, work_dir

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # fixed values: 64-bit finaliser
_S33 = np.uint64(33)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles (A-Z lower-cased, split at ASCII blanks).

    A text with fewer words is one shingle; one without words has none.
    """
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return np.empty(0, np.int64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, parts)), np.uint64)
    n = min(words, len(h))
    acc = h[: len(h) - n + 1] + np.uint64(n)
    for i in range(1, n):
        acc = _mix(acc) + h[i : len(h) - n + 1 + i]
    return np.unique(_mix(acc).view(np.int64))


def _sketches(batches: Iterator[pa.RecordBatch], words: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, flat, offsets = [], [], [], [0]
        for text in batch.column(1):
            s = shingle_hashes(text.as_py(), words)
            counts.append(len(s))
            digests.append(_digest(s))
            flat.append(s[:k].copy())  # a view would keep the whole set
            offsets.append(offsets[-1] + min(k, len(s)))
        values = np.concatenate(flat) if flat else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64())),
            ],
            ["doc_id", "n_shingles", "digest", "sketch"],
        )


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_hashes(text.as_py(), words) for text in batch.column(0)]
        columns = [pa.array(list(map(_digest, sets)), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["digest", "items"])


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose exact Jaccard similarity is at least ``percent`` / 100."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            a, b = (np.frombuffer(v.as_buffer(), np.int64) for v in (x, y))
            if len(a) > len(b):
                a, b = b, a
            at = np.searchsorted(b, a)
            shared = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a)) if len(b) else 0
            keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])


def connected_components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, label): the smallest node reachable, for each node of ``edges`` (a, b).

    Labels start as the nodes themselves. In each round, labels at the two ends of an edge that differ make the
    larger one hook onto the smallest such label, and labels are then replaced by their own label's label, so
    chains of any length take a logarithmic number of rounds. Minima are aggregated in parts; joins are between
    written tables, so that Spark splits the edges of a hub and the nodes of a large component.
    """
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), folder, f"{name}-edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels, step = materialize(nodes.select("node", F.col("node").alias("label")), folder, f"{name}-start"), 0
    while True:
        at = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"l{end}"))  # noqa: E731, B023
        ends = edges.join(at("a"), "a").join(at("b"), "b").where("la <> lb")
        hooks = ends.groupBy(F.greatest("la", "lb").alias("label")).agg(F.min(F.least("la", "lb")).alias("to"))
        hooks = materialize(hooks, folder, f"{name}-hooks-{step}")
        if hooks.isEmpty():
            return labels
        moved = labels.join(hooks, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        moved = materialize(moved, folder, f"{name}-moved-{step}")
        own = moved.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = materialize(moved.join(own, "label").select("node", F.col("next").alias("label")), folder, f"{name}-{step}")
        step += 1


def near_duplicates(
    docs: DataFrame, *, words: int = 5, percent: int = 80, k: int = 64, min_shared: int = 32, id_column: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable), kept."""
    spark = docs.sparkSession
    folder = work_dir(spark, "near-dup")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text"))
    sketched = materialize(
        texts.mapInArrow(
            lambda b: _sketches(b, words, k),
            "doc_id long, n_shingles long, digest binary, sketch array<long>",
        ),
        folder,
        "sketches",
    )
    # a class is numbered once and written; its number stands for it from here on
    classes = materialize(
        sketched.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()),
        folder,
        "classes",
    )
    lists = materialize(_inverted_lists(classes, percent, k, min_shared), folder, "lists")

    # full sets of every class that shares a list with another one, from one row of it
    wanted = lists.select("node").distinct().join(classes, "node").select("node", "digest", "doc_id")
    ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
    sets = materialize(
        texts.join(ids, texts.doc_id.eqNullSafe(ids.wanted_id), "left_semi")
        .select("text")
        .mapInArrow(lambda b: _sets(b, words), "digest binary, items binary")
        .groupBy("digest")
        .agg(F.first("items").alias("items"))
        .join(wanted.select("node", "digest"), "digest")
        .select("node", "items"),
        folder,
        "sets",
    )
    sketch_of = classes.select("node", "n", F.col("sketch").alias("s"))

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
        right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
        return materialize(both.mapInArrow(lambda b: _confirm(b, percent), "a long, b long"), folder, name)

    def ordered(one: str, other: str) -> DataFrame:
        return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]

    def estimated(pairs: DataFrame) -> DataFrame:
        left = sketch_of.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("s").alias("s_a"))
        right = sketch_of.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("s").alias("s_b"))
        return pairs.join(left, "a").join(right, "b").where(_may_link(percent, k, min_shared)).select("a", "b")

    # first every member against the hub of each of its lists: the one with the most common values
    hub = lists.groupBy("value").agg(F.max(F.struct("weight", -F.col("node"))).alias("h"), F.count("*").alias("members"), F.bool_or("leads").alias("led"))
    hub = hub.where("members > 1 and led").select("value", (-F.col("h.col2")).alias("hub"))
    members = materialize(lists.join(hub, "value").where("node <> hub").select("hub", "node").distinct(), folder, "members")
    links = confirmed(estimated(members.select(*ordered("node", "hub")).distinct()), "links-1")
    # classes under one id belong together; few ids have several
    odd = materialize(
        sketched.where("doc_id is not null").groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"), F.bool_or(F.isnull("digest")).alias("empty"))
        .where("lo <> hi or (lo is not null and empty)").select("doc_id", "lo", "empty"),
        folder, "odd",
    )
    named = classes.select(F.col("digest"), F.col("node"))
    same = sketched.join(odd, "doc_id").where("digest <> lo").select("digest", "lo").distinct()
    same = same.join(named.select("digest", F.col("node").alias("b")), "digest").join(named.select(F.col("digest").alias("lo"), F.col("node").alias("a")), "lo")
    links = links.unionByName(materialize(same.select("a", "b"), folder, "same-id"))
    labels = connected_components(links, folder, "labels-1")

    # then, among the members of one hub, whatever is still apart from the main component
    more = materialize(_block_links(members, labels, sets, folder, percent, k, min_shared), folder, "links-2")
    if not more.isEmpty():  # links between components: their labels are joined in turn
        at = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"l{end}"))
        between = more.join(at("a"), "a", "left").join(at("b"), "b", "left")
        between = between.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
        joined = connected_components(between, folder, "labels-2").withColumnRenamed("label", "top")
        known = labels.select("node", "label").unionByName(joined.select("node", F.col("node").alias("label"))).distinct()
        labels = known.join(joined.withColumnRenamed("node", "label"), "label", "left").select("node", F.coalesce("top", "label").alias("label"))

    grouped = classes.join(labels, "node", "left").select("digest", "doc_id", F.coalesce("label", "node").alias("label"))
    grouped = materialize(grouped, folder, "grouped")
    smallest = materialize(grouped.groupBy("label").agg(F.min("doc_id").alias("component_id")), folder, "smallest")
    reach = grouped.join(smallest, "label").select("digest", "component_id")
    rows = sketched.select("doc_id", "n_shingles", "digest")
    # rows without words that share their id with rows that have some
    blank = rows.where("digest is null").join(odd.where("empty").select("doc_id", "lo"), "doc_id", "left")
    rows = rows.where("digest is not null").unionByName(blank.select("doc_id", "n_shingles", F.col("lo").alias("digest")))
    out = rows.join(reach, "digest", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def _inverted_lists(classes: DataFrame, percent: int, k: int, min_shared: int) -> DataFrame:
    """(value, node, weight, leads): the rare retained values of each document that others retain too."""
    postings = classes.select("node", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    common = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    node = W.partitionBy("node")
    # whole sets that can't be similar to a set of more than k shingles have an exact bound
    whole = F.ceil(F.col("size") * percent / 100).cast("int")
    exact = F.col("size") * 100 <= k * percent
    need = F.when(exact, whole).otherwise(F.least(F.lit(min_shared), whole))
    # what it shares at least with a set that is no smaller: of 2 * size items in both, percent / (100 + percent)
    more = F.when(exact, F.ceil(F.col("size") * 2 * percent / (100 + percent)).cast("int")).otherwise(need)
    return (
        postings.join(common, "value")
        .withColumn("alone", F.col("size") - F.count("*").over(node))
        .withColumn("place", F.row_number().over(node.orderBy("df", "value")) + F.col("alone"))
        .withColumn("weight", F.sum("df").over(node))
        .where(F.col("place") <= F.col("size") - need + 1)
        .select("value", "node", "weight", (F.col("place") <= F.col("size") - more + 1).alias("leads"))
    )


def _may_link(percent: int, k: int, min_shared: int):
    """Size bound and union-sketch estimate for columns n_a, n_b, s_a, s_b."""
    shared = F.array_intersect("s_a", "s_b")
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, k)
    within = F.size(F.array_intersect(union, shared))
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    enough = F.when(
        F.greatest("n_a", "n_b") <= k, F.size(shared) * 100 >= (F.col("n_a") + F.col("n_b") - F.size(shared)) * percent
    ).otherwise((F.size(shared) >= min_shared) & (within >= min_shared))
    return sizes & enough


def _blocks(rows: DataFrame, block: int = 4 << 20, most: int = 2048) -> DataFrame:
    """(hub, n_main, n_rest): numbers of blocks, bounded by bytes of sets and, as a pair of blocks makes a matrix, by rows."""

    def number(side):
        by_bytes = F.ceil((F.sum(F.when(side, F.col("bytes"))) + 1) / block)
        return F.greatest(by_bytes, F.ceil(F.count_if(side) / most)).cast("int")

    return rows.groupBy("hub").agg(number(F.col("main")).alias("n_main"), number(~F.col("main")).alias("n_rest"))


def _block_links(members: DataFrame, labels: DataFrame, sets: DataFrame, folder: str, percent: int, k: int, min_shared: int) -> DataFrame:
    """Links between components among the members of a hub (all were compared with the hub itself).

    Members outside the hub's largest component are compared with all others, by sketches and then exactly, in blocks
    of limited bytes and rows (see ``_blocks``): a block pair is a group of its own, so a hub's members never meet in
    one task, and only links come out.
    """
    own = members.join(labels, "node", "left").select("hub", "node", F.coalesce("label", "node").alias("comp"))
    own = materialize(own, folder, "hub-rows")
    parts = own.groupBy("hub", "comp").agg(F.count("*").alias("c"))
    main = parts.groupBy("hub").agg(F.count("*").alias("parts"), F.max(F.struct("c", "comp")).alias("m"))
    main = materialize(main.where("parts > 1").select("hub", F.col("m.comp").alias("main_comp")), folder, "hub-main")
    sizes = sets.select("node", F.octet_length("items").cast("long").alias("bytes"))
    rows = own.join(main, "hub").join(sizes, "node").select("hub", "node", "comp", "bytes", (F.col("comp") == F.col("main_comp")).alias("main"))
    rows = materialize(rows, folder, "hub-open")
    # per-hub numbers are written tables, so that Spark splits the rows of a large hub in these joins
    rows = rows.join(materialize(_blocks(rows), folder, "hub-blocks"), "hub").join(sets, "node")
    at = F.pmod(F.xxhash64("node"), F.when(F.col("main"), F.col("n_main")).otherwise(F.col("n_rest"))).cast("int")
    rows = rows.withColumn("at", at)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = ["hub", "node", "comp", "items"]
    of_main = rows.where("main").select(*kept, F.lit(True).alias("left"), F.lit(0).alias("kind"), F.col("at").alias("i"), every("n_rest").alias("j"))
    of_rest = rows.where("not main").select(*kept, F.lit(False).alias("left"), F.lit(0).alias("kind"), every("n_main").alias("i"), F.col("at").alias("j"))
    rest = rows.where("not main").select(*kept, "at", every("n_rest").alias("other"))
    in_rest = rest.select(*kept, (F.col("at") <= F.col("other")).alias("left"), F.lit(1).alias("kind"), F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        same = frame["kind"].iloc[0] == 1 and frame["i"].iloc[0] == frame["j"].iloc[0]
        x = frame if same else frame[frame["left"]]
        y = frame if same else frame[~frame["left"]]
        found = _links_between(x, y, percent, k, min_shared) if len(x) and len(y) else []
        return pd.DataFrame(found, columns=["a", "b"])

    return of_main.unionByName(of_rest).unionByName(in_rest).groupBy("hub", "kind", "i", "j").applyInPandas(compare, "a long, b long")


def overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of two lists of sets: frequent values by a matrix product, rare ones one by one."""
    common = np.intersect1d(np.unique(np.concatenate(x)), np.unique(np.concatenate(y)), assume_unique=True)
    out = np.zeros(len(x) * len(y), np.int64)
    if not len(common):
        return out.reshape(len(x), len(y))

    def entries(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), list(map(len, sets)))
        at = np.searchsorted(common, values)
        at[at == len(common)] = 0
        hit = common[at] == values
        order = np.argsort(at[hit], kind="stable")
        return at[hit][order], row[hit][order], np.bincount(at[hit], minlength=len(common))

    (vx, rx, fx), (vy, ry, fy) = entries(x), entries(y)
    heavy = np.flatnonzero(fx * fy >= 4096)
    for start in range(0, len(heavy), 2048):
        chosen = np.full(len(common), -1)
        chosen[heavy[start : start + 2048]] = np.arange(len(heavy[start : start + 2048]))
        sides = []
        for v, r, n in ((vx, rx, len(x)), (vy, ry, len(y))):
            one = np.zeros((n, 2048), np.float32)
            keep = chosen[v] >= 0
            one[r[keep], chosen[v[keep]]] = 1
            sides.append(one)
        out += (sides[0] @ sides[1].T).astype(np.int64).ravel()
    light = (fx * fy < 4096)[vx]
    vx, rx = vx[light], rx[light]
    begin, times = np.concatenate([[0], np.cumsum(fy)])[vx], fy[vx]
    step = 1 << 13  # a few MB of indices at a time
    for start in range(0, len(vx), step):
        b, t = begin[start : start + step], times[start : start + step]
        inner = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t) + np.repeat(b, t)
        out += np.bincount(np.repeat(rx[start : start + step], t) * len(y) + ry[inner], minlength=len(out))
    return out.reshape(len(x), len(y))


def candidates(x: list[np.ndarray], y: list[np.ndarray], percent: int, k: int, min_shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of sorted sets that the sizes and the union-sketch estimate let pass."""
    n_x, n_y = (np.array(list(map(len, s))) for s in (x, y))
    low, high = np.minimum(n_x[:, None], n_y[None, :]), np.maximum(n_x[:, None], n_y[None, :])
    sketches = [[v[:k] for v in s] for s in (x, y)]
    shared = overlaps(*sketches)
    small = high <= k  # sketches that hold both sets whole
    fits = np.where(small, 100 * shared >= percent * (low + high - shared), shared >= min_shared) & (100 * low >= percent * high)
    i, j = np.nonzero(fits)
    keep = small[i, j]
    rest = np.flatnonzero(~keep)
    most = np.iinfo(np.int64).max
    padded = [np.array([np.concatenate([v, np.full(k - len(v), most)]) for v in s]) for s in sketches]
    for start in range(0, len(rest), 8192):
        at = rest[start : start + 8192]
        both = np.sort(np.hstack([padded[0][i[at]], padded[1][j[at]]]), axis=1)
        twice = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != most)
        place = np.arange(1, both.shape[1]) - np.cumsum(twice, axis=1)  # of a repeated value in the union, from 0
        keep[at] = (twice & (place < k)).sum(axis=1) >= min_shared
    return i[keep], j[keep]


def _links_between(x: pd.DataFrame, y: pd.DataFrame, percent: int, k: int, min_shared: int) -> list[tuple[int, int]]:
    """Links between rows of different components, no more than it takes to join these."""
    sets = [[np.frombuffer(b, np.int64) for b in f["items"]] for f in (x, y)]
    comps = x["comp"].to_numpy(), y["comp"].to_numpy()
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = c = parent[parent[c]]
        return c

    found, nodes = [], (x["node"].to_numpy(), y["node"].to_numpy())
    for start in range(0, len(x), 256):  # so that matrices stay small
        i, j = _linked(sets[0][start : start + 256], sets[1], comps[0][start : start + 256], comps[1], percent, k, min_shared)
        for m, n in zip((i + start).tolist(), j.tolist(), strict=True):
            a, b = root(int(comps[0][m])), root(int(comps[1][n]))
            if a != b:
                parent[b] = a
                found.append(tuple(sorted((int(nodes[0][m]), int(nodes[1][n])))))
    return found


def _linked(x: list[np.ndarray], y: list[np.ndarray], comp_x: np.ndarray, comp_y: np.ndarray, percent: int, k: int, min_shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of linked sets of different components."""
    i, j = candidates(x, y, percent, k, min_shared)
    apart = comp_x[i] != comp_y[j]
    i, j = i[apart], j[apart]
    if not len(i):
        return i, j
    # exact overlaps of the rows that are in any candidate pair
    (some_i, at_i), (some_j, at_j) = np.unique(i, return_inverse=True), np.unique(j, return_inverse=True)
    own = [x[a] for a in some_i], [y[b] for b in some_j]
    shared = overlaps(*own)[at_i, at_j]
    size = lambda s: np.array(list(map(len, s)))
    linked = 100 * shared >= percent * (size(own[0])[at_i] + size(own[1])[at_j] - shared)
    return i[linked], j[linked]


def max_miss_probability(k: int = 64, min_shared: int = 32, similarity: float = 0.8) -> float:
    """Chance that a pair at ``similarity`` shares fewer than ``min_shared`` of ``k`` sampled union values."""
    return sum(math.comb(k, i) * similarity**i * (1 - similarity) ** (k - i) for i in range(min_shared))
