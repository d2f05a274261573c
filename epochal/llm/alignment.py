"""Alignment of two tokenizers' tokens over the same texts, and how well their ids correspond in a corpus.

Side A is a byte-level BPE file of the tokenizers library, side B a sentencepiece model; both see a blank before the
text. After both have tokenised a text, its *anchors* are the byte offsets where a token of each side ends and the next
tokens of both begin with a blank. Anchors cut the two id sequences into windows, whose groups (the finest parts with
common ends) and links (pairs of tokens that share bytes) depend on their ids alone, so a bounded memo maps the id tuples
of a window to its alignment.

For each pair of ids the corpus has a number of documents in which they are linked. The most frequent pairs (at most
``HEAVY``) are broadcast; the others, which by that are in few documents each, are joined by the pair, so
there is neither a hot key nor a broadcast that grows.

Edge cases: null and empty texts, and those whose tokens' bytes aren't a blank and the text, have no tokens: zeros, empty
groups; strings of special tokens are plain text; texts are aligned whole, however long; equal rows are documents of
their own; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .bpe import _STAND_IN, Memo
from .common import materialize, ship_package, work_dir

# fixed value: the published split pattern of this kind of byte-level BPE
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A single blank between other characters: no token of either side crosses its left end.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Pairs that are broadcast; bits of a pair that hold the B id; the longest part that the fast encoder gets; characters aligned at once.
HEAVY, B_BITS, LONGEST, TOGETHER = 1 << 18, 15, 50_000, 1 << 19
_NONE = np.zeros(0, np.int32)
_BETWEEN = b"\xff\xff"  # between the two sides of a window's key; no id


def _length_and_blank(table: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([len(b) for b in table], np.int64), np.array([b[:1] == b" " for b in table])


class Aligner:
    """Both encoders of a worker, with memos of words and windows (each at most twice the number given)."""

    WORDS, WINDOWS = 200_000, 200_000

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(byte_path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: b for b, c in _STAND_IN.items()}
        special = {t["content"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.library = Tokenizer.from_file(byte_path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in vocab.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        in_order = all(vocab[a + b] == i for i, (a, b) in enumerate(merges, 256)) and len(ranks) == 256 + len(merges)
        if spec["pre_tokenizer"] | {"trim_offsets": True} != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or not in_order:
            raise ValueError("not a byte-level BPE whose ids are in the order of its merges")
        self.fast = tiktoken.Encoding("byte level", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.piece = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        n, p = self.piece.get_piece_size(), self.piece
        pieces = [p.id_to_piece(i) for i in range(n)]
        if n > 1 << B_BITS or max(ranks.values()) >> 31 - B_BITS:
            raise ValueError("ids don't fit")
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.a_bytes[i] = b
        self.b_bytes = [bytes([int(x[3:5], 16)]) if p.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces)]
        self.a_length, self.a_blank = _length_and_blank(self.a_bytes)
        self.b_length, self.b_blank = _length_and_blank(self.b_bytes)
        #: What follows an id in the groups' text: more of its side, the other side, or the next group.
        self.names = [f"{i}{after}" for table, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for after in marks for i in range(len(table))]
        self.cuts = not any("▁" in x.lstrip("▁") for x in pieces)
        self.words = Memo(self._coded, self.WORDS)
        self.windows = Memo(self._aligned, self.WINDOWS, longest=64)

    def _coded(self, parts: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """For each part, which a blank goes before: A and B ids as 16-bit numbers, and whether both spell the part.

        Parts are encoded as one text and cut at their byte ends, as no token crosses the blanks; where that fails, one by one.
        """
        inner = [p for p in parts if self.cuts and 0 < len(p) <= LONGEST and not p[0].isspace() and not p[-1].isspace()]
        known = dict(zip(inner, self._together(inner) or map(self._single, inner), strict=True)) if inner else {}
        return [known[p] if p in known else self._single(p) for p in parts]

    def _single(self, part: str) -> tuple[bytes, bytes, bool]:
        a = self.fast.encode_ordinary(" " + part) if len(part) <= LONGEST else self.library.encode(" " + part, add_special_tokens=False).ids
        b, wanted = self.piece.encode(part, num_threads=1), b" " + part.encode()
        same = b"".join(map(self.a_bytes.__getitem__, a)) == wanted and b"".join(map(self.b_bytes.__getitem__, b)) == wanted
        return np.array(a, "<u2").tobytes(), np.array(b, "<u2").tobytes(), same

    def _together(self, parts: list[str]) -> list[tuple[bytes, bytes, bool]] | None:
        text = " ".join(parts)
        wanted, ends, out = b" " + text.encode(), np.cumsum([len(p.encode()) + 1 for p in parts]), []
        for ids, table, length in (
            (self.fast.encode_ordinary(" " + text), self.a_bytes, self.a_length),
            (self.piece.encode(text, num_threads=1), self.b_bytes, self.b_length),
        ):
            if b"".join(map(table.__getitem__, ids)) != wanted:
                return None
            ids = np.array(ids, "<u2")
            at = np.cumsum(length[ids])
            last = np.searchsorted(at, ends)
            if not np.array_equal(at[last], ends):
                return None
            cuts, data = [0, *(2 * last + 2).tolist()], ids.tobytes()
            out.append([data[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)])
        return [(a, b, True) for a, b in zip(*out, strict=True)]

    def tokens(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text all A and B ids as 16-bit numbers; none if either side doesn't spell a blank and the text."""
        parts = [(_CUT.split(t) if self.cuts else [t]) if t else [] for t in texts]
        coded = self.words.of(list(chain.from_iterable(parts)))
        out, at = [], 0
        for text, own in zip(texts, parts, strict=True):
            mine = coded[at : at + len(own)]
            at += len(own)
            a, b = b"".join([x[0] for x in mine]), b"".join([x[1] for x in mine])
            if not all([x[2] for x in mine]):
                wanted, sides = b" " + text.encode(), ((self.a_bytes, a), (self.b_bytes, b))
                if any(b"".join(map(table.__getitem__, np.frombuffer(ids, "<u2").tolist())) != wanted for table, ids in sides):
                    a = b = b""
            out.append((a, b))
        return out

    def _aligned(self, keys: list[bytes]) -> list[tuple[str, int, int, bytes]]:
        """For each window its groups as text, their number, the number of links and the links' pairs of ids.

        Both sides of a window spell the same bytes, so windows are laid end to end and aligned at once: a link is a
        stretch between neighbouring ends of either side, a group one between ends of both.
        """
        if not keys:
            return []
        ids = np.frombuffer(b"".join(keys), "<u2")
        middle, stop = np.flatnonzero(ids == 0xFFFF), np.cumsum([len(k) // 2 for k in keys])
        n_a, n_b = np.diff(stop, prepend=0), stop - middle - 1
        n_a = n_a - n_b - 1
        side = np.repeat(np.tile(np.array([0, 2, 1]), len(keys)), np.stack([n_a, np.ones_like(n_a), n_b], 1).ravel())
        a, b = ids[side == 0].astype(np.int32), ids[side == 1].astype(np.int32)
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        a_here, b_here = np.zeros(a_end[-1] + 1, bool), np.zeros(a_end[-1] + 1, bool)  # whether a token ends at a byte
        a_here[a_end] = b_here[b_end] = True
        both = a_here & b_here
        a_number, b_number, group = (np.cumsum(x, dtype=np.int32) - x for x in (a_here, b_here, both))  # what ended before a byte
        ends, border = np.flatnonzero(a_here | b_here), np.flatnonzero(both)
        pairs = (a[a_number[ends]] << B_BITS | b[b_number[ends]]).astype("<i4").tobytes()
        a_until, b_until = a_number[border] + 1, b_number[border] + 1  # tokens up to the end of each group
        codes = np.empty(len(a) + len(b), np.int32)
        codes[np.arange(len(a)) + np.concatenate(([0], b_until))[group[a_end]]] = a + len(self.a_bytes) * both[a_end]
        codes[np.arange(len(b)) + a_until[group[b_end]]] = 2 * len(self.a_bytes) + b + len(self.b_bytes) * both[b_end]
        named = list(map(self.names.__getitem__, codes.tolist()))
        window = a_end[np.cumsum(n_a) - 1]
        links, groups = np.searchsorted(ends, window) + 1, np.searchsorted(border, window) + 1
        out, t, l, g = [], 0, 0, 0
        for to_t, to_l, to_g in zip(np.cumsum(n_a + n_b).tolist(), links.tolist(), groups.tolist(), strict=True):
            out.append(("".join(named[t:to_t])[:-1], to_g - g, to_l - l, pairs[4 * l : 4 * to_l]))
            t, l, g = to_t, to_l, to_g
        return out

    def align(self, texts: list[str]) -> list[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
        """For each text the numbers of A tokens, B tokens, groups and links, the groups, the distinct linked pairs and their numbers of links.

        Tokens of all texts are laid end to end: each text begins with a blank on both sides, so its start is an anchor.
        """
        sides = self.tokens(texts)
        out = [(0, 0, 0, 0, "", _NONE, _NONE)] * len(texts)
        which = [k for k, (a, _) in enumerate(sides) if a]
        if not which:
            return out
        a_ids, b_ids = (b"".join([sides[k][x] for k in which]) for x in (0, 1))
        a, b = np.frombuffer(a_ids, "<u2"), np.frombuffer(b_ids, "<u2")
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        a_cut, b_cut = np.flatnonzero(self.a_blank[a[1:]]) + 1, np.flatnonzero(self.b_blank[b[1:]]) + 1
        a_at, b_at = a_end[a_cut - 1], b_end[b_cut - 1]
        place = np.searchsorted(b_at, a_at)
        inside = place < len(b_at)
        a_cut, a_at, place = a_cut[inside], a_at[inside], place[inside]
        shared = b_at[place] == a_at
        left, right = (2 * a_cut[shared]).tolist(), (2 * b_cut[place[shared]]).tolist()
        keys = [a_ids[i:j] + _BETWEEN + b_ids[k:m] for i, j, k, m in zip([0, *left], [*left, len(a_ids)], [0, *right], [*right, len(b_ids)], strict=True)]
        groups, n_groups, n_links, pairs = zip(*self.windows.of(keys), strict=True)
        n_a, n_b = ([len(sides[k][x]) // 2 for k in which] for x in (0, 1))
        last = np.searchsorted(np.append(a_at[shared], a_end[-1]), a_end[np.cumsum(n_a) - 1])  # each text's last window
        until = [0, *(last + 1).tolist()]
        links, made = (np.diff(np.cumsum(n)[last], prepend=0) for n in (n_links, n_groups))
        text = np.repeat(np.arange(len(which), dtype=np.int64), links) << 32
        distinct, times = np.unique(text | np.frombuffer(b"".join(pairs), "<i4"), return_counts=True)
        first = np.searchsorted(distinct, np.arange(len(which) + 1, dtype=np.int64) << 32).tolist()
        distinct, times = (distinct & 0xFFFFFFFF).astype(np.int32), times.astype(np.int32)
        for n, k in enumerate(which):
            own = slice(first[n], first[n + 1])
            out[k] = n_a[n], n_b[n], int(made[n]), int(links[n]), ";".join(groups[until[n] : until[n + 1]]), distinct[own], times[own]
        return out


_BUILT: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """The worker's one aligner for two files."""
    if (byte_path, piece_path) not in _BUILT:
        _BUILT[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _BUILT[byte_path, piece_path]


def _arrays(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int32), *parts]))


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times) for (doc_id, text).

    ``row`` numbers the rows; ``groups`` is the alignment as text (``a1,a2|b1;a3|b2,b3``); ``pairs`` are the distinct
    pairs of linked ids (the A id times 2**15, plus the B id) and ``times`` how many links each has.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]

    def made(side: Aligner, batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, texts, size = [], [], 0
        for t in batch.column(2):
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if size > TOGETHER:
                rows += side.align(texts)
                texts, size = [], 0
        rows += side.align(texts)
        n_a, n_b, n_groups, n_links, groups, pairs, times = zip(*rows, strict=True) if rows else [()] * 7
        new = [*(pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups, n_links)), pa.array(groups, pa.string()), _arrays(pairs), _arrays(times)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *new], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = aligner(byte_path, piece_path)
        for batch in batches:
            gc.disable()  # nothing here is cyclic, and collections would walk through the memos again and again
            try:
                out = made(side, batch)
            finally:
                gc.enable()
            yield out

    out = f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<int>, times array<int>"
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(run, out)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold a pair linked, and whether that is the highest number of the pair's A id.

    An A id has at most as many pairs as the other side has ids, so a window over them is bounded.
    """
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(W.partitionBy(F.shiftright("pair", B_BITS)))).select("pair", "n", "best")


def least_of_heavy(counts: DataFrame, heavy: int = HEAVY) -> int:
    """The smallest power of two that at most ``heavy`` pairs reach; from one row for each power."""
    total = 0
    for power, n in sorted(counts.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count("*").alias("k")).collect(), reverse=True):
        total += n
        if total > heavy:
            return 2 ** (power + 1)
    return 1


def correspondence(rows: DataFrame, counts: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(row, n_best, count_sum) for rows with links: those whose pair is its A id's best, and the sum of all links' counts."""
    least = least_of_heavy(counts, heavy)
    links = rows.select("row", F.posexplode("pairs").alias("k", "pair"), "times").select("row", "pair", F.col("times")[F.col("k")].alias("times"))
    sums = lambda f: f.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    often = F.broadcast(counts.where(F.col("n") >= least))  # at most ``heavy`` rows
    parts = sums(links.join(often, "pair"))
    if least > 1:
        rest = links.join(often.select("pair"), "pair", "left_anti").join(counts.where(F.col("n") < least), "pair")
        parts = parts.unionByName(sums(rest)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return parts


def compare(docs: DataFrame, byte_path: str, piece_path: str, heavy: int = HEAVY) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of (doc_id, text)."""
    folder = work_dir(docs.sparkSession, "alignment")
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    numbers = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links"]
    rows = materialize(align(docs, byte_path, piece_path).select(*numbers, digest, "pairs", "times"), folder, "rows")
    counts = materialize(pair_counts(rows), folder, "counts")
    found = rows.select(*numbers, "groups_sha256").join(correspondence(rows, counts, heavy), "row", "left")
    whole = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}
    return found.withColumns(whole).select(*numbers[1:], "n_best", "count_sum", "groups_sha256")
