"""BPE encoding by backtracking, and decoding by an offset table.

A word's merges are found in linear time without merging: an Aho-Corasick automaton over all tokens gives
the longest token at each place; the encoder takes it if it is *compatible* with the token before it and
else falls back to the token's longest proper prefix, or steps back. Two adjacent tokens are compatible
if byte-pair merging could leave just this border between them, which a walk down their two split
trees decides with the table of pairs. The one compatible sequence is what merging would have produced. (The
method is a published one, known from open-source linear-time BPE encoders.)

Texts are cut at white space first; since no token crosses it, a bounded memo maps each piece to its ids.

Edge cases: null and empty texts encode to no ids and decode to empty text; special tokens' strings in
a text become their ids, as the tokenizer file asks; ids out of the vocabulary raise IndexError.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import ship_package, unused, with_fields

#: White space at which texts are cut (Unicode White_Space), and controls that only str.split() cuts at.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_SPLIT_ONLY = re.compile("[\x1c-\x1f]")
#: Letters, digits and marks whose classes no Unicode version has changed; others go to the library.
_PLAIN = re.compile("[\x00-ʯ‐-‧‰-›]*")
#: A byte's printable stand-in in byte-level vocabularies: printable Latin-1 stays, others follow from 256 on.
_STAYS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_STAND_IN = {b: chr(b) for b in _STAYS} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_STAYS))
}
_LAST = 0x4000  # added to a word's last symbol: the end-of-word form is a symbol of its own


def pieces(text: str) -> list[str]:
    """The text's parts between white space."""
    return text.split() if not _SPLIT_ONLY.search(text) else [p for p in _SPACE.split(text) if p]


class Memo:
    """At most ``2 * size`` short keys and their values, in two generations; longer keys pass through.

    ``fixed`` holds values that aren't computed.
    """

    def __init__(self, compute, size: int, longest: int = 48):
        self.compute, self.size, self.longest, self.new, self.old, self.fixed = compute, size, longest, {}, {}, {}

    def of(self, keys: list[str]) -> list[bytes]:
        out = list(map(self.new.get, keys))
        if None in out:
            missing = list(dict.fromkeys(k for k, v in zip(keys, out, strict=True) if v is None))
            found = {k: v for k in missing if (v := self.fixed.get(k) or self.old.get(k)) is not None}
            fresh = [k for k in missing if k not in found]
            found.update(zip(fresh, self.compute(fresh), strict=True))
            out = [found[k] if v is None else v for k, v in zip(keys, out, strict=True)]
            self.new.update((k, v) for k, v in found.items() if len(k) <= self.longest)
            if len(self.new) > self.size:
                self.new, self.old = {}, self.new
        return out


class Bpe:
    """Encoder and decoder of one tokenizer file (byte-level BPE with an end-of-word suffix)."""

    #: Entries of a memo's generation and of the pairs' table; a worker keeps them for its lifetime, beside other stages' data.
    N_WORDS, N_PIECES, N_PAIRS = 100_000, 200_000, 100_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"].get("end_of_word_suffix") or ""
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        first, second = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or (first["type"], second["type"]) != ("Split", "ByteLevel"):
            raise ValueError("not a lower-casing byte-level BPE with a split pattern")
        self.pattern = regex.compile(first["pattern"]["Regex"])
        self.library = Tokenizer.from_file(path)
        self.suffix, self.vocab = suffix, model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._build(model)
        self.words = Memo(self._coded, self.N_WORDS)
        self.words.fixed = {t: array("I", [i]).tobytes() for t, i in self.special.items()}
        self.memo = Memo(self._pieces, self.N_PIECES)

    def _build(self, model: dict) -> None:
        self._tables([m if isinstance(m, list) else m.split(" ") for m in model["merges"]])
        self._offsets()

    def _symbols(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + _LAST)
        return token

    def _tables(self, merges: list[list[str]]) -> None:
        """Tokens numbered by rank: single symbols first, then each merge's product."""
        number, self.ids = {}, []
        for token, i in self.vocab.items():
            if len(s := self._symbols(token)) == 1:
                number[s] = len(self.ids)
                self.ids.append(i)
        self.split, self.pair = [(i, i) for i in range(len(self.ids))], {}
        for left, right in merges:
            a, b = number[self._symbols(left)], number[self._symbols(right)]
            token = left + right
            n = number.setdefault(self._symbols(token), len(self.ids))
            if n == len(self.ids):
                self.ids.append(self.vocab[token])
                self.split.append((a, b))
            self.pair.setdefault((a, b), n)
        self.size, self.prefix = [0] * len(self.ids), [-1] * len(self.ids)
        self.automaton = ahocorasick.Automaton()
        for s, n in number.items():
            self.size[n] = len(s)
            self.automaton.add_word(s, n)
            self.prefix[n] = next((number[s[:e]] for e in range(len(s) - 1, 0, -1) if s[:e] in number), -1)
        self.automaton.make_automaton()
        self.known: dict[tuple[int, int], bool] = {}

    def _offsets(self) -> None:
        """Decoding table: all tokens' bytes in one string, and where each begins."""
        by_id = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        texts = [by_id.get(i, "").encode() for i in range(max(by_id) + 1)]
        self.bytes, self.offsets = b"".join(texts), np.cumsum([0, *map(len, texts)])
        self.cut = [self.bytes[a:b] for a, b in zip(self.offsets[:-1], self.offsets[1:], strict=True)]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' symbols keeps the border between them."""
        limit = len(self.ids)
        while True:
            if self.pair.get((left, right), limit) < limit:
                return False
            if left > right:
                limit, left = left, self.split[left][1]
                if left == limit:
                    limit, right = right + 1, self.split[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit, right = right + 1, self.split[right][0]
                if right + 1 == limit:
                    limit, left = left, self.split[left][1]
                    if left == limit:
                        return True

    def word(self, symbols: str) -> list[int]:
        """Token numbers of one word, whose last symbol is in its end-of-word form."""
        n, size, known, longest_from = len(symbols), self.size, self.known, self.automaton.iter_long
        longest = {end + 1 - size[t]: t for end, t in longest_from(symbols)}
        if sum(map(size.__getitem__, longest.values())) != n:
            raise ValueError("a symbol is not in the vocabulary")
        out: list[int] = []
        dead, at, token = set(), 0, longest[0]
        while at < n:
            end = at + size[token]
            if end not in dead:
                if out:
                    fits = known.get(key := (out[-1], token))
                    if fits is None:
                        fits = self._fits(key)
                else:
                    fits = True
                if fits:
                    out.append(token)
                    at = end
                    if at < n and at not in longest:
                        longest[at] = next(longest_from(symbols, at))[1]
                    token = longest.get(at, -1)
                    continue
            if self.prefix[token] >= 0:
                token = self.prefix[token]
            else:
                dead.add(at)
                token = out.pop()
                at -= size[token]
        return out

    def _fits(self, key: tuple[int, int]) -> bool:
        if len(self.known) > self.N_PAIRS:
            self.known.clear()
        ok = self.known[key] = self.compatible(*key)
        return ok

    def _words(self, part: str) -> list[str]:
        if part.isascii() and part.isprintable():
            return self.pattern.findall(part.lower())
        if _PLAIN.fullmatch(part):
            found = self.pattern.findall(unicodedata.normalize("NFC", part).lower())
            return ["".join(map(_STAND_IN.__getitem__, w.encode())) for w in found]
        text = self.library.normalizer.normalize_str(part)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _coded(self, words: list[str]) -> list[bytes]:
        if self.suffix:
            words = [w[:-1] + chr(ord(w[-1]) + _LAST) for w in words]
        ids = self.ids.__getitem__
        return [array("I", map(ids, self.word(w))).tobytes() for w in words]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        split, counts = [], []
        for piece in pieces:
            before = len(split)
            if "<" in piece and self.special_at and self.special_at.search(piece):
                for part in self.special_at.split(piece):
                    split += [part] if part in self.special else self._words(part)
            else:
                split += self._words(piece)
            counts.append(len(split) - before)
        coded = self.words.of(split)
        ends = list(accumulate(counts))
        return [b"".join(coded[e - c : e]) for e, c in zip(ends, counts, strict=True)]

    def encode(self, text: str | None) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        return b"".join(self.memo.of(pieces(text))) if text else b""

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of ids, as a tokenizer file without a decoder joins them: tokens and single blanks."""
        return b" ".join(map(self.cut.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class LibraryBpe(Bpe):
    """The same cuts and memos, with each word's merges made by the tokenizers library's own model.

    It only encodes, so it has no tables of tokens and pairs.
    """

    N_WORDS, N_PIECES = 250_000, 600_000

    def _build(self, model: dict) -> None:
        self.vocab = None
        before, letters, _ = self.pattern.pattern.partition(r"[\p{L}]+")
        self.whole_letters = bool(letters) and all(p.startswith("'") for p in before.split("|")[:-1])

    def _words(self, part: str) -> list[str]:
        """Letters alone are one word, where no earlier alternative of the pattern begins with a letter."""
        if self.whole_letters and part.isalpha():
            if part.isascii():
                return [part.lower()]
            if _PLAIN.fullmatch(part) and (word := unicodedata.normalize("NFC", part).lower()).isalpha():
                return ["".join(map(_STAND_IN.__getitem__, word.encode()))]
        return super()._words(part)

    def _coded(self, words: list[str]) -> list[bytes]:
        tokenize = self.library.model.tokenize
        return [array("I", [t.id for t in tokenize(w)]).tobytes() for w in words]


_BUILT: dict[tuple, Bpe] = {}


def bpe(path: str, kind: type[Bpe] = Bpe) -> Bpe:
    """The worker's one encoder for a file."""
    if (path, kind) not in _BUILT:
        _BUILT[path, kind] = kind(path)
    return _BUILT[path, kind]


def _rows(batches: Iterator[pa.RecordBatch], path: str, make, schema: pa.Schema, at: int) -> Iterator[pa.RecordBatch]:
    coder = bpe(path)
    for batch in batches:
        rows = [make(coder, coder.encode(t.as_py())) for t in batch.column(at)]
        new = [pa.array(c, schema.field(i).type) for i, c in enumerate(zip(*rows, strict=True))] if rows else []
        new = new or [pa.array([], f.type) for f in schema]
        yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *schema.names])


def encode(docs: DataFrame, path: str, *, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens (long) and ids (array<int>); names that are taken get a ``_`` appended."""
    ship_package(docs.sparkSession)
    n, ids = unused("n_tokens", docs.columns), unused("ids", docs.columns)
    schema = pa.schema([(n, pa.int64()), (ids, pa.list_(pa.int32()))])
    made = lambda coder, b: (len(b) // 4, np.frombuffer(b, "<i4"))
    at = docs.columns.index(text)
    out = with_fields(docs.schema, **{n: "long", ids: "array<int>"})
    return docs.mapInArrow(lambda batches: _rows(batches, path, made, schema, at), out)


def decode(frame: DataFrame, path: str, *, ids: str = "ids") -> DataFrame:
    """``frame`` with decoded (string), the text of an ``array<int>`` column; null ids decode to empty text."""
    ship_package(frame.sparkSession)
    name, at = unused("decoded", frame.columns), frame.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe(path)
        for batch in batches:
            texts = [coder.decode(np.array(x.as_py() or [], "<u4").tobytes()).decode() for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])

    return frame.mapInArrow(run, with_fields(frame.schema, **{name: "string"}))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode each text of (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ship_package(docs.sparkSession)
    schema = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    made = lambda coder, b: (
        len(b) // 4,
        hashlib.sha256(b).hexdigest(),
        hashlib.sha256(coder.decode(b)).hexdigest(),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _rows(batches, path, made, schema, 1):
            yield b.select([0, 2, 3, 4])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, out)
