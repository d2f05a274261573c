"""The alignment of two tokenizers against the libraries and a token-by-token twin."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from epochal.llm import alignment, queries
from epochal.llm.bpe import _STAND_IN

A, B = (queries.tokenizer_path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ALPHABET = [*"ab  \n\t'sdé中😀  ▁ﬁ.,-09\x1c\x85", "the ", " word", " <|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "'ll", "́"]


@pytest.fixture(scope="module")
def library():
    left, right = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    left.encode_special_tokens = True
    byte = {c: b for b, c in _STAND_IN.items()}
    spell_b = lambda i: bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("▁", " ").encode()

    def tokens(text):
        """(id, bytes) of both sides."""
        if not text:
            return [], []
        a = [(i, bytes(byte[c] for c in left.id_to_token(i))) for i in left.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, spell_b(i)) for i in right.encode(text)]
        ok = all(b"".join(x for _, x in side) == (" " + text).encode() for side in (a, b))
        return (a, b) if ok else ([], [])

    return tokens


def by_hand(rows, library):
    found = []
    for i, text in rows:
        a, b = library(text)
        spans = []
        for side in (a, b):
            at, own = 0, []
            for t, x in side:
                own.append((at, at + len(x), t))
                at += len(x)
            spans.append(own)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, start = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(t) for s, f, t in side if start <= s and f <= e) for side in spans))
            start = e
        links, first = Counter(), 0
        for s, e, t in spans[0]:
            while spans[1][first][1] <= s:
                first += 1
            k = first
            while k < len(spans[1]) and spans[1][k][0] < e:
                links[t, spans[1][k][2]] += 1
                k += 1
        found.append((i, len(a), len(b), groups, links))
    count = Counter(pair for *_, links in found for pair in links)
    most = defaultdict(int)
    for (t, _), n in count.items():
        most[t] = max(most[t], n)
    return sorted((
        (i, n_a, n_b, len(g), sum(x.values()), sum(n for p, n in x.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in x.items()), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for i, n_a, n_b, g, x in found
    ), key=str)


@pytest.mark.parametrize("heavy", [alignment.HEAVY, 40])
def test_alignment_equals_the_twin(spark, library, heavy):
    """Nulls, empty, blank, odd, repeated and long texts; with all pairs broadcast, and with most of them joined."""
    rnd = random.Random(heavy)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    rows += [(1000 + i, "".join(rnd.choices(ALPHABET, k=rnd.randint(1, 14)))) for i in range(300)]
    rows += [(-1, None), (-2, ""), (-3, " "), (-4, "\n"), (None, "no id"), (None, "no id"), (7, "the word"), (7, "the word"), (8, "ab" * 1_500), (9, " ".join(str(rnd.random()) for _ in range(300)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit("x") for c in ("row", "pairs", "n_a", "groups", "n", "best")})
    got = sorted((tuple(r) for r in alignment.compare(docs, A, B, heavy).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)
    assert got == by_hand(rows, library)


def test_both_sides_equal_the_libraries(library):
    side, rnd = alignment.aligner(A, B), random.Random(3)
    texts = ["".join(rnd.choices(ALPHABET, k=rnd.randint(1, 14))) for _ in range(5_000)]
    texts += ["a" * 200_000, "\n" * 49_000 + " b", " ".join(["x" * 30] * 3_000)]
    ids = lambda b: np.frombuffer(b, "<u2").tolist()
    for text, (a, b) in zip(texts, side.tokens(texts), strict=True):
        want = library(text)
        assert (ids(a), ids(b)) == tuple([i for i, _ in x] for x in want)


def test_few_pairs_are_broadcast_and_none_lost(spark):
    counts = spark.createDataFrame([(k, 2 ** (k % 10), True) for k in range(1000)], "pair int, n long, best boolean")
    least = alignment.least_of_heavy(counts, 250)
    assert least == 2**8 and counts.where(f"n >= {least}").count() == 200
    assert alignment.least_of_heavy(counts, 1000) == 1


def test_alignment_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.compare(docs, A, B).collect() == []
