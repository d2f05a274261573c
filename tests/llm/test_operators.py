"""Brute-force twins, exact round trips and edge cases of the training-data operators."""

import base64
import gzip
import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from epochal.llm import ann, bpe, language_id, mixing, near_dup, quality, token_store, toxicity, url_filter, warc
from epochal.llm.common import work_dir
from epochal.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in "ba be bi bo bu da de di do du".split() for b in "ka ke ki ko ku la le li lo lu".split()]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def docs(spark):
    """Null, empty, blank and repeated rows, copies, near copies, a hub's variants and a long text."""
    rnd = random.Random(7)
    base = prose(rnd, 120).split()
    rows = [(None, "a text without an id, long enough to have shingles"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one")]
    for i in range(10, 60):
        w = list(base)
        for _ in range(rnd.choice((0, 1, 2, 4, 8))):
            w[rnd.randrange(len(w))] = rnd.choice(WORDS)
        rows.append((i, " ".join(w)))
    rows += [(i, prose(rnd, 80)) for i in range(60, 90)]
    rows.append((90, prose(rnd, 30_000)))
    return spark.createDataFrame([(i, t, "x", None, len(t) if t is not None else None) for i, t in rows], SCHEMA).repartition(5)


def near_dup_by_force(rows, words):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(zip(*[w[i:] for i in range(min(words, len(w)))])) if w else frozenset()

    ids = {}
    for i, t in rows:
        if i is not None:
            ids.setdefault(i, set()).add(shingles(t))
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in ids[a] for y in ids[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(docs, words):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = near_dup.near_duplicates(docs, words=words).collect()
    assert len(found) == len(rows)
    force = near_dup_by_force(rows, words)
    for r in found:
        assert r["component_id"] == (force[r["doc_id"]] if r["doc_id"] is not None else None)
        assert r["kept"] == (r["component_id"] is None or r["doc_id"] == r["component_id"])


def test_near_duplicates_of_nothing(docs):
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_overlaps_and_sketch_bound():
    rnd = np.random.default_rng(1)
    x, y = ([np.unique(rnd.integers(0, 300, rnd.integers(1, 200))) for _ in range(n)] for n in (90, 70))
    assert (near_dup.overlaps(x, y) == [[len(np.intersect1d(a, b)) for b in y] for a in x]).all()
    assert near_dup.max_miss_probability() < 2e-7


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(tokenizer_path()), bpe.bpe(tokenizer_path())
    rnd = random.Random(3)
    letters = "aeiourstnlthd.,#$1 'éß<>|&İΣς́\n\x1c 中€"
    texts = ["", "<|endoftext|>x<|startoftext|>", "x" * 3000, *("".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(500))]
    for t in texts:
        ids = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(t), "<u4").tolist() == ids
        assert own.decode(own.encode(t)).decode() == library.decode(ids, skip_special_tokens=False)


def test_bpe_on_tables(spark):
    frame = spark.createDataFrame([(1, None, 5), (2, "Hello there", 6)], "doc_id long, text string, ids int")
    out = bpe.decode(bpe.encode(frame, tokenizer_path()), tokenizer_path(), ids="ids_").orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in out] == [0, 2] and out[0]["decoded"] == "" and out[1]["ids"] == 6
    assert bpe.round_trip(frame.limit(0), tokenizer_path()).count() == 0


def test_token_store(spark):
    rows = [(None, "null id"), (5, "x"), (5, "x"), (7, ""), (2**60 + 1, "big one"), (8, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for f in (frame, frame.limit(0)):
        store = token_store.write_store(f, tokenizer_path(), work_dir(spark, "t"), end_id=1, vocabulary=49_408)
        keys = spark.createDataFrame([(5,), (None,), (7,), (8,), (9,), (2**60 + 1,)], "doc_id long")
        got = store.read(keys).orderBy("start").collect()
        assert [r["doc_id"] for r in got] == ([None, 5, 5, 7, 8, 2**60 + 1] if f is frame else [])
        at = 0
        for r in got:
            assert r["start"] == at
            at += len(r["ids"]) // r["width"]


def test_minimal_perfect_hash():
    h = np.random.default_rng(2).integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2)
    d = token_store.build_mph(h, len(h) // 4)
    assert sorted(token_store.find_slots(h, d, len(h))) == list(range(len(h)))


def test_quality_lines():
    rnd = random.Random(2)
    clean = "\n".join(prose(rnd, 12) for _ in range(8))  # few words repeat, so the base rules hold
    (n, *_, failed, kept), text = quality.judge_text(clean + "\nHome | About | Contact\nAll rights reserved.")
    assert kept and not failed and text == clean
    assert not quality.judge_text("word | " * 100)[0][-1]
    assert quality.judge_text(None)[0][:3] == (0, 0, 0)
    assert quality.repeated_words(b"a b c d a b c".split()) == 6


def test_quality_tables(spark, docs):
    assert quality.judge(docs).count() == docs.count()
    assert quality.clean(docs.limit(0)).count() == 0
    assert quality.clean(docs).columns == docs.columns


def test_url_filter(spark):
    urls = {1: "http://A.Example.org/es/1?x", 2: None, 3: "no scheme", 4: "https://x.com/en/casino-poker", 5: "https://x.net/sussexxx", 6: "https://x.net/xxx/", 7: "https://q.org", 8: "https://x.com/de/xxx"}
    frame = spark.createDataFrame([(k, v, "extra") for k, v in urls.items()], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(frame).collect()}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == got[3] == ("", "", None, "allow")
    assert [got[i][3] for i in (4, 5, 6, 7, 8)] == ["block", "allow", "block", "allow", "block"]
    assert got[7][2] is None and got[8][2] == "com/de/"


def test_language(spark):
    rows = [(i, " ".join(["the house and the tree", "das haus und der baum"][i % 2].split() * 5), ["en", "de"][i % 2]) for i in range(20)]
    rows += [(30, None, "en"), (31, "123 ...", None), (32, "the tree", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language_id.profile_arrays(language_id.learn(frame))
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(frame, profiles).collect()}
    assert got[30] == got[31] == "und" and got[32] == "en" and got[1] == "de"
    assert language_id.predict(frame.limit(0), {}).count() == 0


def test_counterfactual_penalty_lowers_identity_weights():
    rnd = random.Random(5)
    rows = []
    for i in range(400):
        bad = i % 2
        rows.append((" ".join(["idiot"] * bad + (["muslim"] if rnd.random() < (0.8 if bad else 0.1) else []) + rnd.sample(WORDS, 5)), bad))
    y = np.array([b for _, b in rows])
    named = [xxhash.xxh3_64_intdigest(t) for g in toxicity.IDENTITY for t in g]
    chosen = np.unique(np.concatenate([toxicity._numbers(["idiot", *WORDS]), np.array(named, np.uint64)]))
    made = [(np.searchsorted(chosen, np.sort(toxicity._numbers(toxicity.words(t)))).astype(np.int16), toxicity._numbers([w for p in toxicity.swaps(toxicity.words(t), toxicity.IDENTITY) for w in p])) for t, _ in rows]
    fit = lambda swap: toxicity.fit(made, y, chosen, l1=1e-4, swap=swap, rounds=400)
    gap = lambda m: abs(m.score("a muslim lives here") - m.score("a christian lives here"))
    assert gap(fit(5.0)) < 0.5 * gap(fit(0.0))
    assert fit(5.0).score("you idiot") > 0.7 > fit(5.0).score(None)


def test_toxicity_without_labels(spark, docs):
    model = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs.withColumn("toxicity", F.lit(1)), model).agg(F.min("toxicity_"), F.max("toxicity_")).first() == (0.5, 0.5)


def test_ann_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(20, 16))[rng.integers(0, 20, 1200)] * 2 + rng.normal(size=(1200, 16))).astype(np.float32)
    x[100:500] = x[100]  # a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, [1.0, None] * 8), (None, x[0].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(frame, query=F.col("id") % 50 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    hits = 0
    for q in range(0, 1200, 50):
        s = np.round(u @ u[q], 12)
        s[q] = -9
        hits += len(set(np.lexsort((np.arange(1200), -s))[:5]) & set(got[q]))
    assert set(got) == set(range(0, 1200, 50)) and hits >= 0.9 * 5 * len(got)
    assert got[100][:5] == [101, 102, 103, 104, 105]
    assert ann.search(frame.limit(0), query=F.lit(True)).count() == 0
    few = ann.search(frame.where("vec_id < 3"), query=F.col("id") == 0, k=5)
    assert few.count() == 2


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e308, 5e-324])
def test_ann_scores_of_very_large_and_very_small_vectors(spark, size):
    """Components whose squares aren't doubles: order and scores are those of the vectors at their usual size."""
    x = np.random.default_rng(8).integers(-9, 10, (120, 16)).astype(float)
    x[:, 0] = 1.0
    scale = size / 16 if size > 1 else size
    frame = spark.createDataFrame([(i, (v * scale).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(frame, query=F.col("id") % 50 == 0, k=5).orderBy("query_id", "rank").collect()
    u = x / np.sqrt((x * x).sum(axis=1))[:, None]
    hits = 0
    for q in (0, 50, 100):
        own = [r for r in got if r["query_id"] == q]
        cosine = u @ u[q]
        assert [r["score"] for r in own] == pytest.approx([cosine[r["vec_id"]] for r in own], abs=1e-12)
        cosine[q] = -9
        hits += len({r["vec_id"] for r in own} & set(np.lexsort((np.arange(120), -np.round(cosine, 12)))[:5]))
    assert len(got) == 15 and hits >= 14


def test_warc_round_trip_in_small_ranges(spark):
    rnd = random.Random(9)
    big = "".join(rnd.choice("abcdef<>") for _ in range(200_000))
    rows = [(1, "http://a/ b", "same"), (2, None, "same"), (3, "http://c", None), (4, "u", ""), (5, "u\r\nX: y", big), (None, "u", "same"), (6, "u", "é")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.read(warc.write(frame, work_dir(spark, "w")), range_bytes=300).collect()
    assert len(got) == len(rows) and all(r["intact"] for r in got)
    by = {r["page_id"]: r for r in got}
    assert (by[1]["record_type"], by[1]["refers_to"], by[2]["record_type"], by[3]["refers_to"]) == ("revisit", 2, "response", 4)
    assert by[5]["payload"].decode() == big and by[6]["payload_bytes"] == 2
    assert by[1]["payload_digest"] == base64.b32encode(hashlib.sha1(b"same").digest()).decode()
    assert warc.read(warc.write(frame.limit(0), work_dir(spark, "w"))).count() == 0


def test_warc_scan_passes_false_magic(tmp_path):
    one = warc.record(1, "u", gzip.compress(b"no record") * 3 + warc.MAGIC * 5, "D", None)
    path = tmp_path / "x.warc.gz"
    path.write_bytes(warc.MAGIC * 3 + gzip.compress(b"other") + one + b"junk" + one)
    size = path.stat().st_size
    for step in (1, 7, 64, size):
        found = [r for a in range(0, size, step) for r in warc.read_range(str(path), a, min(a + step, size), size)]
        assert len(found) == 2


def test_mixing(spark, docs):
    assert mixing.weigh(docs.limit(0)).count() == 0
    frame = spark.createDataFrame([(i, "w " * 10, "en" if i % 4 else "de", "a" if i % 3 else None) for i in range(300)], "doc_id long, text string, lang string, source string")
    cells = mixing.weigh(frame).groupBy("lang").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("w")).collect()
    shares = {r["lang"]: r["w"] / 3000 for r in cells}
    assert shares["de"] == pytest.approx(0.25**0.7 / (0.25**0.7 + 0.75**0.7), abs=1e-6)
    assert mixing.sample(frame).columns == frame.columns
    assert zlib.crc32(b"") == 0
