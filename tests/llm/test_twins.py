"""Plain-Python twins of the queries without SQL, repeated rows and damaged input."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from epochal.llm import ann, bpe, language_id, quality, queries, token_store, toxicity, url_filter, warc
from epochal.llm.common import work_dir

SMALL = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_token_store_equals_the_library(spark, tmp_path):
    """Every document of a table, and null, empty, repeated, long and odd texts: start, ids and crc of the library's ids."""
    library = Tokenizer.from_file(queries.tokenizer_path())
    library.no_truncation()
    library.no_padding()
    rnd = random.Random(2)
    odd = [(-3, None), (-2, ""), (-1, "é<|endoftext|>\x1c中 İ"), (-1, "é<|endoftext|>\x1c中 İ"), (10**12, " ".join(str(rnd.random()) for _ in range(20_000)))]
    rows = sorted([*odd, *((r["doc_id"], r["text"]) for r in documents(spark).collect())], key=lambda r: (r[0], r[1] or ""))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("start", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.op7_token_store(spark, f"file://{tmp_path}").collect())
    want, at = [], 0
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert got == sorted(want)


def test_token_store_tells_wrong_keys_apart_and_grows_by_text(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "doc_id long, text string")
    store = token_store.write_store(docs, queries.tokenizer_path(), work_dir(spark, "t"), end_id=1, vocabulary=49_408, shards=3)
    assert store.locate(spark.range(250, 400).withColumnRenamed("id", "doc_id")).count() == 50
    assert token_store.shard_count(docs, 2, shard_bytes=100) == -(-sum(len(f"text {i}") for i in range(300)) // 100)


def test_token_store_holds_one_encoder_a_core(spark, tmp_path):
    """No stage runs two Python functions, which are two workers a task that both come to hold an encoder; it has no unused tables."""
    documents(spark).limit(3).write.parquet(f"{tmp_path}/documents.parquet")
    plan = queries.op7_token_store(spark, f"file://{tmp_path}")._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "ArrowEvalPython" not in plan
    coder = bpe.LibraryBpe(queries.tokenizer_path())
    assert not hasattr(coder, "automaton") and not hasattr(coder, "cut")


def test_library_words_are_cut_as_by_the_library():
    """Letters alone take a short way: every letter below U+2100 in words, alone, doubled and beside its neighbours."""
    library, coder = Tokenizer.from_file(queries.tokenizer_path()), bpe.LibraryBpe(queries.tokenizer_path())
    assert coder.whole_letters
    letters = [chr(c) for c in range(0x21, 0x2100)]
    for text in (f(c) for c in letters for f in (str, lambda c: f"a{c}B", lambda c: c + c, lambda c: f"É{c}'s{c}")):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def out_of_place(text, profiles, top=300):
    """Nearest profile by the rank-order distance, counted in dictionaries."""
    letters = "".join(c.lower() if len(c.lower()) == 1 else c for c in "".join(c if c.isalpha() else " " for c in text or ""))
    counts = {}
    for word in letters.split():
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram.strip():
                    counts[gram] = counts.get(gram, 0) + 1
    code = lambda g: sum((1 if c == " " else ord(c)) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    own = [g for _, g in sorted((-n, code(g)) for g, n in counts.items())][:top]
    if not own:
        return "und", 0.0
    away = {lang: sum(abs(p[g] - i) if g in p else top for i, g in enumerate(own)) for lang, p in profiles.items()}
    best = min(away, key=lambda lang: (away[lang], lang))
    return best, 1 - away[best] / (top * len(own))


def test_language_equals_a_plain_predictor(spark):
    docs = documents(spark).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    counts = {}
    for r in docs:
        if not held(r["doc_id"]) and r["lang"] is not None:
            own = counts.setdefault(r["lang"], {})
            for gram, n in zip(*map(list, language_id.ngram_counts(r["text"])), strict=True):
                own[int(gram)] = own.get(int(gram), 0) + int(n)
    profiles = {lang: {g: i for i, (_, g) in enumerate(sorted((-n, g) for g, n in c.items())[:300])} for lang, c in counts.items()}
    got = {r["doc_id"]: r for r in queries.op8_language(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for r in docs:
        lang, score = out_of_place(r["text"], profiles)
        g = got[r["doc_id"]]
        assert (g["held_out"], g["lang_pred"]) == (held(r["doc_id"]), lang) and g["score"] == pytest.approx(score)


def test_language_ties_long_texts_and_extra_columns(spark):
    rows = [(1, "aa bb", "x"), (2, "aa bb", "w"), (3, "zz " * 200_000, "y"), (4, "aa bb", None), (4, "aa bb", None), (5, "", "w"), (6, "42", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit("mine"), "lang_pred": F.lit(0)})
    profiles = language_id.profile_arrays(language_id.learn(frame))
    got = [(r["doc_id"], r["lang_pred"]) for r in language_id.predict(frame, profiles).collect()]
    assert sorted(got) == [(1, "w"), (2, "w"), (3, "y"), (4, "w"), (4, "w"), (5, "und"), (6, "und")]
    with pytest.raises(ValueError, match="more than 2 languages"):
        language_id.profile_arrays(language_id.learn(frame), max_languages=2)


def test_toxicity_equals_an_independent_fit(spark):
    """The picked words by their z-scores, and the optimum of the penalised loss as a plain gradient method finds it."""
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(240):
        bad = int(i % 3 == 0)
        rows.append((i, " ".join(rnd.sample(vocabulary, 6) + ["idiot"] * (bad and rnd.random() < 0.8) + ["women"] * (rnd.random() < (0.6 if bad else 0.2))), bad))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(5, None), (1000, "no label")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows] + [(7, 9), (None, 1), (5000, 1)], "doc_id long, toxic int").where("doc_id <> 5")
    model = toxicity.learn(docs, labels, features=20, min_texts=3, l1=0.002, swap=2.0, rounds=3000)

    rows = [r for r in rows if r[0] != 5]
    sets, y = [set(t.split()) for _, t, _ in rows], np.array([b for *_, b in rows], float)
    pos, neg = y.sum(), len(y) - y.sum()
    score = {}
    for w in set().union(*sets):
        has = np.array([w in s for s in sets])
        p = has.mean()
        if has.sum() >= 3:
            score[w] = abs(has[y == 1].sum() / pos - has[y == 0].sum() / neg) / np.sqrt(max(p * (1 - p), 1e-12) * (1 / pos + 1 / neg))
    numbers = {w: int(toxicity._numbers([w])[0]) for w in score}
    top = sorted(score, key=lambda w: (-score[w], np.int64(np.uint64(numbers[w]).view(np.int64))))[:20]
    words = sorted({*top, *(t for g in toxicity.IDENTITY for t in g)})
    x = np.array([[float(w in s) for w in words] for s in sets])
    at = {w: i for i, w in enumerate(words)}
    pairs = [(at[t], at[o]) for s in sets for g in toxicity.IDENTITY for t in g if t in s for o in g if o != t and o not in s]
    pull = np.zeros((len(words), len(words)))  # gradient of the swap penalty, 2 * mean squared change
    for gone, come in pairs:
        step = np.zeros(len(words))
        step[gone], step[come] = 1, -1
        pull += 2 * 2.0 / len(pairs) * np.outer(step, step)
    weight, w, b = np.where(y == 1, 0.5 / pos, 0.5 / neg), np.zeros(len(words)), 0.0
    for _ in range(100_000):  # proximal gradient, without momentum
        r = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
        g = x.T @ r + pull @ w
        new = w - 0.1 * g
        w, b = np.sign(new) * np.maximum(np.abs(new) - 0.1 * 0.002, 0), b - 0.1 * r.sum()
    for text in ("idiot", "women", "men w3", "nothing known", "idiot women w1 w2", None):
        own = b + sum(w[at[t]] for t in set((text or "").split()) if t in at)
        assert model.score(text) == pytest.approx(1 / (1 + np.exp(-own)), abs=0.01)


def test_toxicity_of_empty_tables_and_nulls(spark):
    frame = spark.createDataFrame([(1, None), (None, ""), (2, "x")], "doc_id long, text string")
    model = toxicity.Model(-1.0, {})
    assert toxicity.score(frame.limit(0), model).count() == 0
    assert {round(r["toxicity"], 6) for r in toxicity.score(frame, model).collect()} == {0.268941}


def test_neighbours_with_repeated_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(12, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(7, x[7].tolist())] * 12 + [(3, x[0].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"score": F.lit("mine"), "rank": F.lit("r")})
    got = [(r["rank"], r["vec_id"]) for r in ann.search(frame, query=F.col("id") == 0, k=5).orderBy("rank").collect()]
    best = {}
    for i, v in rows:
        if i:
            best[i] = max(best.get(i, -9), float(ann.exact_scores(x[0], np.array([v]))[0]))
    assert got == [(r, i) for r, i in enumerate(sorted(best, key=lambda i: (-best[i], i))[:5], 1)]
    all_of_them = ann.search(frame, query=F.col("id") == 0, k=50).collect()
    assert sorted(r["vec_id"] for r in all_of_them) == list(range(1, 12))


def test_neighbours_of_many_repeated_rows(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x) for _ in range(1 + 40 * (i % 100 == 7))]
    got = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), query=F.col("id") % 50 == 0, k=5).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    found = 0
    for q in range(0, 400, 50):
        s = u @ u[q]
        s[q] = -9
        assert len(got[q]) == 5
        found += len(got[q] & set(np.argsort(-s)[:5]))
    assert found >= 0.9 * 40


def test_damaged_and_foreign_records(tmp_path):
    member = lambda text: (lambda z: z.compress(text) + z.flush())(zlib.compressobj(6, zlib.DEFLATED, 31))
    good = warc.record(1, "u", b"x", "D", None)
    bad = [
        member(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: many\r\n\r\nbody"),
        member(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nok"),
        member(b"WARC/1.1\r\nWARC-Type: response"),
        member(b"WARC/1.1\r\nWARC-Type: response\r\nX-Payload-Length: -3\r\nContent-Length: 0\r\n\r\n"),
        good[: len(good) // 2],
    ]
    foreign = member(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:x>\r\nContent-Length: 2\r\n\r\nok")
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join([*bad, good, foreign, *bad, good]))
    found = [r for a in range(0, path.stat().st_size, 50) for r in warc.read_range(str(path), a, min(a + 50, path.stat().st_size), path.stat().st_size)]
    assert [warc._page(r["warc-record-id"]) for r in found] == [1, None, 1]
    assert warc._page("<urn:page:99999999999999999999>") is None


def test_warc_ties_and_clashing_columns(spark):
    rows = [(5, "u", "same"), (5, "v", "same"), (4, "w", "same"), (None, "n", "same"), (1, "u", None), (2, "u", ""), (3, "u", "alone")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "first": F.lit(2), "payload": F.lit(3)})
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in warc.read(warc.write(frame, work_dir(spark, "w"))).collect())
    assert got == [(0, "revisit", 5), (1, "revisit", 2), (2, "response", 0), (3, "response", 0), (4, "revisit", 5), (5, "response", 0), (5, "response", 0)]
    short = sorted(r["record_type"] for r in warc.read(warc.write(frame, work_dir(spark, "w"), min_bytes=1)).collect())
    assert short.count("revisit") == 2  # empty payloads are all responses


def test_url_filter_on_empty_long_and_repeated(spark):
    rows = [(1, "http://a.net/" + "x" * 100_000 + "/porn/"), (1, "http://a.net/q"), (1, "http://a.net/q"), (None, "http://casino.net/poker")]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    got = sorted((r["page_id"] or 0, r["verdict"]) for r in url_filter.judge(frame).collect())
    assert got == [(0, "block"), (1, "allow"), (1, "allow"), (1, "block")]
    assert url_filter.judge(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("line", "rule"),
    [("Alle Rechte vorbehalten 2020.", "boilerplate"), ("Nous utilise des cookies ici.", "boilerplate"), ("Leer más.", "navigation"), ("Back to top.", "navigation"),
     ("Home | About | Contact.", "labels"), ("no mark at the end", "punctuation"), ("# $ % a b c.", "symbols")],
)
def test_each_line_rule_decides(line, rule):
    n = len(line.split())
    assert not quality.line_passes(line, n), rule
    assert quality.line_passes("A plain sentence that ends well.", 6) and quality.line_passes(line, 0)


def test_quality_counts_ties_long_texts_and_clashing_columns(spark):
    text = "one two three four.\none two three four.\n\n" + "word " * 60 + "."
    rows = [(1, text), (1, text), (2, None), (3, " ".join(f"w{i}" for i in range(200_000)) + ".")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"kept": F.lit("mine"), "n_words": F.lit(-1)})
    got = sorted(tuple(r) for r in quality.judge(frame).collect())
    # 9 words in repeated windows of the two equal lines (8) and the run of one word
    assert got[0] == got[1] and got[0][:6] == (1, 69, 16 * 2 + 60 * 4 + 1, 0, 1, 68) and got[0][6]
    assert got[2] == (2, 0, 0, 0, 0, 0, True, False) and got[3][1:] == (200_000, got[3][2], 0, 0, 0, False, True)
    assert [r["kept"] for r in quality.clean(frame).collect()] == ["mine"]


def test_words_decide_where_no_rule_fits(spark):
    urls = ["http://a.net/porn/", "http://a.net/casino-bonus/poker", "http://a.net/casino/casino", "http://apotheke.net/viagra", "http://a.net/sexton-adulthood", "http://x.org/porn/"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"], r["n_strict"], r["n_soft"]) for r in url_filter.judge(frame).collect()}
    assert got == {0: (None, "block", 1, 0), 1: (None, "block", 0, 2), 2: (None, "allow", 0, 1), 3: (None, "block", 0, 2), 4: (None, "allow", 0, 0), 5: ("org/", "allow", 1, 0)}
