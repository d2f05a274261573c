"""All five stages on hand-made rows, and run() against a plain-Python twin of its stages."""

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from epochal.llm import mixing, quality, toxicity
from epochal.llm.common import work_dir
from epochal.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b + c for a in "bdfg" for b in ("a", "o", "u") for c in ("kel", "lin", "mos", "ner", "tar", "sil")]


def prose(rnd, lines=8, extra=""):
    return "\n".join(" ".join(rnd.choice(WORDS) for _ in range(12)) + extra + "." for _ in range(lines))


@pytest.fixture(scope="module")
def folder(spark):
    """Clean, toxic, copied, nearly copied, rejected, null, repeated and unnamed rows, with clashing columns."""
    rnd = random.Random(11)
    rows = [(None, None), (None, ""), (1, None), (2, ""), (3, "few words"), (4, "word | " * 80)]
    rows += [(i, prose(rnd)) for i in range(10, 60)]
    rows += [(i, prose(rnd, extra=" you idiot")) for i in range(60, 90)]
    texts = dict(rows)
    rows += [(100 + i, texts[i]) for i in range(10, 20)]  # exact copies
    rows += [(200 + i, texts[i].replace(".", " end.", 1)) for i in range(20, 30)]  # near copies
    rows += [(30, texts[30]), (30, texts[30]), (30, prose(rnd)), (None, texts[31]), (None, texts[31])]
    rows += [(300, prose(rnd, 4_000))]
    table = [(i, t, ["en", "de", None][k % 3], ["a", "b"][k % 2], len(t) if t is not None else None) for k, (i, t) in enumerate(rows)]
    path = work_dir(spark, "pipeline-test")
    spark.createDataFrame(table, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(60 <= i < 90)) for i in range(10, 90)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(zip(*[w[i:] for i in range(min(5, len(w)))], strict=False)) if w else frozenset()


def one_of_each_group(rows):
    """Rows that stay: quadratic comparison of sets, the smallest id of each component."""
    sets, root = [shingles(r["text"]) for r in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    best = lambda i: (rows[i]["doc_id"] is None, rows[i]["doc_id"] or 0)
    return sorted((rows[min(g, key=best)]["doc_id"] or -1) for g in groups.values())


def test_stages_against_plain_python(spark, folder):
    stages, held = dict(corpus_pipeline.STAGES), work_dir(spark, "stages")

    def run(name, docs):
        stages[name](spark, docs, folder).write.parquet(f"{held}/{name}")
        return spark.read.parquet(f"{held}/{name}")

    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({"toxicity": F.lit("mine"), "row": F.lit(1), "copies": F.lit(2)})
    columns, ids = docs.columns, lambda f: sorted(r["doc_id"] or -1 for r in f.select("doc_id").collect())
    kept = run("quality", docs)
    judged = [(r["doc_id"], *quality.judge_text(r["text"])) for r in docs.collect()]
    assert kept.columns == columns and ids(kept) == sorted((i or -1) for i, v, _ in judged if v[-1])
    assert sorted(r["text"] for r in kept.collect()) == sorted(t for _, v, t in judged if v[-1])

    calm = run("toxicity", kept)
    model = toxicity.learn(kept, spark.read.parquet(f"{folder}/labels.parquet").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1))
    assert calm.columns == columns and ids(calm) == sorted((r["doc_id"] or -1) for r in kept.collect() if model.score(r["text"]) < 0.7)
    assert not any("idiot" in r["text"] for r in calm.collect())

    alone = run("near_dedup", calm)
    assert alone.columns == columns and ids(alone) == one_of_each_group(calm.collect())
    assert {r["row"] for r in alone.collect()} == {1}

    mixed = run("mixing", alone)
    drawn = {}
    for r in mixing.weigh(alone).collect():
        drawn[r["doc_id"]] = drawn.get(r["doc_id"], 0) + r["drawn"]
    assert mixed.columns == columns and {i: ids(mixed).count(i) for i in set(ids(mixed))} == {i or -1: n for i, n in drawn.items() if n}

    library = Tokenizer.from_file(tokenizer_path())
    texts = {(r["doc_id"], r["source"], r["lang"]): r["text"] for r in mixed.collect()}
    for r in run("bpe", mixed).collect():
        want = library.encode(texts[r["doc_id"], r["source"], r["lang"]], add_special_tokens=False).ids if r["doc_id"] != 30 else r["ids"]
        assert r["ids"] == want and r["n_tokens"] == len(want)


def test_run_and_empty_tables(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "source", "lang", "n_tokens", "ids"] and out.count() > 20
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, folder)
        assert got.count() == 0
