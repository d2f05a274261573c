"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Documents are counted into cells (source, language, topic) of tokens. Raking scales the cells to each
marginal in turn; as its result is a product of one factor per category, only the three lists of factors
change: a step sums the cells of each category under the other two factors and divides the target by that.
A cell's weight over its tokens is its documents' expected number of copies, times ``rate``. A document is
drawn as often as the whole part of that, and once more with the rest as its probability (if a number in
[0, 1) made from the md5 of its id is below it). No probability is clipped, so expected shares are the raked
ones, also where they ask for more than each document once; draws are the same wherever and whenever they
happen. A ``rate`` of 1 / the largest copies draws no document twice.

Targets are given as shares per category, or follow the corpus: share ** ``flatten``, scaled to sum to 1,
which lifts rare categories. Categories without a given share get none.

Edge cases: null sources, languages and texts form the category ``(none)``, topic ``none``; texts without words have
weight 0 in their cell, and the cell's copies; equal ids draw equal numbers; clashing extra columns
are kept untouched by ``sample`` and ignored by ``weigh``; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialize, work_dir

MARGINS = ("source", "lang", "topic")
ROUNDS, FLATTEN, RATE, MAX_CELLS = 8, 0.7, 1.0, 100_000
# fixed values: the first pattern that a text holds gives its topic
TOPICS = (
    ("legal", "(?i)licen[sc]e|copyright"),
    ("contact", r"[A-Za-z0-9.]+@[A-Za-z0-9]+\.[a-z]+|[0-9]{3}-[0-9]{4}"),
    ("markup", r"(?:###|%%%|\$\$\$|&&&|\*\*\*)"),
    ("table", r" \| [^|\n]{1,40} \| "),
    ("numeric", "[0-9]{4}"),
)
_WORD = r"[^\x20\x09-\x0D]+"


def topic(text: Column) -> Column:
    out = F.when(text.isNull(), "none")
    for name, pattern in TOPICS:
        out = out.when(text.rlike(pattern), name)
    return out.otherwise("prose")


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) from an id's md5 (of empty text for a null id)."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def drawn(doc_id: Column, copies: Column) -> list[Column]:
    """whole: copies that are certain; probability: that of one more; drawn: how often a document is drawn."""
    whole = F.floor(copies)
    more = copies - whole
    return [whole.alias("whole"), more.alias("probability"), (whole + (draw(doc_id) < more).cast("long")).alias("drawn")]


def described(docs: DataFrame) -> list[Column]:
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(none)")).alias(f"_{c}")
    tokens = F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")
    return [none("source"), none("lang"), topic(F.col("text")).alias("_topic"), tokens.alias("_tokens")]


def corpus_targets(cells: DataFrame, flatten: float) -> dict[str, DataFrame]:
    out = {}
    for m in MARGINS:
        sums = cells.groupBy(m).agg(F.sum("tokens").alias("n")).where("n > 0")
        power = F.pow(F.col("n").cast("double"), F.lit(flatten))
        out[m] = sums.select(m, (power / F.sum(power).over(W.partitionBy())).alias("share"))  # a row for each category
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``factor``: raked share of a cell over its tokens.

    All rounds run in one expression: cells are numbered by category and gathered, once for each marginal, into
    arrays of one row. Such a row holds three short entries a cell, so this is for up to ``MAX_CELLS``; any
    number of cells takes :func:`rake_tables`, which gives the same factors.
    """
    known = cells
    for i, m in enumerate(MARGINS):
        known = known.join(targets[m].where("share > 0").select(m, F.col("share").alias(f"s{i}")), m)
    numbers = {f"i{i}": F.dense_rank().over(W.orderBy(m)) - 1 for i, m in enumerate(MARGINS)}
    known = known.withColumns(numbers)
    others = [[k for k in range(3) if k != i] for i in range(3)]
    sides = []
    for i, (a, b) in enumerate(others):
        entry = F.struct(F.col(f"i{a}").alias("a"), F.col(f"i{b}").alias("b"), F.col("tokens").cast("double").alias("n"), *MARGINS)
        group = known.groupBy(f"i{i}").agg(F.max(f"s{i}").alias("share"), F.array_sort(F.collect_list(entry)).alias("own"))
        listed = F.array_sort(F.collect_list(F.struct(f"i{i}", "share", "own")))  # a category's place is its number
        sides.append(group.agg(listed.alias("side")).select(F.transform("side", lambda g: F.struct(g["share"].alias("share"), g["own"].alias("own"))).alias("side"), F.lit(i).alias("m")))
    row = reduce(DataFrame.unionByName, sides).groupBy().agg(*(F.first(F.when(F.col("m") == i, F.col("side")), True).alias(f"g{i}") for i in range(3)))

    def raked(state: Column, i: int) -> Column:
        """Each category's share over what its cells hold under the other two marginals' factors."""
        a, b = others[i]
        weight = lambda e: e["n"] * F.get(state[f"f{a}"], e["a"]) * F.get(state[f"f{b}"], e["b"])
        holds = lambda g: F.aggregate(g["own"], F.lit(0.0), lambda x, e: x + F.coalesce(weight(e), F.lit(0.0)))
        return F.transform(f"g{i}", lambda g: F.coalesce(F.try_divide(g["share"], holds(g)), F.lit(0.0)))

    def step(state: Column, k: Column) -> Column:
        return F.struct(*(F.when(k % 3 == i, raked(state, i)).otherwise(state[f"f{i}"]).alias(f"f{i}") for i in range(3)))

    start = F.struct(*(F.transform(f"g{i}", lambda g: F.coalesce(g["share"] * 0 + 1, F.lit(1.0))).alias(f"f{i}") for i in range(3)))
    row = row.withColumn("state", F.aggregate(F.sequence(F.lit(0), F.lit(3 * rounds - 1)), start, step))
    a, b = others[0]
    product = lambda e, k: F.get(F.col("state.f0"), k) * F.get(F.col(f"state.f{a}"), e["a"]) * F.get(F.col(f"state.f{b}"), e["b"])
    made = F.transform("g0", lambda g, k: F.transform(g["own"], lambda e: F.struct(*(e[m].alias(m) for m in MARGINS), product(e, k).alias("factor"))))
    factors = row.select(F.inline(F.flatten(made)))
    return cells.join(factors, list(MARGINS), "left").select(*MARGINS, "tokens", F.coalesce("factor", F.lit(0.0)).alias("factor"))


def rake_tables(cells: DataFrame, targets: dict[str, DataFrame], folder: str, rounds: int = ROUNDS) -> DataFrame:
    """The result of :func:`rake` by joins of factor tables, one written table a step: for any number of cells."""
    targets = {m: materialize(t.where("share > 0"), folder, f"target-{m}") for m, t in targets.items()}
    factors = {m: targets[m].select(m, F.lit(1.0).alias(f"f_{m}")) for m in MARGINS}
    for r in range(rounds):
        for m in MARGINS:
            others = [x for x in MARGINS if x != m]
            held = reduce(lambda d, x: d.join(factors[x], x), others, cells)
            sums = held.groupBy(m).agg(F.sum(F.col("tokens") * F.col(f"f_{others[0]}") * F.col(f"f_{others[1]}")).alias("n"))
            new = targets[m].join(sums.where("n > 0"), m).select(m, (F.col("share") / F.col("n")).alias(f"f_{m}"))
            factors[m] = materialize(new, folder, f"factor-{m}-{r}")
    out = reduce(lambda d, m: d.join(factors[m], m, "left"), MARGINS, cells)
    product = reduce(lambda a, b: a * b, [F.coalesce(f"f_{m}", F.lit(0.0)) for m in MARGINS])
    return out.select(*MARGINS, "tokens", product.alias("factor"))


def _expected(own: DataFrame, folder: str, targets: dict[str, DataFrame] | None, rounds: int, flatten: float, rate: float) -> DataFrame:
    """Cells of described documents with the expected copies of each of their documents (``copies``)."""
    cells = own.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("tokens"))
    cells = materialize(cells.select(*(F.col(f"_{m}").alias(m) for m in MARGINS), "tokens"), folder, "cells")
    n_cells, total = cells.agg(F.count("*"), F.sum("tokens")).first()
    targets = targets or corpus_targets(cells, flatten)
    raked = rake(cells, targets, rounds) if n_cells <= MAX_CELLS else rake_tables(cells, targets, folder, rounds)
    # written, so that Spark sees how small it is and need not shuffle the documents
    return materialize(raked.select(*(F.col(m).alias(f"_{m}") for m in MARGINS), (F.col("factor") * (total or 0) * rate).alias("_copies")), folder, "raked")


def weigh(docs: DataFrame, *, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, flatten: float = FLATTEN, rate: float = RATE) -> DataFrame:
    """Per document: doc_id, source, lang, topic, n_tokens, copies (expected), whole, probability, drawn (copies)."""
    folder = work_dir(docs.sparkSession, "mixing")
    own = materialize(docs.select("doc_id", *described(docs)), folder, "described")  # texts are searched once
    out = own.join(_expected(own, folder, targets, rounds, flatten, rate), ["_source", "_lang", "_topic"])
    return out.select(
        "doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
        F.col("_copies").alias("copies"), *drawn(F.col("doc_id"), F.col("_copies")),
    )


def sample(docs: DataFrame, *, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS, flatten: float = FLATTEN, rate: float = RATE) -> DataFrame:
    """The drawn rows of ``docs``, each as often as it is drawn, columns unchanged."""
    folder = work_dir(docs.sparkSession, "mixing")
    own = materialize(docs.select(F.struct(*docs.columns).alias("row"), *described(docs)), folder, "described")
    out = own.join(_expected(own, folder, targets, rounds, flatten, rate), ["_source", "_lang", "_topic"])
    out = out.withColumn("_drawn", drawn(F.col("row.doc_id"), F.col("_copies"))[-1]).where("_drawn > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "_drawn")).alias("_copy")).select("row.*")


def sql(rounds: int = ROUNDS, flatten: float = FLATTEN, rate: float = RATE) -> str:
    """``weigh`` in DuckDB SQL."""
    quoted = lambda p: p.replace("'", "''")
    cases = " ".join(f"WHEN regexp_matches(text, '{quoted(p)}') THEN '{n}'" for n, p in TOPICS)
    parts = [f"""d AS MATERIALIZED (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
  CASE WHEN text IS NULL THEN 'none' {cases} ELSE 'prose' END AS topic,
  coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS n_tokens FROM documents)""",
        "c AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL)"]
    for m in MARGINS:
        parts.append(f"t_{m}0 AS (SELECT {m}, pow(sum(tokens), {flatten}) AS n FROM c GROUP BY {m} HAVING sum(tokens) > 0)")
        parts.append(f"t_{m} AS MATERIALIZED (SELECT {m}, n / (SELECT sum(n) FROM t_{m}0) AS share FROM t_{m}0)")
        parts.append(f"f_{m}_0 AS (SELECT {m}, 1.0::DOUBLE AS f FROM t_{m})")
    last = dict.fromkeys(MARGINS, 0)
    for r in range(1, rounds + 1):
        for m in MARGINS:
            a, b = (x for x in MARGINS if x != m)
            parts.append(f"""f_{m}_{r} AS MATERIALIZED (SELECT t.{m}, any_value(t.share) / sum(c.tokens * a.f * b.f) AS f FROM c
  JOIN f_{a}_{last[a]} a ON a.{a} = c.{a} JOIN f_{b}_{last[b]} b ON b.{b} = c.{b} JOIN t_{m} t ON t.{m} = c.{m} GROUP BY t.{m})""")
            last[m] = r
    joins = " ".join(f"LEFT JOIN f_{m}_{rounds} {m[0]}_ ON {m[0]}_.{m} = d.{m}" for m in MARGINS)
    product = " * ".join(f"coalesce({m[0]}_.f, 0)" for m in MARGINS)
    parts.append(f"e AS (SELECT d.*, {product} * (SELECT sum(tokens) FROM c) * {rate} AS copies FROM d {joins})")
    return f"""WITH {", ".join(parts)}
SELECT doc_id, source, lang, topic, n_tokens, round(copies, 6) AS copies, floor(copies)::BIGINT AS whole, round(copies - floor(copies), 6) AS probability,
  floor(copies)::BIGINT + (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < copies - floor(copies))::BIGINT AS drawn FROM e"""
