"""Order-independent content fingerprint and table comparison, in expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def token(frame: DataFrame, name: str) -> Column:
    """A value's exact text: null, or its length and characters; doubles as hexadecimal floats."""
    kind, c = dict(frame.dtypes)[name], F.col(name)
    if kind in ("double", "float"):
        text = F.format_string("%a", c.cast("double"))
    elif kind.startswith("timestamp"):
        text = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    else:
        text = c.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("null"))


def fingerprint(frame: DataFrame) -> DataFrame:
    """One row (fingerprint, n_rows): sums of two 60-bit row hashes, exact in decimals, hashed together.

    Duplicates count, the order of rows and partitions doesn't.
    """
    row = F.concat_ws("\x1f", *(F.concat(F.lit(f"{n}="), token(frame, n)) for n in sorted(frame.columns)))
    digest = F.sha2(row, 256)
    part = lambda start: F.conv(F.substring(F.col("h"), start, 15), 16, 10).cast("decimal(38,0)")
    sums = frame.select(digest.alias("h")).agg(F.sum(part(1)).alias("a"), F.sum(part(16)).alias("b"), F.count("*").alias("n_rows"))
    zero = F.lit(0).cast("decimal(38,0)")
    text = F.concat_ws("|", *(F.coalesce(c, zero).cast("string") for c in ("a", "b")), F.col("n_rows").cast("string"))
    return sums.select(F.sha2(text, 256).alias("fingerprint"), "n_rows")


def table_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(column_name, n_different, n_only_left, n_only_right), null-safe, from one full outer join."""
    columns = [c for c in left.columns if c != key]
    l = left.select(key, *(F.col(c).alias(f"l_{c}") for c in columns), F.lit(1).alias("in_l"))
    r = right.select(key, *(F.col(c).alias(f"r_{c}") for c in columns), F.lit(1).alias("in_r"))
    both = F.col("in_l").isNotNull() & F.col("in_r").isNotNull()
    counts = l.join(r, key, "full").agg(
        F.count_if(F.col("in_r").isNull()).alias("n_only_left"),
        F.count_if(F.col("in_l").isNull()).alias("n_only_right"),
        *(F.count_if(both & ~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))).alias(f"d_{c}") for c in columns),
    )
    named = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"d_{c}").alias("n_different")) for c in columns))
    return counts.select(F.explode(named).alias("x"), "n_only_left", "n_only_right").select("x.column_name", "x.n_different", "n_only_left", "n_only_right")


def ordered_bits(value: Column) -> Column:
    """A double's place among all doubles, as a whole number: neighbours differ by 1, both zeros are 0, NaN has none.

    The bits are read from the hexadecimal text, so everything stays an expression.
    """
    text = F.format_string("%a", F.abs(value))
    lead, digits, power = (F.regexp_extract(text, r"^0x([01])\.([0-9a-f]+)p(-?\d+)$", i) for i in (1, 2, 3))
    field = F.when(lead == "1", power.try_cast("long") + 1023).otherwise(0)
    size = F.when(text == "Infinity", F.lit(2047 * 2**52)).when(lead != "", field * 2**52 + F.conv(F.rpad(digits, 13, "0"), 16, 10).try_cast("long"))
    return F.when(value < 0, -size).otherwise(size)


def table_verdict(left: DataFrame, right: DataFrame, key: str, allowed_ulp: int = 2) -> DataFrame:
    """(column_name, n_different, max_ulp, n_beyond, n_only_left, n_only_right, kind): all columns of two tables by key.

    Cells differ where they aren't equal (nulls equal each other, and so do NaNs). Two doubles that differ are
    ``max_ulp`` representable steps apart at most, and count in ``n_beyond`` if that is more than ``allowed_ulp``; so does
    every other difference. ``kind`` is ``equal``, ``serialisation`` (only steps that are allowed) or ``content``; rows
    on one side only make every column's kind ``content``. Columns of one side only are refused, and so are keys that
    are null or repeated, as their rows can't be told apart.
    """
    if set(left.columns) != set(right.columns) or dict(left.dtypes) != dict(right.dtypes):
        raise ValueError("the tables have different columns or types")
    refused = F.raise_error(F.lit(f"null or repeated {key}")).cast("int")
    kinds, columns = dict(left.dtypes), [c for c in left.columns if c != key]
    pack = lambda f, side: f.groupBy(key).agg(F.first(F.struct(*columns)).alias(side), F.count("*").alias(f"n_{side}"))
    both = pack(left, "l").join(pack(right, "r"), key, "full")
    once = F.when(F.col(key).isNull() | (F.coalesce("n_l", F.lit(0)) > 1) | (F.coalesce("n_r", F.lit(0)) > 1), refused).otherwise(1)
    out = []
    for c in columns:
        l, r = F.col("l")[c], F.col("r")[c]
        off = F.col("n_l").isNotNull() & F.col("n_r").isNotNull() & ~l.eqNullSafe(r)
        steps = F.lit(None).cast("decimal(20,0)")
        if kinds[c] == "double":  # the texts of doubles are only made where they differ
            steps = F.when(off, F.abs(ordered_bits(l).cast("decimal(20,0)") - ordered_bits(r).cast("decimal(20,0)")).cast("decimal(20,0)"))
        beyond = off & ~F.coalesce(steps <= allowed_ulp, F.lit(False))
        out.append(F.struct(F.lit(c).alias("column_name"), F.count_if(off).alias("n_different"), F.max(steps).alias("max_ulp"), F.count_if(beyond).alias("n_beyond")))
    sides = [F.count_if(F.col("n_r").isNull()).alias("n_only_left"), F.count_if(F.col("n_l").isNull()).alias("n_only_right")]
    counts = both.agg(F.sum(once).alias("_checked"), *sides, F.array(*out).alias("x"))
    flat = counts.where("_checked >= 0 or _checked is null").select(F.explode("x").alias("x"), "n_only_left", "n_only_right").select("x.*", "n_only_left", "n_only_right")
    kind = F.when(F.col("n_beyond") + F.col("n_only_left") + F.col("n_only_right") > 0, "content").when(F.col("n_different") > 0, "serialisation").otherwise("equal")
    return flat.withColumn("kind", kind)


def score_parity(left: DataFrame, right: DataFrame, key: str, score: str) -> DataFrame:
    both = left.select(key, F.col(score).alias("a")).join(right.select(key, F.col(score).alias("b")), key, "full")
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("n_missing"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_difference"))


def mismatches(found: DataFrame, wanted: DataFrame, by: str, key: str, tolerance: float = 1e-6) -> DataFrame:
    """(by, n_found, n_wanted, n_missing, n_extra, n_different): two tables' rows by (``by``, ``key``), over the columns of ``wanted``.

    Doubles differ beyond ``tolerance``, all else where it isn't equal (nulls equal each other). A key that is repeated
    on a side counts as one that differs, or, alone there, as missing or extra; null keys match nothing.
    """
    kinds, columns = dict(wanted.dtypes), [c for c in wanted.columns if c not in (by, key)]
    pack = lambda f, side: f.groupBy(by, key).agg(F.first(F.struct(*columns)).alias(side), F.count("*").alias(f"n_{side}"))
    both = pack(found, "l").join(pack(wanted, "r"), [by, key], "full")
    off = [(F.col("l")[c] - F.col("r")[c]).between(-tolerance, tolerance) if kinds[c] == "double" else F.lit(False) for c in columns]
    wrong = reduce(lambda a, b: a | b, (~(F.col("l")[c].eqNullSafe(F.col("r")[c]) | F.coalesce(near, F.lit(False))) for c, near in zip(columns, off, strict=True)), F.lit(False))
    l, r = F.coalesce("n_l", F.lit(0)), F.coalesce("n_r", F.lit(0))
    return both.groupBy(by).agg(F.sum(l).alias("n_found"), F.sum(r).alias("n_wanted"), F.count_if(l == 0).alias("n_missing"), F.count_if(r == 0).alias("n_extra"), F.count_if((l > 0) & (r > 0) & (wrong | (l > 1) | (r > 1))).alias("n_different"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
