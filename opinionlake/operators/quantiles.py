"""Exact quantiles with linear interpolation that do not gather a column in one task.

The built-in ``percentile`` keeps every distinct value of a group in one hash
map.  That is fine when the values come from a small domain (text lengths, token
counts, whole minutes) and is used there (``small_domain=True``).

Free numbers are selected by their bits.  A double is read as a whole number of 64
bits in the same order.  A round counts the rows of all groups by the next 16 bits
behind the prefixes that hold a wanted rank, and each rank moves on to the prefix it
falls into.  So a group, whatever its size, sends at most 65,536 counts of a prefix,
and after four rounds, or as soon as a prefix has a single value, the ranks' values
are known.  All groups take the same steps.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opinionlake.session import stored

DIGIT = 16
_SALTS = 16
_SIGN = -(1 << 63)


def with_ordered_bits(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add the 64 bits of a double as a number that, read without sign, is ordered like the doubles; NaN comes last.

    Each step is a column of its own, so no logarithm or power is taken twice.
    """
    v, two = F.col(value), F.lit(2.0)
    size, near, exponent, bits = (F.col(f"_{part}") for part in ("size", "near", "exponent", "bits"))
    # the logarithm can be off by one next to a power of two
    right = F.when(F.pow(two, near) > size, near - 1).when(F.pow(two, near + 1) <= size, near + 1).otherwise(near)
    whole = (exponent + 1022) * F.lit(1 << 52) + (size / F.pow(two, exponent) * float(1 << 52)).cast("long")
    steps = {
        "_size": F.when(F.isnan(v) | (F.abs(v) == math.inf), 1.0).otherwise(F.abs(v)), "_near": F.floor(F.log2(size)), "_exponent": F.greatest(F.lit(-1022), right),
        "_bits": F.when(F.isnan(v), F.lit((2047 << 52) + 1)).when(F.abs(v) == math.inf, F.lit(2047 << 52)).when(size == 0, F.lit(0)).otherwise(whole),
        name: F.when(v < 0, F.bitwise_not(bits.bitwiseOR(F.lit(_SIGN)))).otherwise(bits.bitwiseOR(F.lit(_SIGN)))}
    for step, column in steps.items():
        df = df.withColumn(step, column)
    return df.drop("_size", "_near", "_exponent", "_bits")


def _prefix(digits: int) -> Column:
    return F.shiftrightunsigned("_b", 64 - DIGIT * digits)


def _cells(rows: DataFrame, by: Sequence[str], digits: int) -> DataFrame:
    """The prefixes met in each group in order, with their rows and extreme values; at most 65,536 of them."""
    counted = rows.groupBy(*by, _prefix(digits).alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    # prefixes are compared without sign
    cell = F.struct(F.col("cell").bitwiseXOR(F.lit(_SIGN)).alias("order"), "cell", "n", "lo", "hi")
    return counted.groupBy(*by).agg(F.array_sort(F.collect_list(cell)).alias("cells"))


def _advance(cells: Column, rank: Column) -> Column:
    """(before, upto, cell): the prefix that holds a rank, and the rows before it and up to its end."""
    none = F.struct(F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("upto"), F.get(cells, F.lit(0)).alias("cell"))

    def step(state: Column, cell: Column) -> Column:
        return F.when(state["upto"] > rank, state).otherwise(
            F.struct(state["upto"].alias("before"), (state["upto"] + cell["n"]).alias("upto"), cell.alias("cell")))

    return F.aggregate(cells, none, step)


def _moved(targets: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Targets with the prefix that their rank falls into."""
    moved = targets.withColumn("at", _advance(F.col("cells"), F.col("rank")))
    return moved.select(*keep, (F.col("rank") - F.col("at.before")).alias("rank"), F.col("at.cell.cell").alias("prefix"),
                        F.col("at.cell.lo").alias("lo"), F.col("at.cell.hi").alias("hi"))


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), small_domain: bool = False) -> DataFrame:
    """One row per group that has values: ``n`` non-null values and ``q``, one quantile per probability.

    The values and, after each round, one row per group and rank are stored below the scratch folder.
    """
    by = list(by)
    base = df.select(*by, F.col(value).cast("double").alias("_v"))
    if small_domain:
        return base.groupBy(*by).agg(
            F.count("_v").alias("n"), F.percentile("_v", F.array(*[F.lit(p) for p in probs])).alias("q")).filter("n > 0")
    keys = [f"_k{i}" for i in range(max(len(by), 1))]
    named = [F.col(c).alias(k) for c, k in zip(by, keys)] or [F.lit(0).alias("_k0")]
    rows = stored(with_ordered_bits(base.filter(F.col("_v").isNotNull()).select(*named, "_v"), "_v", "_b"), "quantiles")

    first = _cells(rows, keys, 1).withColumn("n", F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + c["n"]))
    ranks = [F.struct(F.lit(2 * i + side).alias("i"), turn(F.lit(float(p)) * (F.col("n") - 1)).cast("long").alias("rank"))
             for i, p in enumerate(probs) for side, turn in enumerate((F.floor, F.ceil))]
    targets = first.select("*", F.inline(F.array(*ranks)))
    open_ones = F.col("lo") < F.col("hi")
    state = stored(_moved(targets, [*keys, "n", "i"]), "quantiles")
    for digits in range(2, 64 // DIGIT + 1):
        if not state.filter(open_ones).limit(1).count():
            break
        wanted = state.filter(open_ones).select(*keys, "prefix").distinct()
        met = salted_join(rows.withColumn("prefix", _prefix(digits - 1)), wanted, [*keys, "prefix"], "inner")
        joined = same_group_join(state.filter(open_ones).drop("lo", "hi"), _cells(met, [*keys, "prefix"], digits), [*keys, "prefix"], "inner")
        state = stored(_moved(joined, [*keys, "n", "i"]).unionByName(state.filter(~open_ones)), "quantiles")

    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    value_of = [F.max(F.when(F.col("i") == i, F.col("lo"))) for i in range(2 * len(probs))]
    # equal ends are taken as they are, so infinities stay what they are
    between = [F.when(F.col(f"_{2 * i}") == F.col(f"_{2 * i + 1}"), F.col(f"_{2 * i}")).otherwise(
        F.col(f"_{2 * i}") + (F.col(f"_{2 * i + 1}") - F.col(f"_{2 * i}")) * (p - F.floor(p))) for i, p in enumerate(at)]
    picked = state.groupBy(*keys).agg(F.max("n").alias("n"), *[v.alias(f"_{i}") for i, v in enumerate(value_of)])
    return picked.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "n", F.array(*between).alias("q"))


def salted_join(rows: DataFrame, groups: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Join every row with the one record of its group, null equal to null; a large group's rows are dealt to many tasks."""
    salted = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int"))
    spread = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return same_group_join(salted, spread, [*by, "_salt"], how).drop("_salt")


def group_lookup(rows: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add one record per group to every row of a wide table, null equal to null.

    The records are stored first, so Spark knows their size and keeps the wide rows
    where they are if the records can be broadcast.
    """
    return salted_join(rows, stored(groups, "groups"), by)


def same_group_join(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Join on the group columns, null equal to null; the right group columns are dropped."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in by})
    condition = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in by]
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in by])


def median(df: DataFrame, value: str, by: Sequence[str] = (), small_domain: bool = False) -> DataFrame:
    return quantiles(df, value, [0.5], by, small_domain).select(*by, "n", F.get("q", F.lit(0)).alias("median"))
