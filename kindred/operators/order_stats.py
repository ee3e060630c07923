"""Exact order statistics without a global sort.

The value at position i of the sorted column is found in three light passes:
count rows per coarse bucket, find the bucket that holds position i, and count
distinct values inside that bucket only.  A value that fills much of the table
is one row after the partial count, so ties cost nothing.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import accumulate
from operator import or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.sources.staging import cut

BUCKETS = 256
# Rows of a wanted bucket up to which it is not divided further.
ROWS_AT_ONCE = 1_000_000
# The least normal double, and the places at which a 64-bit key is cut into digits of 13 bits (the first of 12).
LEAST_NORMAL = 2.0**-1022
DIGITS = (52, 39, 26, 13, 0)


Positions = Sequence[int] | Callable[[int], Sequence[int]]


def values_at(df: DataFrame, key: str, bucket: str, positions: Positions, finer: Sequence[str] = ()) -> list:
    """Values of ``key`` at the sorted positions (from 0).

    ``positions`` may be a function of the row count.  ``bucket`` must not
    decrease as ``key`` grows.  ``finer`` names columns that divide buckets in turn, each
    also in order of ``key``; large wanted buckets are divided until they are small.  What
    reaches the driver is one count per bucket (of those that are divided) and one value per position.
    """
    sizes = sorted((r[0], r[1]) for r in df.groupBy(bucket).count().collect())
    names = [b for b, _ in sizes]
    ends = list(accumulate(n for _, n in sizes))
    n_rows = ends[-1] if ends else 0
    if callable(positions):
        positions = positions(n_rows)
    if not positions:
        return []
    if max(positions) >= n_rows or min(positions) < 0:
        raise ValueError(f"positions must lie in 0..{n_rows - 1}")
    targets = []
    for position in positions:
        at = bisect_right(ends, position)
        targets.append((names[at], position - (ends[at - 1] if at else 0)))
    held = dict(sizes)
    for column in finer:
        if max(held[name] for name, _ in targets) <= ROWS_AT_ONCE:
            break
        df = df.where(F.col(bucket).isin(sorted({name for name, _ in targets})))
        inner = sorted((r[0], r[1], r[2]) for r in df.groupBy(bucket, column).count().collect())
        divided = {}
        for name, part, n in inner:
            parts = divided.setdefault(name, ([], []))
            parts[0].append(part)
            parts[1].append(n + (parts[1][-1] if parts[1] else 0))
        held = {part: n for _, part, n in inner}
        moved = []
        for name, offset in targets:
            inside, upper = divided[name]
            at = bisect_right(upper, offset)
            moved.append((inside[at], offset - (upper[at - 1] if at else 0)))
        targets, bucket = moved, column

    upto = Window.partitionBy(bucket).orderBy(key)
    inside = (
        df.where(F.col(bucket).isin(sorted({b for b, _ in targets})))
        .groupBy(bucket, key)
        .agg(F.count("*").alias("_n"))
        .withColumn("_end", F.sum("_n").over(upto))
    )
    wanted = reduce(
        or_,
        [
            (F.col(bucket) == b) & (F.col("_end") > offset) & (F.col("_end") - F.col("_n") <= offset)
            for b, offset in sorted(set(targets))
        ],
    )
    rows = sorted((r[0], r[1], r[2]) for r in inside.where(wanted).select(bucket, "_end", key).collect())
    found = {}
    for b, offset in targets:
        found[b, offset] = next(v for name, end, v in rows if name == b and end > offset)
    return [found[t] for t in targets]


def _bucketed(numbers: DataFrame) -> DataFrame:
    """Add ``_bucket`` to ``_key``: ranges between approximate quantiles."""
    fractions = ", ".join(f"{i}D / {BUCKETS}" for i in range(1, BUCKETS))
    sketch = F.expr(f"percentile_approx(_key, array({fractions}), {10 * BUCKETS})")
    splits = numbers.agg(sketch).first()[0] or [0.0]
    edges = [float("-inf"), *sorted(set(splits)), float("inf")]
    return Bucketizer(splits=edges, inputCol="_key", outputCol="_bucket").transform(numbers)


def order_key(number: Column) -> Column:
    """A long in the order of the doubles: sign, then exponent and fraction as the format has them."""
    size = F.abs(number)
    guess = F.floor(F.log2(F.when(size >= LEAST_NORMAL, size).otherwise(1.0)))
    share = size / F.pow(F.lit(2.0), guess)  # the logarithm may be one off
    power = guess + F.when(share >= 2, 1).when(share < 1, -1).otherwise(0)
    fraction = ((size / F.pow(F.lit(2.0), power) - 1) * float(1 << 52)).cast("long")
    normal = (power + 1023).cast("long") * F.lit(1 << 52) + fraction
    infinite = F.lit(2047 << 52)
    far = F.isnan(number) | (size == float("inf"))
    # Divided twice: the least double has no finite inverse.
    tiny = F.when(size < LEAST_NORMAL, size / F.lit(2.0**-537) / F.lit(2.0**-537)).cast("long")
    key = F.when(far, infinite + F.isnan(number).cast("long")).when(size < LEAST_NORMAL, tiny).otherwise(
        F.when(~far & (size >= LEAST_NORMAL), normal)
    )
    return F.when(~F.isnan(number) & (number < 0), -key).otherwise(key)


def grouped_values_at(df: DataFrame, groups: Sequence[str], column: str, positions: Callable[[Column], Column]) -> DataFrame:
    """``(*groups, place, value)``: a group's values at sorted positions (from 0) of a number column.

    ``positions`` turns the number of a group's values into an array of positions; ``place`` counts in it.
    Equal values are counted first.  Where many different values are left, the order-preserving
    key is descended digit by digit: at each digit only the buckets that hold a wanted position are
    divided, and a bucket has at most ``2**13`` parts, whatever the values are.
    """
    value = F.col(column).cast("double")
    counted = cut(df.where(value.isNotNull()).groupBy(*groups, (value + F.lit(0.0)).alias("value")).agg(F.count("*").alias("n")))
    large = counted.count() > ROWS_AT_ONCE
    counted = counted.withColumn("key", order_key(F.col("value")))
    if large:
        counted = cut(counted)
    sizes = counted.groupBy(*groups).agg(F.sum("n").alias("size"))
    targets = sizes.select(*groups, F.lit(0).cast("long").alias("above"), F.posexplode(positions(F.col("size"))).alias("place", "offset"))
    above = F.lit(0).cast("long")
    for shift in DIGITS if large else DIGITS[-1:]:
        if shift != DIGITS[0]:
            targets = cut(targets)
        parts = counted.select(*groups, above.alias("above"), F.shiftright("key", shift).alias("part"), "n")
        if large and shift != DIGITS[0]:
            parts = parts.join(targets.select(*groups, "above").distinct(), [*groups, "above"], "left_semi")
        parts = parts.groupBy(*groups, "above", "part").agg(F.sum("n").alias("n"))
        upto = Window.partitionBy(*groups, "above").orderBy("part")
        parts = parts.withColumn("end", F.sum("n").over(upto))
        targets = (
            targets.join(parts, [*groups, "above"])
            .where((F.col("offset") < F.col("end")) & (F.col("offset") >= F.col("end") - F.col("n")))
            .select(*groups, "place", (F.col("offset") - F.col("end") + F.col("n")).alias("offset"), F.col("part").alias("above"))
        )
        above = F.shiftright("key", shift)
    return targets.withColumnRenamed("above", "key").join(counted, [*groups, "key"]).select(*groups, "place", "value")


def numeric_values_at(df: DataFrame, column: str, positions: Positions) -> list[float]:
    """Values of a number column at sorted positions; one value a position reaches the driver."""
    wanted = list(positions) if not callable(positions) else positions(df.where(F.col(column).isNotNull()).count())
    if not wanted:
        return []
    array = F.array(*(F.lit(p).cast("long") for p in wanted))
    found = {r["place"]: r["value"] for r in grouped_values_at(df, [], column, lambda _: array).collect()}
    if len(found) < len(wanted):
        raise ValueError("positions must lie in the rows that have a value")
    return [found[i] for i in range(len(wanted))]


def digest_values_at(df: DataFrame, key: str, positions: Positions, digits: int = 3) -> list[str]:
    """``values_at`` for a hex digest; its leading digits are even buckets."""
    finer = [f"_bucket_{n}" for n in range(2 * digits, 32, digits)]
    prefixes = [F.substring(key, 1, digits * (i + 2)).alias(c) for i, c in enumerate(finer)]
    keyed = df.select(F.col(key).alias("_key"), F.substring(key, 1, digits).alias("_bucket"), *prefixes)
    return values_at(keyed, "_key", "_bucket", positions, finer)


def with_position(df: DataFrame, column: str, output: str) -> DataFrame:
    """Add the position (from 0) of each row in the order of a distinct number column.

    Buckets follow approximate quantiles; a row's position is the number of rows
    in lower buckets plus its place in its own.
    """
    bucketed = _bucketed(df.withColumn("_key", F.col(column).cast("double")))
    sizes = sorted((r[0], r[1]) for r in bucketed.groupBy("_bucket").count().collect())
    before = dict(zip([b for b, _ in sizes], [0, *accumulate(n for _, n in sizes)], strict=False))
    offset = F.coalesce(*[F.when(F.col("_bucket") == b, F.lit(n)) for b, n in before.items()], F.lit(0))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(column)) - 1
    return bucketed.withColumn(output, (place + offset).cast("long")).drop("_key", "_bucket")
