"""Exact percentiles whose groups may be of any size, by selection on the digits of an order-preserving code.

The built-in exact percentile keeps every distinct value of a group in one aggregation buffer. Here a value becomes a
whole number in the same order (the bits of its floating-point form), and this is read in digits, the highest first. At
each level rows are counted by group and digit, combined before the shuffle; the counts of a group, as many as a digit has
values at most, tell in which digit each wanted rank lies, and only rows with these digits go on. So no task ever sorts,
ranks or holds the rows of a group: a level's work is a scan and counts of bounded number, whatever the values are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a digit: a group has 2 ** DIGIT_BITS counts at most at each level.
DIGIT_BITS = 16


class Code:
    """Floating-point values as whole numbers of the same order, from the fixed layout of IEEE 754: the exponent, biased,
    above the mantissa, and the sign as that of the whole number. -0.0 and 0.0 are one; NaN is the greatest."""

    def __init__(self, mantissa: int, bias: int, bits: int):
        self.mantissa, self.bias, self.bits = mantissa, bias, bits
        self.infinity = (2 * bias + 1) << mantissa

    @classmethod
    def of(cls, kind: T.DataType) -> Code:
        return cls(23, 127, 32) if isinstance(kind, T.FloatType) else cls(52, 1023, 64)

    def encoded(self, df: DataFrame, value: str, code: str) -> DataFrame:
        """`df` with the whole number of a column of doubles."""
        power = lambda e: F.pow(F.lit(2.0), e)
        least, greatest = 2.0 ** (1 - self.bias), (2 - 2.0**-self.mantissa) * 2.0**self.bias
        # held within the normal numbers, so that no case of another kind meets arithmetic that it can't stand
        df = df.withColumn("_size", F.abs(value)).withColumn("_held", F.least(F.greatest("_size", F.lit(least)), F.lit(greatest)))
        df = df.withColumn("_near", F.floor(F.log2("_held")).cast("int"))
        # the logarithm may be off by one next to a power of two; powers of two and divisions by them are exact
        near = F.col("_near")
        exponent = near - F.when(power(near) > F.col("_held"), 1).otherwise(0) + F.when(power(near + 1) <= F.col("_held"), 1).otherwise(0)
        df = df.withColumn("_exponent", exponent)
        fraction = ((F.col("_held") / power(F.col("_exponent")) - 1) * float(1 << self.mantissa)).cast("long")
        normal = (F.col("_exponent") + self.bias).cast("long") * (1 << self.mantissa) + fraction
        # below the least normal number: multiples of the least one there is
        half = (self.bias - 1 + self.mantissa) // 2
        small = (F.least("_size", F.lit(least)) * 2.0**half * 2.0 ** (self.bias - 1 + self.mantissa - half)).cast("long")
        bits = (
            F.when(F.isnan("_size"), F.lit(self.infinity + 1))
            .when(F.col("_size") == float("inf"), F.lit(self.infinity))
            .when(F.col("_size") < least, small)
            .otherwise(normal)
        )
        return df.withColumn(code, F.when(F.col(value) < 0, -bits).otherwise(bits)).drop("_size", "_held", "_near", "_exponent")

    def decoded(self, code: Column) -> Column:
        bits = F.abs(code)
        exponent = F.shiftright(bits, self.mantissa)
        fraction = bits.bitwiseAND(F.lit((1 << self.mantissa) - 1)).cast("double")
        half = (self.bias - 1 + self.mantissa) // 2
        small = fraction / 2.0**half / 2.0 ** (self.bias - 1 + self.mantissa - half)
        normal = (1 + fraction / float(1 << self.mantissa)) * F.pow(F.lit(2.0), (exponent - self.bias).cast("double"))
        size = F.when(bits > self.infinity, float("nan")).when(bits == self.infinity, float("inf")).when(exponent == 0, small).otherwise(normal)
        return F.when(code < 0, -size).otherwise(size)


def percentile_name(p: float) -> str:
    """p50 for 0.5, p99_9 for 0.999."""
    return f"p{p * 100:g}".replace(".", "_")


def measure_statistics(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    probabilities: Sequence[float],
    digit_bits: int = DIGIT_BITS,
) -> DataFrame:
    """Per keys and measure: n, avg, min, max and one linearly interpolated percentile per probability.

    Nulls are left out. Each of the ceil(bits / digit_bits) levels scans `df`: single-precision measures take two levels,
    double precision four. `digit_bits` sets how the work is cut, never the result.
    """
    group = [*keys, "measure"]
    codes = Code.of(T.FloatType() if all(isinstance(df.schema[m].dataType, T.FloatType) for m in measures) else T.DoubleType())
    long_form = [F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]
    long_rows = df.select(*keys, F.inline(F.array(*long_form))).where(F.col("value").isNotNull())
    # one key, so that a null in it equals a null in a plain join too
    rows = codes.encoded(long_rows.select(F.struct(*group).alias("group"), "value"), "value", "code")
    shifts = list(range(0, codes.bits, digit_bits))[::-1]

    digits = rows.groupBy("group", F.shiftright("code", shifts[0]).alias("digit")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("sum"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    whole = digits.groupBy("group").agg(
        F.sum("n").alias("total"), (F.sum("sum") / F.sum("n")).alias("avg"), F.min("min").alias("min"), F.max("max").alias("max"), _in_order("digit").alias("digits")
    )
    ranks = [rank(F.lit(float(p)) * (F.col("total") - 1)).cast("long") for p in probabilities for rank in (F.floor, F.ceil)]
    first = F.transform(F.array(*ranks), lambda r: F.struct(r.alias("rank"), F.lit(0).cast("long").alias("prefix")))
    found = whole.withColumn("at", _narrowed(first, lambda _: F.col("digits"))).drop("digits")

    # always true, but it needs all figures: so both uses of `found` are one and the same shuffle, read twice
    same_shuffle = (F.col("min") <= F.col("max")) & ((F.col("avg") <= float("inf")) | F.isnan("avg"))
    for shift in shifts[1:]:
        wanted = found.where(same_shuffle).select("group", F.explode(F.array_distinct(F.transform("at", lambda a: a["prefix"]))).alias("prefix"))
        # a few prefixes per group: Spark broadcasts them if they are small enough
        inside = rows.withColumn("prefix", F.shiftright("code", shift + digit_bits)).join(wanted, ["group", "prefix"])
        counts = inside.groupBy("group", "prefix", F.shiftright("code", shift).alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        by_group = counts.groupBy("group").agg(_in_order("prefix", "digit").alias("digits"))
        narrowed = _narrowed(F.col("at"), lambda prefix: F.filter("digits", lambda d: d["prefix"] == prefix))
        found = found.join(by_group, "group").withColumn("at", narrowed).drop("digits")

    value_at = lambda i: codes.decoded(F.col("at")[i]["prefix"])
    interpolated = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("total") - 1)
        low, high = value_at(2 * i), value_at(2 * i + 1)
        # equal neighbours need no arithmetic, which would make infinity less infinity of them
        between = F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position)))
        interpolated.append(between.alias(percentile_name(p)))
    return found.select("group.*", F.col("total").alias("n"), "avg", "min", "max", *interpolated)


def _in_order(*digit: str) -> Column:
    """Aggregate: the counts of a group by digit, as many as digits can be."""
    return F.sort_array(F.collect_list(F.struct(*digit, "n")))


def _narrowed(at: Column, digits_of) -> Column:
    """For each rank among the rows of a prefix, the digit that holds it, and its rank among that one's rows."""
    start = lambda a: F.struct(a["rank"].alias("rank"), a["prefix"].alias("prefix"), F.lit(False).alias("done"))

    def step(so_far: Column, d: Column) -> Column:
        here = ~so_far["done"] & (so_far["rank"] < d["n"])
        return F.struct(
            F.when(so_far["done"] | here, so_far["rank"]).otherwise(so_far["rank"] - d["n"]).alias("rank"),
            F.when(here, d["digit"]).otherwise(so_far["prefix"]).alias("prefix"),
            (so_far["done"] | here).alias("done"),
        )

    return F.transform(at, lambda a: F.aggregate(digits_of(a["prefix"]), start(a), step, lambda s: F.struct(s["rank"].alias("rank"), s["prefix"].alias("prefix"))))
