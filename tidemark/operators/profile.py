"""Column profiles from maintained value counts.

Every load adds signed counts ``(scope, load, column, value, n, b)`` to a persistent table: +n rows with a value, b of them breaking the column's form, for the values
it brings, -n and -b where a load is withdrawn or replaced. The counts of a column at any moment are the sums of its
deltas, and every figure of a profile (rows, null share, distinct values, range, median, zeros, broken forms, shares,
entropy) is exact, since it is computed from the counts and not from a sketch.

A value is counted under its text. Values of number columns also have a ``num``, a whole number in their order: integers are their own, decimals count their last digit, floating point numbers are their sign and bits, dates and
timestamps are days and microseconds; minimum, maximum and median are found among these and turned back. Decimals of more than 18 digits are ordered as floating point numbers.

Defined cases: rows whose load is null belong to no load: they count in the state of a table, not among its loads; a null counts as a row with null value; an empty text is a value; an empty load changes nothing; a
column without non-null values has null range, median and shares and entropy 0; NaN is a value above all others, -0.0 is 0.0; repeated rows count each time; columns that aren't
named in the specification are ignored, whatever their names.

Scale: rows are folded map-side into value counts before the only shuffle, so a hot load or value costs no more
than any other. Ranks are found by radix descent over digits of at most 21 bits, so that no window holds over 2^22 rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.runtime import materialise
from tidemark.storage.table import VersionedTable

DIGIT = 21
KEYS = ["scope", "load", "column_name"]


@dataclass(frozen=True)
class ColumnSpec:
    """``kind``: number, category or text. ``breaks``: true where a non-null value breaks the form; may use other columns of the row."""

    name: str
    kind: str = "text"
    breaks: Column | None = None


def form_of(kind: T.DataType) -> str:
    """How ``num`` stands for a value: i, d and the scale, f, D or T."""
    if isinstance(kind, T.DecimalType):
        return f"d{kind.scale}" if kind.precision <= 18 else "f"
    if isinstance(kind, T.DateType):
        return "D"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "T"
    return "f" if isinstance(kind, (T.DoubleType, T.FloatType)) else "i"


def float_order(c: Column) -> Column:
    """A double's sign and bits as a whole number in the order of doubles, read from its exact hexadecimal form."""
    x = c.cast("double") + F.lit(0.0)
    text = F.format_string("%a", F.abs(x))
    normal = F.substring(text, 3, 1) == "1"
    mantissa = F.conv(F.rpad(F.regexp_extract(text, r"\.([0-9a-f]+)p", 1), 13, "0"), 16, 10).cast("bigint")
    power = F.when(normal, F.regexp_extract(text, r"p(-?\d+)$", 1).cast("bigint") + 1023).otherwise(0)
    endless = F.when(F.isnan(x), F.lit(0x7FF8 << 48)).when(F.abs(x) == float("inf"), F.lit(0x7FF << 52))
    bits = F.coalesce(endless, F.shiftleft(power, 52) + mantissa)
    return F.when(x.isNotNull(), F.when((x < 0) & ~F.isnan(x), -bits).otherwise(bits))  # a null's text is "null"


def float_back(num: Column) -> Column:
    bits = F.abs(num)
    power, mantissa = F.shiftright(bits, 52), bits.bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
    size = F.when(power == 2047, F.when(mantissa == 0, float("inf")).otherwise(float("nan"))).when(power == 0, mantissa * F.lit(2.0**-1022)).otherwise((mantissa + 1) * F.pow(F.lit(2.0), (power - 1023).cast("double")))
    return F.when(num < 0, -size).otherwise(size)


def number_of(c: Column, kind: T.DataType) -> Column:
    form = form_of(kind)
    if form == "f":
        return float_order(c)
    if form[0] == "d":
        return (c * F.lit(10 ** kind.scale)).cast("decimal(38,0)").cast("bigint")
    if form in "DT":
        return F.unix_date(c).cast("bigint") if form == "D" else F.unix_micros(c.cast("timestamp"))
    return c.cast("bigint")


def back(num: Column, form: Column) -> Column:
    """The value that ``num`` stands for, as a double; days and microseconds for dates and times."""
    scale = F.pow(F.lit(10.0), F.substring(form, 2, 2).cast("double"))
    return F.when(form == "f", float_back(num)).when(F.substring(form, 1, 1) == "d", num / scale).otherwise(num.cast("double"))


def value_counts(rows: DataFrame, scope: str, load: str, specs: list[ColumnSpec]) -> DataFrame:
    """(scope, load, column_name, form, num, value, n, b) of each load. ``form`` is null for columns that aren't numbers."""
    def item(s: ColumnSpec) -> Column:
        c, kind = F.col(f"`{s.name}`"), rows.schema[s.name].dataType
        broken = F.lit(False) if s.breaks is None else F.coalesce(s.breaks, F.lit(False)) & c.isNotNull()
        number = s.kind == "number"
        text = (c + F.lit(0.0).cast(kind)) if number and isinstance(kind, (T.DoubleType, T.FloatType)) else c
        form, num = (F.lit(form_of(kind)), number_of(c, kind)) if number else (F.lit(None).cast("string"), F.lit(None).cast("bigint"))
        return F.struct(F.lit(s.name).alias("column_name"), form.alias("form"), num.alias("num"), text.cast("string").alias("value"), broken.alias("broken"))

    return (
        rows.select(F.lit(scope).alias("scope"), F.col(load).cast("bigint").alias("load"), F.explode(F.array(*map(item, specs))).alias("x"))
        .groupBy("scope", "load", "x.column_name", "x.form", "x.num", "x.value")
        .agg(F.count("*").alias("n"), F.count_if("x.broken").alias("b"))
    )


COUNTED = [*KEYS, "form", "num", "value"]


class ValueCountStore:
    """The persistent value counts of some tables' columns."""

    def __init__(self, spark: SparkSession, root: str):
        self.table = VersionedTable(spark, root)

    def apply(self, rows: DataFrame, scope: str, load: str, specs: list[ColumnSpec], sign: int = 1) -> int:
        """Adds (or, with sign -1, takes away) the counts of the loads in ``rows``: one atomic commit."""
        return self.apply_deltas([value_counts(rows, scope, load, specs)], sign)

    def apply_deltas(self, deltas: list[DataFrame], sign: int = 1) -> int:
        """Adds (or takes away) the value counts of several tables in one commit."""
        every = deltas[0]
        for d in deltas[1:]:
            every = every.unionByName(d)
        return self.table.append(every.withColumns({"n": F.col("n") * sign, "b": F.col("b") * sign}))

    def withdraw(self, scope: str, loads: list[int]) -> int:
        """Takes stored loads away again without reading their rows."""
        old = self.counts().filter((F.col("scope") == scope) & F.col("load").isin(loads))
        return self.apply_deltas([old], -1)

    def counts(self) -> DataFrame:
        return self.table.read().groupBy(*COUNTED).agg(F.sum("n").alias("n"), F.sum("b").alias("b")).filter("n <> 0 or b <> 0")

    def maintained(self) -> DataFrame:
        """The counts as they are stored; the same as ``counts`` right after ``compact``, without summing again."""
        return self.table.read()

    def compact(self) -> int:
        """Folds all deltas into one count per value."""
        return self.table.overwrite(self.counts(), "compact")


def ranks(counts: DataFrame, keys: list[str], value: str, n: str, targets: DataFrame, bits: int = 63) -> DataFrame:
    """The values at given ranks: (keys, rank, value).

    counts: keys, value and its count; targets: keys and rank (from 1). ``bits``: how many the largest absolute value has.
    The value is found digit by digit from the top: each step sums the counts of one digit below the digits already
    known and picks the first whose running sum reaches the rank.
    """
    steps = max(1, -(-bits // DIGIT))
    digit = max(1, -(-bits // steps))  # steps of even width, so that each leaves few values to the next
    state, top = targets.select(*keys, "rank", F.col("rank").alias("_left"), F.lit(0).cast("bigint").alias("_prefix")), digit * (steps - 1)
    for shift in range(top, -1, -digit):
        part = counts.select(*keys, F.shiftright(value, shift).alias("_digit"), F.col(n).alias("_n")).groupBy(*keys, "_digit").agg(F.sum("_n").alias("_n"))
        above = F.lit(0).cast("bigint") if shift == top else F.shiftright("_digit", digit)  # the top digit has the sign
        hit = part.withColumn("_above", above).join(state.withColumnRenamed("_prefix", "_above"), [*keys, "_above"])
        w = Window.partitionBy(*keys, "rank").orderBy("_digit")
        state = (
            hit.withColumn("_sum", F.sum("_n").over(w))
            .filter((F.col("_sum") >= F.col("_left")) & (F.col("_sum") - F.col("_n") < F.col("_left")))
            .select(*keys, "rank", (F.col("_left") - F.col("_sum") + F.col("_n")).alias("_left"), F.col("_digit").alias("_prefix"))
        )
    return state.select(*keys, "rank", F.col("_prefix").alias("value"))


def load_profile(counts: DataFrame) -> DataFrame:
    """One row per scope, load and column with its figures. ``counts``: one row per value of each, as a compacted store has them.

    min_value, max_value and median are doubles (of dates and times days and microseconds); ``level`` is the median with negative values taken as 0.
    """
    counts, known = counts.filter("load is not null"), F.col("value").isNotNull()
    zero = F.when(F.col("num") == 0, F.col("n")).otherwise(0)
    figures = counts.groupBy(*KEYS).agg(
        F.max("form").alias("form"), F.sum("n").alias("n_rows"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("nulls"), F.sum(F.when(known, 1).otherwise(0)).alias("n_distinct"),
        F.sum("b").alias("broken"), F.sum(zero).alias("zeros"), F.min("num").alias("_low"), F.max("num").alias("_high"), F.sum(F.when(known, F.col("n") * F.log2("n")).otherwise(0.0)).alias("_nlogn"),
    )
    figures = materialise(figures.withColumn("n_known", F.col("n_rows") - F.col("nulls")), "figures")
    top = figures.agg(F.max(F.greatest(F.abs("_low"), F.abs("_high")))).first()[0]
    targets = figures.filter("form is not null and n_known > 0").select(
        *KEYS, F.explode(F.array_distinct(F.array(F.floor((F.col("n_known") + 1) / 2), F.floor((F.col("n_known") + 2) / 2)))).alias("rank")
    )
    middle = ranks(counts.filter("num is not null"), KEYS, "num", "n", targets, int(top or 0).bit_length()).groupBy(*KEYS).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    share = lambda x: F.when(F.col("n_known") > 0, F.col(x) / F.col("n_known"))
    real = lambda c: back(F.col(c), F.col("form"))
    return (
        figures.join(middle, KEYS, "left")
        .withColumns(
            {
                "min_value": real("_low"), "max_value": real("_high"), "median": (real("_lo") + real("_hi")) / 2, "level": (F.greatest(real("_lo"), F.lit(0.0)) + F.greatest(real("_hi"), F.lit(0.0))) / 2,
                "null_share": F.col("nulls") / F.col("n_rows"),
                "broken_share": share("broken"),
                "zero_share": F.when(F.col("form").isNotNull(), share("zeros")),
                "entropy": F.when(F.col("n_known") > 0, F.log2("n_known") - F.col("_nlogn") / F.col("n_known")).otherwise(0.0),
            }
        )
        .drop("_nlogn", "_low", "_high", "_lo", "_hi", "zeros", "broken")
    )


@dataclass(frozen=True)
class Limits:
    """How far a load's figure may be from the median of that figure over all loads of the table."""

    null_share: float = 0.10
    broken_share: float = 0.06
    distinct: float = 0.1
    median_factor: float = 3.0
    zero_share: float = 0.25
    value_share: float = 0.25


EPS = 1e-9


def departures(counts: DataFrame, profile: DataFrame, categories: list[str], limits: Limits = Limits()) -> DataFrame:
    """(scope, load, column_name, reasons) of the columns of loads that depart from the usual state of their table."""
    number = F.col("form").isNotNull()
    shifted = profile.withColumn("_level", F.col("level") + 1)
    usual = shifted.groupBy("scope", "column_name").agg(*(F.median(c).alias(f"_usual_{c}") for c in ("null_share", "n_distinct", "_level", "zero_share")))
    u = lambda c: F.col(f"_usual_{c}")
    far = lambda c, by: F.abs(F.col(c) - u(c)) >= by - EPS
    ratio = F.greatest(F.col("_level") / u("_level"), u("_level") / F.col("_level"))
    tests = {
        "null_share": far("null_share", limits.null_share),
        "form": F.col("broken_share") >= limits.broken_share - EPS,
        "distinct": number & (F.col("n_distinct") <= u("n_distinct") * limits.distinct + EPS) & (u("n_distinct") > 0),
        "median": number & (ratio >= limits.median_factor - EPS),
        "zeros": number & far("zero_share", limits.zero_share),
    }
    reasons = F.array_compact(F.array(*(F.when(t, F.lit(k)) for k, t in tests.items())))
    plain = shifted.join(usual, ["scope", "column_name"]).select(*KEYS, F.explode(reasons).alias("reason"))
    shares = _share_departures(counts, profile, categories, limits.value_share)
    return plain.unionByName(shares).groupBy(*KEYS).agg(F.array_sort(F.collect_set("reason")).alias("reasons"))


def _share_departures(counts: DataFrame, profile: DataFrame, categories: list[str], limit: float) -> DataFrame:
    """A value that a load lacks has share 0 there, both in the median over loads and in the comparison."""
    by = ["scope", "column_name", "value"]
    loads = profile.filter(F.col("column_name").isin(categories) & (F.col("n_known") > 0)).select(*KEYS, "n_known")
    shares = (
        counts.filter(F.col("load").isNotNull() & F.col("column_name").isin(categories) & F.col("value").isNotNull())
        .join(loads, KEYS)
        .select(*KEYS, "value", (F.col("n") / F.col("n_known")).alias("share"))
    )
    total = loads.groupBy("scope", "column_name").agg(F.count("*").alias("loads"))
    seen = shares.groupBy(*by).agg(F.count("*").alias("k"), F.sort_array(F.collect_list("share")).alias("s")).join(total, ["scope", "column_name"])
    # the sorted list is preceded by loads - k zeros
    at = lambda i: F.when(i < F.col("loads") - F.col("k"), F.lit(0.0)).otherwise(F.get("s", (i - F.col("loads") + F.col("k")).cast("int")))
    usual = seen.select(*by, ((at(F.floor((F.col("loads") - 1) / 2)) + at(F.floor(F.col("loads") / 2))) / 2).alias("usual"))
    present = shares.join(usual, by).filter(F.abs(F.col("share") - F.col("usual")) >= limit - EPS)
    # at most 1 / limit values of a column are usual enough to be missed
    expected = loads.join(usual.filter(F.col("usual") >= limit - EPS), ["scope", "column_name"])
    missed = expected.join(shares, [*KEYS, "value"], "left_anti")
    return present.select(*KEYS).unionByName(missed.select(*KEYS)).distinct().withColumn("reason", F.lit("value_share"))


def state_profile(counts: DataFrame) -> DataFrame:
    """The profile of each column of the tables as they now are: all loads together."""
    whole = counts.groupBy("scope", "column_name", "form", "num", "value").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).filter("n <> 0").withColumn("load", F.lit(0).cast("bigint"))
    return load_profile(whole).drop("load")
