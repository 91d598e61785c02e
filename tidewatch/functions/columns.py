"""Column expressions shared by features, scores and rules. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
MINUTE_US = 60_000_000


def rounded(value: Column, digits: int) -> Column:
    """Half-even rounding of the decimal value.

    The first rounding removes the last bits of floating noise, so the result does not
    depend on the order in which partial sums were merged. Both roundings go through decimals, which takes
    most of the time of a wide row; a value that is no tie is rounded in binary, to the same double.
    """
    exact = F.bround(F.round(value, 10), digits)
    if digits > 6:  # the first rounding could reach a tie
        return exact
    scaled = value * F.lit(10.0 ** digits)
    return F.when(_no_tie(scaled), F.rint(scaled) / F.lit(10.0 ** digits) + F.lit(0.0)).otherwise(exact)


def whole(value: Column) -> Column:
    """The nearest whole number, halves away from 0, as bigint; through decimals only near a tie."""
    return F.when(_no_tie(value), F.rint(value)).otherwise(F.round(value)).cast("bigint")


def _no_tie(value: Column) -> Column:
    """Whether every rounding of `value` to a whole number is the same, binary noise included."""
    return (F.abs(value) < F.lit(1e11)) & (F.abs(F.abs(value - F.rint(value)) - F.lit(0.5)) > F.lit(1e-3))


def finite_or_zero(value: Column) -> Column:
    """Null, NaN and infinities become 0 (NaN compares above every number)."""
    return F.when(F.abs(value) < F.lit(float("inf")), value).otherwise(F.lit(0.0))


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def holds(cond: Column) -> Column:
    """A condition where unknown counts as false."""
    return F.coalesce(cond, F.lit(False))


def share(cond: Column, among: Column | None = None) -> Column:
    """Aggregate: share of rows (of the rows in `among`) for which `cond` holds."""
    hit = holds(cond).cast("double")
    return F.avg(hit if among is None else F.when(among, hit))


def micros(ts: Column | str) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def slice_of(at_us: Column, width_us: int) -> Column:
    """Number of the time slice of `width_us` microseconds; exact for dates before 1970."""
    return ((at_us - F.pmod(at_us, F.lit(width_us))) / F.lit(width_us)).cast("long")


def shannon(total: Column, sum_c_ln_c: Column, distinct: Column) -> Column:
    """Natural-log entropy of counts c with sum `total`, from the sum of c*ln(c)."""
    return F.when(distinct > 1, F.ln(total) - sum_c_ln_c / total).otherwise(F.lit(0.0))


def alert_risk(score: Column) -> Column:
    """Four risk levels, used in alerts."""
    return (F.when(score >= 0.85, "CRITICAL").when(score >= 0.70, "HIGH")
            .when(score >= 0.55, "MEDIUM").otherwise("LOW"))


def response_risk(score: Column) -> Column:
    """Five risk levels, used in score responses."""
    return (F.when(score >= 0.85, "CRITICAL").when(score >= 0.70, "HIGH")
            .when(score >= 0.55, "MEDIUM").when(score >= 0.30, "LOW").otherwise("NORMAL"))


def blend(first: Column, second: Column) -> Column:
    """0.6 / 0.4 blend of two scores."""
    return F.lit(0.6) * first + F.lit(0.4) * second


def minmax_inverted(raw: Column, low: float, high: float) -> Column:
    """`-raw` on the training range [low, high], clipped to [0, 1]."""
    scaled = (-raw - F.lit(low)) / F.lit(high - low + 1e-9)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled))


def top_names(values: Column, names: Sequence[str], k: int = 5) -> Column:
    """Names of the k largest entries of an array; equal values in the order of `names`."""
    paired = F.transform(values, lambda v, i: F.struct(v.alias("v"), (-i).alias("i")))
    best = F.slice(F.sort_array(paired, asc=False), 1, k)
    lookup = F.array(*[F.lit(n) for n in names])
    return F.transform(best, lambda p: F.element_at(lookup, (F.lit(1) - p["i"]).cast("int")))


def merge_names(first: Column, second: Column, k: int = 5) -> Column:
    """Union of two name lists in order of first appearance, cut to k."""
    return F.slice(F.array_distinct(F.concat(first, second)), 1, k)


def features_of_map(feature_map: str, names: Sequence[str]) -> list[Column]:
    """The entries of a map as columns in fixed order; missing, NaN and infinite entries are 0."""
    return [finite_or_zero(F.try_element_at(F.col(feature_map), F.lit(c)).cast("double")).alias(c) for c in names]


def fixed(value: Column, digits: int, grouped: bool = False) -> Column:
    """Number as text with `digits` decimals, thousands commas on request; NaN and null as 'nan'."""
    pattern = ("#,##0" if grouped else "0") + ("." + "0" * digits if digits else "")
    text = F.call_function("format_number", value.cast("double"), F.lit(pattern))
    return F.when(value.isNull() | F.isnan(value.cast("double")), F.lit("nan")).otherwise(text)
