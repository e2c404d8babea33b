"""Row-wise functions of numeric arrays: NaN is a missing value, standard deviations are of the population."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")


def known(v: Column) -> Column:
    return F.filter(v, lambda x: ~F.isnan(x))


def total(v: Column) -> Column:
    return F.aggregate(known(v), F.lit(0.0), lambda s, x: s + x)


def count(v: Column) -> Column:
    return F.size(known(v))


def _or_nan(v: Column, value: Column) -> Column:
    return F.when(F.size(v) > 0, value).otherwise(NAN)


def trimmed(v: Column, part: float = 0.0) -> Column:
    """Known values without floor(part * n) at each end, in order of size where any go."""
    if not part:
        return known(v)
    s = F.array_sort(known(v))
    cut = F.floor(F.size(s) * part).cast("int")
    return F.slice(s, cut + 1, F.greatest(F.size(s) - 2 * cut, F.lit(0)))


def mean(v: Column, trim: float = 0.0) -> Column:
    t = trimmed(v, trim)
    return _or_nan(t, total(t) / F.size(t))


def deviation(v: Column, trim: float = 0.0) -> Column:
    t = trimmed(v, trim)
    squares = F.aggregate(t, F.lit(0.0), lambda s, x: s + x * x)
    return _or_nan(t, F.sqrt(F.greatest(F.lit(0.0), squares / F.size(t) - (total(t) / F.size(t)) * (total(t) / F.size(t)))))


def largest(v: Column) -> Column:
    return F.coalesce(F.array_max(known(v)), F.lit(NAN))


def smallest(v: Column) -> Column:
    return F.coalesce(F.array_min(known(v)), F.lit(NAN))


def absmax(v: Column) -> Column:
    """Of largest and smallest the one of the larger size, the smallest if they tie."""
    return F.when(F.abs(largest(v)) > F.abs(smallest(v)), largest(v)).otherwise(smallest(v))


def place_of(v: Column, value: Column) -> Column:
    """Place of a value from 0."""
    return (F.array_position(v, value) - 1).cast("int")


def quantile(v: Column, q: float) -> Column:
    """By linear interpolation between known values."""
    s = F.array_sort(known(v))
    at = (F.size(s) - 1) * F.lit(q)
    low = F.floor(at).cast("int")
    a, b = F.get(s, low), F.get(s, F.least(low + 1, F.size(s) - 1))
    return _or_nan(s, a + (at - low) * (b - a))


def median(v: Column) -> Column:
    return quantile(v, 0.5)


def cutoff(v: Column, c: float, by: float = 0.0, above: bool = False) -> Column:
    return F.transform(v, lambda x: F.when(x > c if above else x < c, by).otherwise(x))


def test(v: Column, c: float, greater: bool = False, equal: bool = False) -> Column:
    def one(x: Column) -> Column:
        ok = (x > c if greater else x < c) | ((x == c) if equal else F.lit(False))
        return F.when(ok, 1).otherwise(0)

    return F.transform(v, one)


def divide_by_first(v: Column) -> Column:
    first = F.get(v, F.lit(0))
    return F.transform(F.slice(v, F.lit(2), F.greatest(F.size(v) - 1, F.lit(0))), lambda x: x / first)


def fold_changes(v: Column) -> tuple[Column, Column]:
    """Of each element after the first: its change against the first, and against the one before."""
    rest = F.slice(v, F.lit(2), F.greatest(F.size(v) - 1, F.lit(0)))
    before = F.slice(v, F.lit(1), F.greatest(F.size(v) - 1, F.lit(0)))
    first = F.get(v, F.lit(0))
    return F.transform(rest, lambda x: x / first - 1), F.zip_with(rest, before, lambda x, y: x / y - 1)


def exponents(v: Column, base: float) -> Column:
    return F.transform(v, lambda x: F.pow(F.lit(base), x))


def powers(v: Column, p: float) -> Column:
    return F.transform(v, lambda x: F.pow(x, F.lit(p)))


def logs(v: Column, base: float, plus: float = 0.0) -> Column:
    import math

    return F.transform(v, lambda x: F.ln(x + plus) / math.log(base))


def normalised(v: Column, trim: float = 0.0) -> Column:
    """z-scores."""
    m, s = mean(v, trim), deviation(v, trim)
    return F.transform(v, lambda x: (x - m) / s)


def ranged(v: Column) -> Column:
    """From 0 at the smallest to 1 at the largest."""
    lo, hi = smallest(v), largest(v)
    return F.transform(v, lambda x: (x - lo) / (hi - lo))


def ranks(v: Column, scale: bool = False) -> Column:
    """1 to n by size, ties by place; by n if scaled."""
    pairs = F.transform(v, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    order = F.array_sort(pairs)
    r = F.transform(pairs, lambda p: F.array_position(order, p).cast("double"))
    return F.transform(r, lambda x: x / F.size(v)) if scale else r


def histogram(v: Column, low: float, width: float, bins: int, merge: int = 1) -> Column:
    """Counts of values in ``bins`` bins from low on; sums of ``merge`` following bins if more than one."""
    one = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.size(F.filter(v, lambda x: (x >= low + b * width) & (x < low + (b + 1) * width))))
    if merge <= 1:
        return one
    return F.transform(F.sequence(F.lit(1), F.lit(bins - merge + 1)), lambda b: F.aggregate(F.slice(one, b, F.lit(merge)), F.lit(0), lambda s, x: s + x))


def items(v: Column, bins: int) -> Column:
    """A number for each element that is not zero: bins times its place, plus its whole part."""
    return F.transform(F.filter(F.transform(v, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda p: p.x != 0), lambda p: bins * p.i + p.x.cast("long"))


def sparse(v: Column) -> Column:
    """place:value of elements that are neither zero nor missing."""
    pairs = F.filter(F.transform(v, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda p: (p.x != 0) & ~F.isnan(p.x))
    return F.transform(pairs, lambda p: F.concat_ws(":", p.i.cast("string"), p.x.cast("string")))


def slices(v: Column, radius: int, step: int) -> Column:
    """Parts of 2 radius + 1 elements, one each ``step``."""
    wide = 2 * radius + 1
    last = F.size(v) - wide + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.slice(v, s, F.lit(wide)))


def formatted(v: Column, digits: int = 2, sep: str = " ") -> Column:
    return F.array_join(F.transform(v, lambda x: F.format_string(f"%.{digits}f", x)), sep)


# pairs of arrays; places where either is missing do not count ---------------------------------


def _both(a: Column, b: Column) -> Column:
    return F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: ~F.isnan(p.a) & ~F.isnan(p.b))


def _sum(v: Column, f) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, p: s + f(p))


def covariance(a: Column, b: Column) -> Column:
    z = F.zip_with(a, b, lambda x, y: F.struct(x.alias("a"), y.alias("b")))
    z = F.filter(z, lambda p: ~F.isnan(p.a) & ~F.isnan(p.b))
    n = F.size(z)
    return _sum(z, lambda p: p.a * p.b) / n - _sum(z, lambda p: p.a) / n * (_sum(z, lambda p: p.b) / n)


def correlation(a: Column, b: Column) -> Column:
    return covariance(a, b) / F.sqrt(covariance(a, a) * covariance(b, b))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), lambda d: d))


def hamming(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x != y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)


def jaccard(a: Column, b: Column) -> Column:
    """Of the places of elements that are not zero."""
    some = F.zip_with(a, b, lambda x, y: F.when((x != 0) | (y != 0), 1.0).otherwise(0.0))
    both = F.zip_with(a, b, lambda x, y: F.when((x != 0) & (y != 0), 1.0).otherwise(0.0))
    return total(both) / total(some)


def entropy(v: Column) -> Column:
    """In bits, of values as shares of their sum."""
    t = total(v)
    return F.aggregate(F.filter(v, lambda x: x > 0), F.lit(0.0), lambda s, x: s - x / t * F.log2(x / t))


def relative_entropy(a: Column, b: Column) -> Column:
    return _sum(F.filter(F.zip_with(a, b, lambda x, y: F.struct(x.alias("a"), y.alias("b"))), lambda p: (p.a > 0) & (p.b > 0)), lambda p: p.a * F.log2(p.a / p.b))


def chi_square(a: Column, b: Column) -> Column:
    """Of observed a against expected b."""
    return _sum(F.filter(F.zip_with(a, b, lambda x, y: F.struct(x.alias("a"), y.alias("b"))), lambda p: p.b != 0), lambda p: (p.a - p.b) * (p.a - p.b) / p.b)


def length(v: Column) -> Column:
    """The Euclidean norm."""
    return F.sqrt(_sum(known(v), lambda x: x * x))


def variability(v: Column) -> Column:
    """Mean size of the steps between successive elements."""
    n = F.greatest(F.size(v) - 1, F.lit(0))
    steps = F.zip_with(F.slice(v, F.lit(1), n), F.slice(v, F.lit(2), n), lambda x, y: F.abs(y - x))
    return mean(steps)


def smoothed(v: Column, radius: int) -> Column:
    """Means of the elements within radius."""
    return F.transform(v, lambda x, i: mean(F.slice(v, F.greatest(i - radius, F.lit(0)) + 1, F.least(i + radius, F.size(v) - 1) - F.greatest(i - radius, F.lit(0)) + 1)))


# bags: sorted whole numbers ---------------------------------------------------------------------


def parsed(text: Column, sep: str = " ") -> Column:
    return F.transform(F.filter(F.split(text, sep), lambda x: x != ""), lambda x: x.cast("long"))


def is_sorted(v: Column) -> Column:
    return v == F.array_sort(v)


def unique(v: Column) -> Column:
    return F.array_sort(F.array_distinct(v))


def bag(v: Column) -> Column:
    """(value, n) of distinct values."""
    return F.transform(unique(v), lambda x: F.struct(x.alias("value"), F.size(F.filter(v, lambda y: y == x)).alias("n")))


def bag_intersection(a: Column, b: Column) -> Column:
    """Values of both with the copies of both."""
    return F.array_sort(F.concat(F.filter(a, lambda x: F.array_contains(b, x)), F.filter(b, lambda x: F.array_contains(a, x))))


def bag_union(a: Column, b: Column) -> Column:
    return F.array_sort(F.concat(a, b))


def product(v: Column) -> Column:
    return F.aggregate(v, F.lit(1).cast("long"), lambda s, x: s * x)
