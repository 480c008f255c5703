"""Column-level building blocks (pure expressions, all whole-stage codegen).

Each function returns a ``Column``; none needs a UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_double(c: str | Column) -> Column:
    """Text -> double; malformed text becomes NULL instead of an ANSI error."""
    return col_of(c).try_cast("double")


def lenient_int(c: str | Column) -> Column:
    """Text -> int; text of a whole number in any notation (``3.0``) counts,
    fractions, junk and numbers beyond an int become NULL."""
    x = lenient_double(c)
    return F.when((x == F.floor(x).cast("double")) & x.between(-2147483648.0, 2147483647.0), x).cast("int")


def money(c: str | Column) -> Column:
    """Text -> amount; NULL also where it is not finite or at least 1e26 in size,
    so that a decimal(38,6) sums more rows than any table holds."""
    x = lenient_double(c)
    return F.when(F.abs(x) < F.lit(1e26), x)


def parse_epoch_date(c: str | Column) -> Column:
    """Parse ``/Date(<ms>[+offset])/`` into a timestamp; sign kept; junk and times
    outside the years 1 to 9999 -> NULL."""
    ms = F.regexp_extract(col_of(c), r"/Date\((-?\d+)", 1).try_cast("bigint")
    return F.timestamp_millis(F.when(ms.between(-62135596800000, 253402300799999), ms))


def days_between(as_of: date, c: str | Column, clip_negative: bool = False) -> Column:
    """Whole days from the timestamp/date ``c`` to ``as_of`` (signed unless clipped)."""
    d = F.datediff(F.lit(as_of), col_of(c))
    return F.greatest(d, F.lit(0)) if clip_negative else d


def pseudonym(c: str | Column, prefix: str = "CUSTOMER_", unknown: str = "CUSTOMER_UNKNOWN") -> Column:
    """``prefix`` + first six hex digits of md5(name), upper case; blank -> ``unknown``."""
    name = col_of(c)
    return (
        F.when(name.isNull() | name.rlike(r"^\s*$"), F.lit(unknown))
        .otherwise(F.concat(F.lit(prefix), F.upper(F.substring(F.md5(name), 1, 6))))
    )


def indicator(cond: Column) -> Column:
    """Boolean condition -> 0/1 int, NULL -> 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def label_lookup(c: str | Column, labels: Mapping[str, str], default: str) -> Column:
    """Dictionary lookup through a literal map; unknown or NULL code -> ``default``."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.coalesce(m[col_of(c)], F.lit(default))


def ros_kernel(amount: str | Column, limits: Sequence[float], bandwidth: float) -> Column:
    """max over limits L of exp(-0.5 * ((x - L) / (bandwidth * L))^2), floored at 0."""
    x = col_of(amount)
    kernels = [F.exp(F.lit(-0.5) * F.pow((x - F.lit(lim)) / F.lit(bandwidth * lim), 2)) for lim in limits]
    # NULL amount -> NULL score (numpy propagates NaN through maximum)
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), *kernels))


def is_round(amount: str | Column, threshold: float) -> Column:
    x = col_of(amount)
    return indicator(((x % F.lit(threshold)) == 0) & (x > 0))


def greatest_of(cols: Sequence[Column]) -> Column:
    """``greatest`` that also accepts a single column (Spark's needs two)."""
    if not cols:
        raise ValueError("greatest_of needs at least one column")
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def nan_to_null(c: str | Column) -> Column:
    """NaN compares greater than every number in Spark; pandas treats it as missing."""
    return F.nanvl(col_of(c).cast("double"), F.lit(None).cast("double"))


MONEY_DECIMAL = "decimal(38,6)"


def money_sum(c: str | Column) -> Column:
    """Exact sum of a money column: accumulated as decimal(38,6), so digits past
    the sixth decimal are rounded, and returned as double; see ``money`` for the
    range of amounts. The total no longer depends on partitioning or summation order, so
    retries and repartitioning cannot change a reported figure."""
    return F.sum(col_of(c).cast(MONEY_DECIMAL)).cast("double")
