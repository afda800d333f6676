"""Aggregate-expression builders (A2-A9, A12, A14) for use inside ``groupBy().agg()``.

Every one of them is a declarative aggregate with a partial (map-side) phase,
so hot groups are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import c_

__all__ = [
    "count_when", "sum_when", "min_when", "max_when", "count_distinct_when", "any_value_det",
    "any_true", "all_true", "quantile", "mode_of", "pick_first", "pick_last", "string_list",
    "weighted_avg", "unique_or_null",
]


def count_when(cond: Column) -> Column:
    """A2: COUNTIF."""
    return F.count_if(cond)


def sum_when(c, cond: Column) -> Column:
    """A2: SUM(IF(cond, c, NULL)); NULL when nothing matched, as in SQL."""
    return F.sum(F.when(cond, c_(c)))


def min_when(c, cond: Column) -> Column:
    return F.min(F.when(cond, c_(c)))


def max_when(c, cond: Column) -> Column:
    return F.max(F.when(cond, c_(c)))


def count_distinct_when(c, cond: Column | None = None) -> Column:
    """A3: exact COUNT(DISTINCT IF(cond, c, NULL))."""
    return F.count_distinct(c_(c) if cond is None else F.when(cond, c_(c)))


def any_value_det(c) -> Column:
    """A4: representative value, made deterministic (min) so results compare."""
    return F.min(c_(c))


def any_true(c) -> Column:
    """A5: LOGICAL_OR."""
    return F.bool_or(c_(c))


def all_true(c) -> Column:
    """A5: LOGICAL_AND."""
    return F.bool_and(c_(c))


def quantile(c, p: float, exact: bool = False, accuracy: int = 10000) -> Column:
    """Percentile. Approximate (mergeable sketch, the scalable default) or exact."""
    if exact:
        return F.percentile(c_(c).cast("double"), F.lit(p))
    return F.percentile_approx(c_(c), p, accuracy)


def mode_of(c) -> Column:
    """Most frequent value, ties broken by the smallest value."""
    return F.mode(c_(c), deterministic=True)


def pick_first(c, by) -> Column:
    """Value at the smallest ``by`` among rows where the value is not NULL."""
    return F.min_by(c_(c), F.when(c_(c).isNotNull(), c_(by)))


def pick_last(c, by) -> Column:
    """Value at the largest ``by`` among rows where the value is not NULL."""
    return F.max_by(c_(c), F.when(c_(c).isNotNull(), c_(by)))


def string_list(c, sep: str = ", ", by=None, distinct: bool = False) -> Column:
    """Ordered delimited list (``by`` defaults to the value itself)."""
    b = c_(by) if by is not None else c_(c)
    item = F.when(c_(c).isNotNull(), F.struct(b.alias("k"), c_(c).cast("string").alias("v")))
    items = F.collect_set(item) if distinct else F.collect_list(item)
    vals = F.transform(F.array_sort(items), lambda x: x["v"])
    if distinct:
        vals = F.array_distinct(vals)
    return F.array_join(vals, sep)


def weighted_avg(x, w) -> Column:
    """sum(x*w)/sum(w), NULL on zero weight."""
    return F.try_divide(F.sum(c_(x) * c_(w)), F.nullif(F.sum(c_(w)).cast("double"), F.lit(0.0)))


def unique_or_null(c) -> Column:
    """The group's value when it has exactly one distinct non-NULL value."""
    return F.when(F.count_distinct(c_(c)) == 1, F.min(c_(c)))
