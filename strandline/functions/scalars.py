"""Column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Encounter classes by rank.
CLASSES = ("wellness", "ambulatory", "outpatient", "virtual", "urgentcare", "emergency", "inpatient")
CLINICAL = ("urgentcare", "emergency", "inpatient")


def class_rank(c: Column, unknown: int = 99) -> Column:
    """Rank of an encounter class, ``unknown`` for any other value."""
    out = F.lit(unknown)
    for i, name in enumerate(CLASSES):
        out = F.when(c == name, i).otherwise(out)
    return out


def rank_class(r: Column) -> Column:
    """The class of a rank, else ``unknown``."""
    out = F.lit("unknown")
    for i, name in enumerate(CLASSES):
        out = F.when(r == i, name).otherwise(out)
    return out


def described(text: Column) -> tuple[Column, Column]:
    """Name and type of ``name (type)``; the type is null without a parenthesis."""
    pieces = F.split(text, r"\(")
    return F.trim(pieces[0]), F.replace(F.trim(F.get(pieces, F.lit(1))), F.lit(")"), F.lit(""))


def code_of(text: Column) -> Column:
    """The integer code in decimal text such as ``157265008.0``, exactly; null if it is no number."""
    return text.try_cast("decimal(38,1)").cast("bigint")


def elapsed(unit: str, a: Column, b: Column) -> Column:
    """Whole units from ``a`` to ``b``, truncated."""
    return F.timestamp_diff(unit, a, b)


def age(birth: Column, at: Column, completed: bool = False) -> Column:
    """Year boundaries crossed, or completed years."""
    return F.timestamp_diff("YEAR", birth, at) if completed else F.year(at) - F.year(birth)


def greatest_or_null(*columns: Column) -> Column:
    """The greatest value, null if any is null."""
    missing = reduce(lambda a, b: a | b, [c.isNull() for c in columns])
    return F.when(~missing, F.greatest(*columns))


def flag(condition: Column) -> Column:
    """1 where true, else 0."""
    return F.when(condition, 1).otherwise(0)


def either(*flags: Column) -> Column:
    """1 if any 0/1 flag is 1; nulls count as 0."""
    return F.greatest(*[F.coalesce(f, F.lit(0)) for f in flags])


def suppressed(outcome: Column, planned: Column) -> Column:
    """``outcome``, but 0 where planned is 1; a null plan keeps it."""
    return F.when(planned == 1, 0).otherwise(outcome)


def total_cost(claim: Column, base: Column, *parts: Column) -> Column:
    """The claim or the sum of its parts, whichever is more, to two decimals."""
    return F.round(greatest_or_null(claim, base + sum(parts, F.lit(0))), 2)


def daily_cost(claim: Column, base: Column, start: Column, stop: Column, *parts: Column) -> Column:
    """Cost beyond admission for each day of at least one, to two decimals; halves, as decimal text shows them, go up."""
    cost = greatest_or_null(claim - base, sum(parts, F.lit(0.0))) / F.greatest(elapsed("DAY", start, stop), F.lit(1))
    return F.round(cost.cast("decimal(30,10)"), 2).cast("double")


def intervention_days(p: Column, d: Column) -> Column:
    """Days that lower a risk by ``d`` at ``p`` a day."""
    return F.ceil(F.ln(1 - d) / F.ln(1 - p))


def reached(p: Column, days: Column) -> Column:
    """Reduction that whole days really give."""
    return 1 - F.pow(1 - p, days)
