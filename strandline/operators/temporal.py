"""Look-back, look-ahead, as-of and interval joins within a key, as windows over event streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400_000_000


def micros(c: str | Column) -> Column:
    """A timestamp as microseconds."""
    return F.unix_micros(F.col(c) if isinstance(c, str) else c)


def _streams(left: DataFrame, left_time: str, right: DataFrame, right_time: str, key: str, payload: list[str]) -> DataFrame:
    """Rows of both sides in one stream: side, at (microseconds), and the right side's payload in a struct."""
    r = right.select(F.col(key), micros(right_time).alias("at"), F.struct(micros(right_time).alias("at"), *payload).alias("event"), *[F.lit(None).cast(left.schema[c].dataType).alias(f"_{c}") for c in left.columns])
    l_ = left.select(F.col(key), micros(left_time).alias("at"), F.lit(None).cast(r.schema["event"].dataType).alias("event"), *[F.col(c).alias(f"_{c}") for c in left.columns])
    return l_.withColumn("mine", F.lit(True)).unionByName(r.withColumn("mine", F.lit(False)))


def _mine(df: DataFrame, left: DataFrame, *columns: Column) -> DataFrame:
    return df.where("mine").select(*[F.col(f"_{c}").alias(c) for c in left.columns], *columns)


def asof_previous(left: DataFrame, left_time: str, right: DataFrame, right_time: str, key: str, payload: list[str]) -> DataFrame:
    """Each left row with ``prev``: the latest right row strictly before it (highest payload on ties).

    A union of both sides and a window replace the range join, so that a key with many rows on
    both sides costs a sort and not their product.
    """
    w = Window.partitionBy(key).orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    s = _streams(left, left_time, right, right_time, key, payload)
    return _mine(s.withColumn("prev", F.max("event").over(w)), left, F.col("prev"))


def asof_next(left: DataFrame, left_time: str, right: DataFrame, right_time: str, key: str, payload: list[str]) -> DataFrame:
    """Each left row with ``next``: the earliest right row strictly after it (lowest payload on ties).

    Time runs backwards in the window, so that its frame only grows.
    """
    w = Window.partitionBy(key).orderBy("back").rangeBetween(Window.unboundedPreceding, -1)
    s = _streams(left, left_time, right, right_time, key, payload).withColumn("back", -F.col("at"))
    return _mine(s.withColumn("next", F.min("event").over(w)), left, F.col("next"))


def _entering(rows: DataFrame, at: str, days: int) -> DataFrame:
    """Each row once with sign 1 when it enters a window of ``days`` whole days, and once with -1 when it leaves it."""
    both = F.array(F.struct(F.lit(1).alias("sign"), F.col(at).alias(at)), F.struct(F.lit(-1).alias("sign"), (F.col(at) + (days + 1) * DAY - 1).alias(at)))
    return rows.withColumn("_turn", F.explode(both)).withColumns({"sign": F.col("_turn.sign"), at: F.col(f"_turn.{at}")}).drop("_turn")


def _window_sums(w, count: str, sums: dict[str, str]) -> dict[str, Column]:
    """Running count and sums of what has entered and not left; sums are null where nothing is in."""
    n = F.coalesce(F.sum("sign").over(w), F.lit(0))
    return {count: n, **{name: F.when(n > 0, F.sum(F.col("sign") * F.col(f"event.{c}")).over(w)) for name, c in sums.items()}}


def look_back(left: DataFrame, left_time: str, right: DataFrame, right_time: str, key: str, days: int, count: str, sums: dict[str, str]) -> DataFrame:
    """Count and sums of the right rows that end up to ``days`` whole days before each left row.

    ``sums`` maps names to columns of the right side. A right row enters the window at its time
    and leaves it when the days are over; running sums over both turns replace a sliding frame,
    so that a key with many rows costs a sort.
    """
    s = _entering(_streams(left, left_time, right, right_time, key, sorted(set(sums.values()))), "at", days)
    s = s.where("not mine or sign = 1").withColumn("sign", F.when(~F.col("mine"), F.col("sign")))
    w = Window.partitionBy(key).orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    made = _window_sums(w, count, sums)
    return _mine(s.withColumns(made), left, *[F.col(n) for n in made])


def around(left: DataFrame, start: str, stop: str, right: DataFrame, key: str, days: int, payload: list[str], count: str, sums: dict[str, str]) -> DataFrame:
    """Each left row with ``prev``, ``next``, count and sums of the right rows around it.

    Both sides have ``start`` and ``stop``. ``prev`` is the latest right row that stops before
    the left one starts, ``next`` the earliest that starts after it stops; count and sums are
    of right rows that stop up to ``days`` whole days before. One stream of both sides on one
    shuffle serves all windows.
    """
    past, ahead = micros(start), micros(stop)
    fields = sorted({*payload, *sums.values()})
    event = lambda at: F.struct(at.alias("at"), *payload, *[c for c in fields if c not in payload])
    r = right.select(F.col(key), ahead.alias("at"), (-past).alias("back"), event(ahead).alias("event"), event(past).alias("coming"), F.lit(False).alias("mine"), *[F.lit(None).cast(left.schema[c].dataType).alias(f"_{c}") for c in left.columns])
    l_ = left.select(F.col(key), past.alias("at"), (-ahead).alias("back"), F.lit(None).cast(r.schema["event"].dataType).alias("event"), F.lit(None).cast(r.schema["coming"].dataType).alias("coming"), F.lit(True).alias("mine"), *[F.col(c).alias(f"_{c}") for c in left.columns])
    s = _entering(r.unionByName(l_), "at", days).where("not mine or sign = 1")
    s = s.withColumns({"sign": F.when(~F.col("mine"), F.col("sign")), "entered": F.when(F.col("sign") == 1, F.col("event")), "coming": F.when(F.col("sign") == 1, F.col("coming"))})
    grown = lambda c: Window.partitionBy(key).orderBy(c).rangeBetween(Window.unboundedPreceding, -1)
    made = {"prev": F.max("entered").over(grown("at")), **_window_sums(grown("at"), count, sums), "next": F.min("coming").over(grown("back"))}
    return _mine(s.withColumns(made), left, *[F.col(n) for n in made])


def count_until(left: DataFrame, left_time: str, right: DataFrame, right_time: str, key: str, name: str) -> DataFrame:
    """How many right rows have a time up to and including the left row's."""
    w = Window.partitionBy(key).orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    s = _streams(left, left_time, right, right_time, key, [])
    return _mine(s.withColumn(name, F.count("event").over(w)), left, F.col(name))


def latest_before(left: DataFrame, left_time: str, right: DataFrame, right_time: str, key: str, name: str) -> DataFrame:
    """The latest right time strictly before each left row."""
    out = asof_previous(left, left_time, right, right_time, key, [])
    return out.withColumn(name, F.timestamp_micros(F.col("prev.at"))).drop("prev")


def active_intervals(events: DataFrame, at: str, plans: DataFrame, start: str, stop: str, key: str, horizon: Column, bucket_days: int = 366, span: tuple | None = None) -> DataFrame:
    """Pairs of events and plans of one key with start < at < stop (dates); an open stop is the horizon.

    Time is cut into buckets: a plan stands in each that it touches, an event in one. Key and
    bucket are joined by equality, so that a key's events meet only the plans of their time. With
    ``span``, the first and last date of the events, a plan stands only in the buckets that have any.
    """
    bucket = lambda c: F.floor(F.unix_date(c) / bucket_days)
    until = F.coalesce(F.col(stop), horizon)
    e = events.withColumn("_bucket", bucket(F.col(at))).alias("e")
    lo, hi = F.col(start), until
    if span is not None:
        first, last = (F.lit(x).cast("date") for x in span)
        plans = plans.where((F.col(start) < last) & (until > first))
        lo, hi = F.greatest(lo, first), F.least(hi, last)
    p = plans.where(F.col(start) <= until).withColumn("_bucket", F.explode(F.sequence(bucket(lo), bucket(hi)))).alias("p")
    inside = (F.col(f"e.{at}") > F.col(f"p.{start}")) & (F.col(f"e.{at}") < F.coalesce(F.col(f"p.{stop}"), horizon))
    same = (F.col(f"e.{key}") == F.col(f"p.{key}")) & (F.col("e._bucket") == F.col("p._bucket"))
    return e.join(p, same & inside).select(*[F.col(f"e.{c}") for c in events.columns], *[F.col(f"p.{c}").alias(f"plan_{c}") for c in plans.columns if c != key]).distinct()
