"""Operator 3: benchmark decontamination by template windows with typed slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import read, stored

#: First character of a slot token: a name, a number, a unit.
NAME, NUMBER, UNIT = "\x02", "\x03", "\x04"
UNITS = (
    "km", "kilometers", "kilometres", "miles", "mile", "m", "meters", "metres", "cm", "mm", "feet", "foot", "inches", "inch", "yards",
    "kg", "kilograms", "g", "grams", "mg", "tons", "tonnes", "pounds", "lbs", "ounces", "l", "liters", "litres", "ml", "gallons",
    "seconds", "second", "minutes", "minute", "hours", "hour", "days", "day", "weeks", "week", "months", "month", "years", "year",
    "dollars", "dollar", "cents", "euros", "euro", "percent", "degrees", "mph", "kmh", "watts", "volts", "joules",
)
WINDOW, CONTAINED, CONSISTENT = 5, 0.75, 0.5
#: Rows of benchmark windows up to which they are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 500_000


def template(text: Column) -> Column:
    """The text as an array of folded tokens; a slot keeps its value behind its type's mark.

    A number is a run of digits with inner points, commas, colons or slashes; a unit is a listed
    word right after a number; a name is a capitalised word that does not begin a sentence.
    Other punctuation separates tokens. Null gives an empty array.
    """
    t = F.translate(F.coalesce(text, F.lit("")), NAME + NUMBER + UNIT, "   ")
    t = F.regexp_replace(t, r"(?<=[^\s.!?:;][ \t])(\p{Lu}\p{Ll}+)", f"{NAME}$1")
    t = F.regexp_replace(t, r"(?<![\p{L}\p{N}])(\p{N}+(?:[.,:/]\p{N}+)*)(?![\p{L}\p{N}])", f"{NUMBER}$1")
    t = F.regexp_replace(t, rf"({NUMBER}\S*[ \t]?)((?i:{'|'.join(sorted(UNITS, key=len, reverse=True))}))(?![\p{{L}}\p{{N}}])", rf"$1 {UNIT}$2")
    t = F.regexp_replace(F.lower(t), rf"(?:(?<!\p{{N}})[^\p{{L}}\p{{M}}\p{{N}}{NAME}{NUMBER}{UNIT}]+)|(?:[^\p{{L}}\p{{M}}\p{{N}}{NAME}{NUMBER}{UNIT}]+(?!\p{{N}}))|\s+", " ")
    return F.array_remove(F.split(t, " "), "")


def _windows(df: DataFrame, keep: list[str], sizes: list[int]) -> DataFrame:
    """keep columns, size, place, h, slots: every run of tokens of each size of the array column ``tokens``.

    h is a hash of the run's template, slots are its slot tokens. Texts are read once for all sizes.
    """
    longest = max(sizes)
    n = F.greatest(F.size("tokens") - (min(sizes) - 1), F.lit(0))
    runs = F.arrays_zip(*[F.slice("tokens", i + 1, n).alias(f"w{i}") for i in range(longest)])
    rows = df.select(*keep, F.posexplode(runs).alias("place", "w")).select(*keep, "place", *[F.col(f"w.w{i}").alias(f"w{i}") for i in range(longest)])
    parts = [_hashed(size).alias(str(size)) for size in sizes]
    if len(parts) == 1:
        return rows.select(*keep, F.lit(sizes[0]).alias("size"), "place", parts[0].alias("x")).select(*keep, "size", "place", "x.h", "x.slots")
    each = F.array(*[F.when(F.col(f"w{size - 1}").isNotNull(), F.struct(F.lit(size).alias("size"), part.alias("x"))) for size, part in zip(sizes, parts)])
    return rows.select(*keep, "place", F.explode(each).alias("s")).where("s is not null").select(*keep, "s.size", "place", "s.x.h", "s.x.slots")


def _type(word: str) -> Column:
    return F.when(F.substr(word, F.lit(1), F.lit(1)).between(NAME, UNIT), F.substr(word, F.lit(1), F.lit(1)))


def _hashed(size: int) -> Column:
    """h and slots of a run of ``size`` tokens in the columns w0, w1, ..."""
    row = [f"w{i}" for i in range(size)]
    slots = F.filter(F.array(*row), lambda w: F.substr(w, F.lit(1), F.lit(1)).between(NAME, UNIT))
    return F.struct(F.xxhash64(F.lit(size), *[F.coalesce(_type(w), F.col(w)) for w in row]).alias("h"), slots.alias("slots"))


def item_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """item, inner, size, place, h, slots, total: the windows of each item and how many distinct ones it has.

    An item shorter than a window is one window of its own length; one without tokens has none.
    An item comes in two readings: as a text of its own, and within a sentence (``inner``),
    where a capital at its beginning makes a name.
    """
    alone = benchmark.select(F.col(key).alias("item"), F.lit(False).alias("inner"), template(F.col(text)).alias("tokens"))
    within = template(F.concat(F.lit("a "), F.col(text)))
    inner = benchmark.select(F.col(key).alias("item"), F.lit(True).alias("inner"), F.slice(within, 2, F.greatest(F.size(within) - 1, F.lit(0))).alias("tokens"))
    tokens = alone.union(inner).withColumn("own", F.least(F.size("tokens"), F.lit(WINDOW)))
    rows = _windows(tokens, ["item", "inner", "own"], list(range(1, WINDOW + 1))).where("size = own").drop("own")
    total = rows.groupBy(F.col("item").alias("_item"), F.col("inner").alias("_inner")).agg(F.countDistinct("h").alias("total"))
    return rows.join(total, F.col("item").eqNullSafe(F.col("_item")) & (F.col("inner") == F.col("_inner"))).drop("_item", "_inner")


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, contained, slots, consistent, same) for each document that holds an item's template.

    Containment and slots are judged for each occurrence, and the item is held if one of them
    passes. Hits that agree on where the item would begin are one; so that inserted or missing
    words do not cut an occurrence in two, so are hits that begin within an item's length of each
    other (two sets of overlapping spans). Windows that lie further apart or far out of order, each
    with a beginning of its own, are no occurrence, however many a long text has of them.
    """
    items = stored(item_windows(benchmark, item_key, item_text), "item-windows")
    sizes = [r[0] for r in items.select("size").distinct().collect()]  # at most WINDOW values
    few = items.count() <= BROADCAST_ROWS
    tokens = docs.select(F.col(key).alias("doc_id"), template(F.col(text)).alias("tokens"))
    mine = items.select("h", "item", "inner", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"), "total")
    found = _windows(tokens, ["doc_id"], sorted(sizes) or [WINDOW]).join(F.broadcast(mine) if few else mine, "h")
    hits = found.select("doc_id", "item", "inner", "total", "h", "slots", "item_slots", (F.col("place") - F.col("item_place")).alias("begin"))
    # equal windows that begin at one place (of repeated rows) count once, with how often they occur
    hits = stored(hits.groupBy("doc_id", "item", "inner", "total", "h", "slots", "item_slots", "begin").agg(F.count("*").alias("times")), "hits")
    span = F.greatest(F.floor(F.col("total") / 2), F.lit(2)) * 2
    spans = [F.col("begin").cast("long"), F.floor(F.col("begin") / span), F.floor((F.col("begin") + span / 2) / span)]
    place = F.array(*[F.struct(F.lit(k).alias("kind"), at.alias("at")) for k, at in enumerate(spans)])
    hits = hits.select("doc_id", "item", "inner", "total", "h", "slots", "item_slots", "times", F.inline(place))
    one = ["doc_id", "item", "inner", "kind", "at"]
    share = hits.groupBy(*one, "total").agg(F.countDistinct("h").alias("found"))
    share = share.select(*one, (F.col("found") / F.col("total")).alias("contained")).where(F.col("contained") >= CONTAINED)
    pairs = hits.select(*one, "times", F.inline(F.arrays_zip(F.col("item_slots").alias("asked"), F.col("slots").alias("given"))))
    given = pairs.groupBy(*one, "asked", "given").agg(F.sum("times").alias("n"))
    values = given.groupBy(*one, "asked").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.sum(F.when(F.col("asked") == F.col("given"), F.col("n")).otherwise(0)).alias("same"))
    slots = values.groupBy(*one).agg(F.count("*").alias("slots"), (F.sum("most") / F.sum("n")).alias("consistent"), (F.sum("same") / F.sum("n")).alias("same"))
    slots = slots.withColumnsRenamed({c: f"_{c}" for c in one})
    held = share.join(slots, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in one], "left").select(
        *one, "contained", F.coalesce("slots", F.lit(0)).alias("slots"),
        F.coalesce("consistent", F.lit(1.0)).alias("consistent"), F.coalesce("same", F.lit(1.0)).alias("same"),
    ).where(F.col("consistent") >= CONSISTENT)
    best = held.groupBy("doc_id", "item").agg(F.max(F.struct("contained", "same", "consistent", "slots")).alias("best"))
    return best.select("doc_id", F.col("item").alias("item_id"), *[f"best.{c}" for c in ("contained", "slots", "consistent", "same")])


def decontamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Find documents that hold benchmark items, also with other numbers, names and units.

    Texts and items become templates; windows of five template tokens meet in a hash join. An
    item is in a document if 75 % of its windows are. Its slots are then checked: each value of
    the item must mostly stand for one value in an occurrence (``consistent``: the share of slot
    occurrences that follow the most frequent mapping, at least 0.5). One occurrence that passes
    is enough, whatever else the document holds; the most complete one is reported.

    Returns doc_id, item_id, contained, slots, consistent, same (share of equal values) and kind
    (verbatim or reparameterised), one row for each document and item. Null and empty texts hold
    nothing; null keys, of documents and of items, are reported as null; repeated rows count as
    one document; a very long text is read whole, and each place where an item may begin is
    judged for itself; an empty table
    on either side gives an empty result; other columns are ignored. Built from DataFrame
    functions only; documents are not shuffled, only windows that an item has too.
    """
    found = matches(docs, benchmark, key, text, item_key, item_text)
    return found.withColumn("kind", F.when(F.col("same") == 1.0, "verbatim").otherwise("reparameterised"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items."""
    return decontamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {"op3_decontamination": op3_decontamination}
ORACLE: dict[str, str] = {}
