"""Operator 13: repair of conversations by the cheapest path through a lattice of edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm import edit_lattice as L
from strandline.llm.common import in_batches, read, stored

#: What trails a text's last character: the spaces 20 and 09-0D.
_SPACES = " \t\n\x0b\f\r"
#: Rows and bytes of a conversation up to which one task holds it whole.
ROWS, BYTES = 4096, 16_000_000
COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long"
REPAIR = "conv_id {kind}, " + COUNTS + ", cost long, audit string, repaired_sha256 string"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage of the contract, and ``gone`` for rows that it drops."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("fault") == 0).alias("gone"), F.explode(copies).alias("copy"))


def prepared(rows: DataFrame) -> DataFrame:
    """Adds ``h``, a digest of role and text that also orders rows of one turn, and ``last``, the text's last character that is no space ('': blank)."""
    h = F.unhex(F.substring(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 32))
    return rows.withColumns({"h": h, "last": F.right(F.rtrim("text", F.lit(_SPACES)), F.lit(1))})


def _order(*first: str) -> list[Column]:
    return [*(F.col(c).asc_nulls_first() for c in (*first, "turn")), F.col("role"), F.col("h"), F.col("copy")]


def _ended(last: str) -> bool:
    return last in (".", "!", "?")


def code(role: str, fault: str) -> str:
    """A row's code in the lattice; ``fault`` is blank, duplicate, truncated or empty."""
    if fault in ("blank", "duplicate"):
        return "d"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial.upper() if fault == "truncated" else initial


@dataclass
class Tally:
    """What is counted of rows that come in order; two tallies of neighbouring rows can be added."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    latest: str | None = None
    turns: int = 0
    least: int | None = None
    most: int | None = None
    codes: list[str] = field(default_factory=list)

    def add(self, turn: int | None, role: str, fault: str) -> None:
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if self.latest is None:
            self.first = role[:1]
        else:
            self.illegal += self.latest + role[:1] not in ("su", "ua", "au")
        self.latest = role[:1]
        if turn is not None and turn != self.most:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.most = turn
        self.codes.append(code(role, fault))

    def follow(self, o: Tally) -> None:
        """Add the tally of the rows that come next."""
        if o.latest is None:
            return
        if self.latest is not None:
            self.illegal += self.latest + o.first not in ("su", "ua", "au")
        self.illegal += o.illegal
        for name in ("blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + getattr(o, name))
        self.first, self.latest = o.first if self.first is None else self.first, o.latest
        if o.least is not None:
            self.turns += o.turns - (o.least == self.most)
            self.least = o.least if self.least is None else self.least
            self.most = o.most

    @property
    def counts(self) -> tuple[int, ...]:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches in pieces of one batch and one key, the first ``keys`` columns; a key's pieces follow each other."""
    for b in batches:
        columns = [c.to_pylist() for c in b.columns]
        key, first = None, 0
        heads = list(zip(*columns[:keys]))
        rows = list(zip(*columns[keys:]))
        for i, k in enumerate(heads):
            if i and k != key:
                yield key, rows[first:i]
                first = i
            key = k
        if heads:
            yield key, rows[first:]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Whole groups of sorted batches by their first column."""
    now, held, some = None, [], False
    for (key,), rows in _runs(batches, 1):
        if some and key != now:
            yield now, held
            held = []
        now, some = key, True
        held.extend(rows)
    if some:
        yield now, held


def _digest(turns: Iterator[str], sha=None, many: int = 0) -> tuple:
    sha = hashlib.sha256() if sha is None else sha
    for t in turns:
        sha.update((b"\n" if many else b"") + t.encode())
        many += 1
    return sha, many


def _whole(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Repairs conversations that a task can hold: conv_id, turn, role, text, gone, h, last in order."""
    out: list[tuple] = []
    for conv, rows in _groups(batches):
        tally, seen, kept = Tally(), set(), []
        for turn, role, text, gone, h, last in rows:
            if gone:
                continue
            fault = "blank" if not last else "duplicate" if h in seen else "" if _ended(last) else "truncated"
            seen.add(h)
            tally.add(turn, role, fault)
            kept.append((role, text))
        cost, audit = L.repaired("".join(tally.codes))
        turns = L.Turns(audit)
        sha, many = hashlib.sha256(), 0
        for role, text in kept:
            sha, many = _digest(turns.row(role, text), sha, many)
        sha, _ = _digest(turns.inserted(), sha, many)
        out.append((conv, *tally.counts, cost, audit, sha.hexdigest()))
        if len(out) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _arrow(kind: str, *names: str) -> pa.Schema:
    """An Arrow schema: the conversation's key of the Spark type ``kind``, longs, and strings for names in upper case."""
    own = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    return pa.schema([("conv_id", own), *((n.lower(), pa.string() if n.isupper() else pa.int64()) for n in names)])


def _by_lattice(rows: DataFrame, kind: str) -> DataFrame:
    """Repairs of conversations of at most ``ROWS`` rows and ``BYTES`` bytes."""
    schema = _arrow(kind, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "AUDIT", "REPAIRED_SHA256")
    sorted_ = rows.repartition("conv_id").sortWithinPartitions(*_order("conv_id")).select("conv_id", "turn", "role", "text", "gone", "h", "last")
    return in_batches(sorted_, lambda batches: _whole(batches, schema), REPAIR.format(kind=kind))


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each ``edit_lattice.BLOCK`` rows of (conv_id, part): its place there, tally and table."""
    names = ["conv_id", "part", "place", "tally", "paths"]
    at, place, tally = None, 0, Tally()

    def row(conv: pa.Array) -> pa.RecordBatch:
        t = tally
        numbers = [t.blank, t.duplicate, t.truncated, t.illegal, t.turns, t.least, t.most]
        paths = [None if p is None else f"{p[0]} {p[1]}" for r in L.table("".join(t.codes)) for p in r]
        columns = [conv, pa.array([at[1]], pa.int64()), pa.array([place], pa.int64())]
        tallies = pa.array([{"n": numbers, "first": t.first, "latest": t.latest}], pa.struct([("n", pa.list_(pa.int64())), ("first", pa.string()), ("latest", pa.string())]))
        return pa.RecordBatch.from_arrays([*columns, tallies, pa.array([paths], pa.list_(pa.string()))], names=names)

    kind = None
    for b in batches:
        kind = b.column(0).type
        for key, rows in _runs(iter([b]), 2):
            if key != at:
                if tally.codes:
                    yield row(pa.array([at[0]], kind))
                at, place, tally = key, 0, Tally()
            for turn, role, fault in rows:
                tally.add(turn, role, fault)
                if len(tally.codes) == L.BLOCK:
                    yield row(pa.array([at[0]], kind))
                    place, tally = place + 1, Tally()
    if tally.codes:
        yield row(pa.array([at[0]], kind))


def _fold(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Tables of a conversation, in order, to its counts, cost and audit."""
    for conv, rows in _groups(batches):
        total, tables = Tally(), []
        for t, paths in rows:
            blank, duplicate, truncated, illegal, turns, least, most = t["n"]
            total.follow(Tally(blank, duplicate, truncated, illegal, t["first"], t["latest"], turns, least, most))
            parsed = [None if p is None else (int(p.partition(" ")[0]), p.partition(" ")[2]) for p in paths]
            tables.append([parsed[4 * g : 4 * g + 4] for g in L.STATES])
        out = (conv, *total.counts, *L.joined(tables))
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(out, schema)], schema=schema)


def _hashed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of long conversations, each behind its audit (role null), to the hash of what is left."""
    now, some, turns, sha, many = None, False, None, None, 0

    def end() -> pa.RecordBatch:
        digest = _digest(turns.inserted(), sha, many)[0].hexdigest()
        return pa.RecordBatch.from_arrays([pa.array([now], schema[0].type), pa.array([digest])], schema=schema)

    for (conv,), rows in _runs(batches, 1):
        for role, text in rows:
            if role is None:
                if some:
                    yield end()
                now, some, turns, sha, many = conv, True, L.Turns(text), hashlib.sha256(), 0
            else:
                sha, many = _digest(turns.row(role, text), sha, many)
    if some:
        yield end()


def _by_tables(rows: DataFrame, kind: str) -> DataFrame:
    """Repairs of long conversations.

    Each is cut by turn into parts that tasks share; a task makes a table of the cheapest paths
    through each ``edit_lattice.BLOCK`` rows, by the same search, and the tables are joined in order. The
    repaired text is hashed as a stream, so no task holds a conversation's texts.
    """
    rows = rows.where("not gone")
    again = F.row_number().over(Window.partitionBy("conv_id", "h").orderBy(*_order())) > 1
    fault = F.when(F.col("last") == "", "blank").when(F.col("again"), "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated").otherwise("")
    part = F.coalesce(F.floor(F.col("turn") / ROWS).cast("long"), F.lit(-(1 << 62)))
    coded = rows.drop("text").withColumn("again", again).select("conv_id", part.alias("part"), "turn", "role", fault.alias("fault"), "h", "copy")
    coded = coded.repartition("conv_id", "part").sortWithinPartitions(*_order("conv_id", "part")).select("conv_id", "part", "turn", "role", "fault")
    made = in_batches(coded, _tables, f"conv_id {kind}, part long, place long, tally struct<n: array<long>, first: string, latest: string>, paths array<string>")
    made = stored(made, "tables").repartition("conv_id").sortWithinPartitions("conv_id", "part", "place").select("conv_id", "tally", "paths")
    schema = _arrow(kind, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "AUDIT")
    audits = stored(in_batches(made, lambda b: _fold(b, schema), f"conv_id {kind}, {COUNTS}, cost long, audit string", 64), "audits")
    nothing = rows.schema
    head = audits.select("conv_id", *[F.lit(None).cast(nothing[c].dataType).alias(c) for c in ("turn", "role", "h", "copy")], F.col("audit").alias("text"), F.lit(0).alias("kind"))
    body = rows.select("conv_id", "turn", "role", "h", "copy", "text", F.lit(1).alias("kind"))
    stream = head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *_order()).select("conv_id", "role", "text")
    hashes = in_batches(stream, lambda b: _hashed(b, _arrow(kind, "REPAIRED_SHA256")), f"conv_id {kind}, repaired_sha256 string", 500)
    key = hashes.withColumnRenamed("conv_id", "_conv")
    return audits.join(key, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def repair(rows: DataFrame, most_rows: int = ROWS, most_bytes: int = BYTES) -> DataFrame:
    """The cheapest repair of each conversation of ``rows`` (conv_id, turn, role, text, and perhaps ``gone``, ``copy``).

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256;
    see :mod:`strandline.llm.edit_lattice` for the edits and their costs. Rows that are ``gone``
    only name their conversation; one without other rows has zeros, an empty audit and the hash
    of the empty string. Conversations of up to ``most_rows`` rows and ``most_bytes`` bytes are
    repaired whole, one after the other in a task; longer ones by tables (:func:`_by_tables`),
    with the same result.

    A null conv_id is one more conversation; a null turn comes first; null roles and texts are
    one space, so such a text is blank; rows of one turn are ordered by role and by a digest of
    role and text; repeated rows are duplicates; an empty table gives an empty result; a very
    long text is read whole; other columns are ignored, whatever their names.
    """
    more = {c: v for c, v in (("gone", F.lit(False)), ("copy", F.lit(0))) if c not in rows.columns}
    rows = prepared(rows.withColumns(more).select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "gone", "copy"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    sizes = rows.groupBy("conv_id").agg(F.count_if(~F.col("gone")).alias("n"), F.sum(F.when(~F.col("gone"), F.octet_length("text"))).alias("bytes"))
    large = stored(sizes.where((F.col("n") > most_rows) | (F.col("bytes") > most_bytes)).select(F.col("conv_id").alias("_large")), "large")
    if large.isEmpty():
        return _by_lattice(rows, kind)
    same = F.col("conv_id").eqNullSafe(F.col("_large"))
    return _by_lattice(rows.join(large, same, "left_anti"), kind).unionByName(_by_tables(rows.join(large, same, "left_semi"), kind))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    return repair(damaged(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


QUERIES = {"op13_conversation_repair": op13_conversation_repair}
ORACLE: dict[str, str] = {}
