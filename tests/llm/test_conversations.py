"""The trie, the shards and the repair of conversations against brute force, and on nulls, ties, repeats and empty tables."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strandline.llm import conversation_repair, edit_lattice, prefix_trie, search_tree, sharding
from tests.conftest import SF

SPACE = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, ids string, words string, h string, copy string, kind string, part string"


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.read.parquet(f"{SF}/conversations.parquet")


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "i", "w", "h", "c", "k", "p") for r in rows], SCHEMA)


#: Nulls, repeats, equal turns, an absent base, blank and very long texts.
EDGE = [
    (0, 1, "system", "Be brief."), (0, 2, "user", "Hi?"), (0, 3, "assistant", None), (0, None, None, "first"), (3, 1, "user", "Hi?"), (3, 1, "user", "Hi?"), (3, 2, "tool", "x"),
    (7, 1, "user", "w " * 40_000), (7, 2, "assistant", "  \n"), (21, 5, "user", "a.b!c?"), (None, 1, "user", "no id."), (None, 1, "user", "no id."), (45, None, "", ""), (45, None, "", ""),
]


# ---- the trie -----------------------------------------------------------------------
def brute_trie(rows):
    convs = defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            convs[r.conv_id].append(r)
    key = lambda t: hashlib.sha256(f"{len((t[0]).encode())}:{t[0]}{t[1]}".encode()).digest()
    own = {c: [(r.role or "", r.text or "") for r in sorted(v, key=lambda r: (r.turn is not None, r.turn or 0, key((r.role or "", r.text or ""))))] for c, v in convs.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made = own.get(c - c % 20, [])[:h] + turns[h:]
        for d in range(len(made) + 1):
            members[tuple(made[:d])].append((c, len(made) == d))
    below = defaultdict(list)
    for path in members:
        if path:
            below[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in below[path]) or 1
        words = len([w for w in SPACE.split(path[-1][1]) if w]) if path else 0
        saved[path] = (len(members[path]) - 1) * words + sum(saved[k] for k in below[path])
    first = {p: min(c for c, _ in m) for p, m in members.items()}
    ends = {p: hashlib.sha256(",".join(str(c) for c in sorted(c for c, e in m if e)).encode()).hexdigest() for p, m in members.items()}
    return Counter((first[p], len(p), first[p[:-1]] if p else None, len(m), len(below[p]), leaves[p], saved[p], ends[p]) for p, m in members.items())


def nodes(df):
    return Counter(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()))


@pytest.mark.parametrize("turns", [100_000, 40])
def test_prefix_trie(spark, conversations, turns):
    edge = rows_of(spark, EDGE)
    for df in (conversations, edge.repartition(3)):
        assert nodes(prefix_trie.prefix_trie(df, turns)) == brute_trie(df.collect())
    assert prefix_trie.prefix_trie(edge.limit(0)).count() == 0


def test_prefix_trie_in_many_ranges(spark, monkeypatch):
    """Prefixes that most conversations share, one of them an end itself, and several rounds of merging."""
    monkeypatch.setattr(prefix_trie, "FAN", 3)
    rng, rows = random.Random(5), []
    for c in range(400):
        shared = ["a", "b"] if c % 3 else ["a"]
        for t, w in enumerate(shared + [rng.choice("xyz") * rng.randint(1, 3) for _ in range(rng.randint(0, 5))]):
            rows.append((c, t, "user", f"{w} {w}."))
    df = rows_of(spark, rows)
    assert nodes(prefix_trie.prefix_trie(df, 60)) == brute_trie(df.collect())


def test_tree_is_balanced_and_in_order():
    spines = [search_tree.sequence([i], [1], i, 1, "e") for i in range(1023)]
    tree = search_tree.Tree()
    for at in search_tree.balanced(spines):
        tree.insert(spines[at])
    link, deepest = [(tree.down[0], 1)], 0
    while link:
        v, d = link.pop()
        deepest = max(deepest, d)
        link += [(w, d + 1) for w in (tree.low[v], tree.high[v]) if w]
    assert deepest == 10
    assert [tree.ids[v] for v in tree.in_order()][1:] == list(range(1023))


# ---- shards -------------------------------------------------------------------------
def test_sharding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(1, None), (2, ""), (3, "é日"), (3, "é日"), (None, "x"), (None, "x"), (None, "y"), (4, "long " * 50_000)] + [(9, "same")] * 90 + [(i, "same") for i in range(100, 190)]
    edge = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in texts], "doc_id long, text string, size int, part int, cell int")
    for df, more in ((docs, {}), (edge.repartition(4), {}), (edge, {"rows_per_part": 10})):
        out = sharding.sharding(df, **more).collect()
        want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in df.collect())
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
        by = defaultdict(list)
        for r in out:
            by[r.shard].append(r.slot)
        assert set(by) <= set(range(8)) and all(sorted(v) == list(range(len(v))) for v in by.values())
        assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sharding.sharding(edge.limit(0)).count() == 0


def test_copies_are_listed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 7)
    df = spark.createDataFrame([(1, "x")] * 50 + [(i, f"t{i}") for i in range(30)], "doc_id long, text string")
    out = sharding.sharding(df).collect()
    assert len(out) == 80 and len({(r.shard, r.slot) for r in out}) == 80
    assert {n for n in Counter(r.shard for r in out).values()} == {10}


def test_ring_moves_little():
    """One more shard takes cells and gives none; with slack, few keys change between old shards."""
    eight, nine = sharding.ring(8), sharding.ring(9)
    assert all(a == b or b == 8 for a, b in zip(eight, nine))
    rng = random.Random(1)
    counts = Counter(rng.randrange(1 << sharding.BITS) for _ in range(200_000))

    def places(owner, shards, slack):
        return {(s.cell, k): s.shard for s in sharding.deal(counts, owner, sharding.capacities(200_000, shards, slack)) for k in range(s.first, s.past)}

    moved = {slack: sum(b not in (a, 8) for a, b in zip(places(eight, 8, slack).values(), places(nine, 9, slack).values())) / 200_000 for slack in (0.0, 0.1)}
    assert moved[0.1] < 0.05 and moved[0.1] <= moved[0.0]
    held = Counter(places(eight, 8, 0.1).values())
    assert max(held.values()) <= 1.1 * 25_000 + 1


def test_full_shards_pass_keys_on_clockwise():
    owner = [0, 0, 1, 2]
    shares = sharding.deal({0: 5, 2: 1}, owner, [2, 2, 2])
    assert [(s.cell, s.first, s.past, s.shard, s.slot) for s in shares] == [(0, 0, 2, 0, 0), (0, 2, 4, 1, 0), (0, 4, 5, 2, 0), (2, 0, 1, 2, 1)]
    with pytest.raises(ValueError):
        sharding.deal({0: 7}, owner, [2, 2, 2])


# ---- repair -------------------------------------------------------------------------
def brute_damage(rows):
    out = defaultdict(list)
    for r in rows:
        role, text = (" " if r.role is None else r.role), (" " if r.text is None else r.text)
        x = zlib.crc32(f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}".encode()) % 20
        out[r.conv_id] += []
        if x == 0:
            continue
        text = "" if x == 1 else re.sub(r"[.!?]", "", text) if x == 2 else text
        role = "user" if x == 4 else role
        out[r.conv_id] += [(r.turn, role, text)] * (2 if x == 3 else 1)
    return out


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def brute_repair(rows):
    """Plain Dijkstra by (cost, audit) over rows read and the roles so far; the language is tested by its pattern."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[1], r[2])))
    faults, seen = [], set()
    for _, role, text in rows:
        left = text.strip(" \t\n\x0b\f\r")
        faults.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    open_ = re.compile(r"s?(ua)*u?")
    states = {"": 0, "s": 1}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, end, made = heapq.heappop(heap)
        whole = "".join(m[0][:1] for m in made)
        state = (i, states.get(whole, 2 if whole[-1:] == "u" else 3))
        if state in done:
            continue
        done.add(state)
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", whole):
            sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
            return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, sha
        steps = [(2, "I", i, (r, "")) for r in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            steps.append((3, "D", i + 1, None))
            if faults[i] not in ("blank", "duplicate"):
                worse = faults[i] == "truncated"
                steps += [(worse, "K", i + 1, (role, text))] + [(2 + worse, "R", i + 1, (r, text)) for r in ("user", "assistant")]
        for step, edit, j, turn in steps:
            now = made if turn is None else (*made, turn)
            if turn is None or turn[0][:1] and open_.fullmatch("".join(m[0][:1] for m in now)):
                heapq.heappush(heap, (cost + step, audit + edit, j, end, now))
    raise AssertionError


def repairs(df):
    return {r.conv_id: tuple(r)[1:] for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def test_repair(spark, conversations):
    edge = rows_of(spark, EDGE)
    for df in (conversations, edge.repartition(3)):
        want = {c: brute_repair(rows) for c, rows in brute_damage(df.collect()).items()}
        made = conversation_repair.damaged(df)
        assert repairs(conversation_repair.repair(made)) == want
        assert repairs(conversation_repair.repair(made, most_rows=2)) == want  # the longer ones by tables
    assert conversation_repair.repair(conversation_repair.damaged(edge.limit(0))).count() == 0


def test_long_conversations_by_tables(spark, monkeypatch):
    """Blocks within parts, parts, and texts that stream: the same as whole."""
    monkeypatch.setattr(edit_lattice, "BLOCK", 16)
    rng, rows = random.Random(2), []
    for conv in (1, None, 3):
        for i in range(300):
            rows.append((conv, None if i < 3 else i * 100, rng.choice(["user", "assistant", "system", "tool", "user"]), rng.choice(["Yes.", "No", f"t{i}.", f"t{i}", " "])))
    df = rows_of(spark, rows).repartition(3)
    whole, cut = repairs(conversation_repair.repair(df)), repairs(conversation_repair.repair(df, most_rows=100))
    assert whole == cut
    assert whole[None][:5] == brute_repair([(t, r, x) for c, t, r, x in rows if c is None])[:5]


def test_search_from_both_ends_finds_the_least_audit():
    """Against plain Dijkstra by (cost, audit), over all codes of up to five rows and longer ones at random."""
    rng = random.Random(4)

    def plain(codes, entry, exits):
        heap, done = [(0, "", 0, entry)], set()
        while heap:
            cost, audit, i, g = heapq.heappop(heap)
            if i == len(codes) and g in exits:
                return cost, audit
            if (i, g) in done:
                continue
            done.add((i, g))
            for step, edit, j, h in edit_lattice._forward(codes, i, g):
                heapq.heappush(heap, (cost + step, audit + edit, j, h))
        return None

    tried = ["".join(rng.choice("suaxSUAXd") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    for codes in tried:
        assert edit_lattice.cheapest(codes, 0, (0, 3)) == plain(codes, 0, (0, 3)) == edit_lattice.joined([edit_lattice.table(codes[k : k + 3]) for k in range(0, len(codes), 3)])
        for g in range(4):
            for h in range(4):
                assert edit_lattice.cheapest(codes, g, (h,)) == plain(codes, g, (h,))
