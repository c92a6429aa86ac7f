"""Training-data operators against brute force, and on nulls, empties, repeats, ties and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.llm import best_fit_packing, common, components, decontamination, fingerprints, language_id, language_model, license_scan, near_dedup, quality, shingling, token_counts, url_filters
from tests.conftest import SF

PATH = token_counts.vocabulary_path()
#: doc_id, text, and columns whose names clash with those used inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k string, t string, n long, block long, tokens string, row long"
LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))


def table(spark, texts, langs=None):
    rows = [(i, t, (langs[i] if langs else "en"), "s", len(t or ""), "k", "t", 1, 2, "x", 3) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


EDGE = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two three four five six"), (5, "one two three four five six"), (6, LONG), (None, "no key at all here today"), (7, "ÉCOLE élève <|endoftext|> Σας ½ 日本")]


@pytest.fixture(scope="module")
def edge(spark):
    return table(spark, EDGE).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_token_counts(spark, edge, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    for df in (edge, docs):
        got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(df, PATH).collect())
        want: Counter = Counter()
        for r in df.collect():
            n = len(t.encode(r.text or "", add_special_tokens=False).ids)
            want[r.doc_id, len((r.text or "").encode()), n, n > 2048] += 1
        assert got == want
    assert token_counts.token_counts(edge.limit(0), PATH).count() == 0


def test_merging_equals_library_on_random_text():
    from tokenizers import Tokenizer

    from strandline.llm.word_bpe import WordBpe

    rng, t, b = random.Random(3), Tokenizer.from_file(PATH), WordBpe(PATH)
    texts = ["".join(rng.choice(["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", *"aabn<|endoftext|> 'sre\x1c\x85éΣσİ½!?日 "]) for _ in range(80)) for _ in range(200)]
    for text, ids in zip(texts, b.encode_texts(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_packing_round_trip(spark, edge, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    for df in (edge, docs):
        got = best_fit_packing.best_fit_packing(df, PATH).collect()
        want: Counter = Counter()
        for r in df.collect():
            ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
            for i, a in enumerate(range(0, len(ids), 4096)):
                part = ids[a : a + 4096]
                want[r.doc_id, i, a, len(part), zlib.crc32(part.tobytes())] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        places: dict = {}
        for r in got:
            places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for p in places.values():
            at = 0
            for offset, n in sorted(p):
                assert offset == at
                at += n
            assert at <= 4096
        total = sum(r.length for r in got)
        assert len(places) <= math.ceil(total / 4096) + 2
    assert best_fit_packing.best_fit_packing(edge.limit(0), PATH).count() == 0


def test_plan_keeps_every_piece():
    rng = np.random.default_rng(0)
    counts = np.bincount(rng.integers(1, 65, 5000), minlength=65)
    groups = best_fit_packing.plan(counts)
    used: Counter = Counter()
    for content, many in groups:
        assert sum(n * m for n, m in content) <= 64
        for n, m in content:
            used[n] += m * many
    assert [used[n] for n in range(65)] == counts.tolist()
    total = int((counts * np.arange(65)).sum())
    assert sum(m for _, m in groups) <= math.ceil(total / 64) * 1.01 + 1


def test_fingerprints(spark, edge, docs):
    for df in (edge, docs):
        rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda x: (-(x[0] if x[0] is not None else -(10**9)), x[1]))
        want: Counter = Counter()
        for i, (k, text) in enumerate(rows):
            after = rows[(i + 1) % len(rows)][1]
            half = len(text) // 2
            want[k, len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()] += 1
        got = fingerprints.fingerprints(df).collect()
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
        by_text = {}
        for r in got:
            text = dict(rows).get(r.doc_id)
            if Counter(k for k, _ in rows)[r.doc_id] == 1:
                assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
    assert fingerprints.fingerprints(edge.limit(0)).count() == 0


def test_block_tables_find_all_within_radius(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(128) for _ in range(40)]
    prints = {b for b in base}
    for b in base:
        for flips in (1, 4, 8, 9):
            x = b
            for bit in rng.sample(range(128), flips):
                x ^= 1 << bit
            prints.add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    make = lambda xs: spark.createDataFrame([(signed(x & (2**64 - 1)), signed(x >> 64)) for x in xs], "low long, high long")
    got = Counter((r.q_low, r.q_high, r.low, r.high) for r in fingerprints.within_radius(make(base), make(prints)).collect())
    want = Counter((signed(a & (2**64 - 1)), signed(a >> 64), signed(b & (2**64 - 1)), signed(b >> 64)) for a in base for b in prints if (a ^ b).bit_count() <= 8)
    assert got == want


def test_following_links_blocks(spark):
    ids = [3, 5, 6, 70, 71, 200, 1000]
    got = {r.id: r.next_id for r in fingerprints.following(spark.createDataFrame([(i,) for i in ids], "id long"), width=4, alone=2).collect()}
    down = sorted(ids, reverse=True)
    assert got == dict(zip(down, [*down[1:], down[0]]))


def shingle_set(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {}
    for k, text in rows:
        if k is not None:
            sets[k] = shingle_set(text)
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {k: find(k) for k in sets}


def test_near_dedup(spark, edge, docs):
    rng = random.Random(1)
    base = [f"t{rng.randrange(5000)}" for _ in range(120)]
    copies = []
    for i in range(150):  # one node that stays large, with a chain of edits and some that drift away
        w = list(base)
        for _ in range(i % 7):
            w[rng.randrange(120)] = f"e{rng.randrange(5000)}"
        copies.append((1000 + i, " ".join(w)))
    hot = table(spark, [(i, t) for i, t in copies] + [(5000 + i, " ".join(base)) for i in range(40)])
    for df in (edge, docs, hot):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        want = brute(rows)
        got = near_dedup.near_dedup(df).collect()
        assert len(got) == len(rows)
        for r in got:
            if r.doc_id is None:
                assert r.component_id is None and not r.kept
            else:
                assert (r.component_id, r.kept) == (want[r.doc_id], r.doc_id == want[r.doc_id])
                assert r.n_shingles == len(shingle_set(dict(rows)[r.doc_id]))
    assert near_dedup.near_dedup(edge.limit(0)).count() == 0


def test_near_dedup_loses_no_link_that_its_nodes_miss(spark, monkeypatch):
    rng, found = random.Random(4), near_dedup.nodes
    monkeypatch.setattr(near_dedup, "nodes", lambda *a: found(*a).limit(0))
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    passage = [f"p{i}" for i in range(90)]
    own = lambda n: [f"o{rng.randrange(10**6)}" for _ in range(n)]
    rows = [(i, " ".join(passage + own(i % 40))) for i in range(120)]
    rows += [(500 + i, " ".join(rows[i][1].split()[: -(i % 9) or None] + own(i % 5))) for i in range(60)]
    rows += [(900, "a b"), (901, "A b"), (902, ""), (903, None), (904, "a b c d e f g h"), (905, "a b c d e f g")]
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(table(spark, rows)).collect()}
    assert got == brute(rows)


def test_near_dedup_deals_only_numbers_by_token_and_loses_no_pair(spark, monkeypatch):
    rng, kept, stored = random.Random(6), {}, near_dedup.stored

    def spy(df, name):
        kept[name] = stored(df, name)
        return kept[name]

    monkeypatch.setattr(near_dedup, "stored", spy)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage[: 60 - i % 25] + [f"o{rng.randrange(10**6)}" for _ in range(i % 11)])) for i in range(80)]
    own = spark.createDataFrame([(i, i) for i, _ in rows], "cid long, component long")
    got = {(r.u, r.v) for r in near_dedup.pairs_left(own, table(spark, rows), "doc_id", "text").collect()}
    sets = {i: shingle_set(t) for i, t in rows}
    want = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert want and want <= got
    assert [n for n, df in kept.items() if any(t.startswith("array") for _, t in df.dtypes)] == ["prefixes"]


def test_near_dedup_keeps_no_shuffles_and_no_wide_tables(spark, docs):
    def left():
        return sum(p.stat().st_size for p in Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*.data"))

    before, root = left(), Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    tables = {p for p in root.iterdir()}
    found = near_dedup.near_dedup(docs)
    assert left() <= before
    names = {p.name.rsplit("-", 5)[0] for p in set(root.iterdir()) - tables}
    assert {"sets", "nodes", "home"} <= names and not names & {"signatures", "level", "shared"}
    assert found.count() == docs.count()


def test_near_dedup_takes_keys_of_any_type(spark):
    base = [f"w{i}" for i in range(80)]
    rows = [("b", " ".join(base)), ("a", " ".join(base[:79] + ["x"])), ("c", "something else altogether that is not near"), ("d", None)]
    got = {r.doc_id: (r.component_id, r.kept) for r in near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"a": ("a", True), "b": ("a", False), "c": ("c", True), "d": ("d", True)}


def test_near_dedup_divides_crowds(spark):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(90)]
    own = lambda n: [f"o{rng.randrange(10**6)}" for _ in range(n)]
    rows = [(i, " ".join(passage + own(30))) for i in range(260)]  # alike by 0.6, not linked
    for i in range(0, 40, 2):  # pairs that share what is their own, too
        w = rows[i][1].split()
        rows[i + 1] = (i + 1, " ".join(w[:-3] + own(3)))
    rows += [(1000 + i, " ".join(passage + own(i % 4))) for i in range(30)]  # close to the passage itself
    want = brute(rows)
    got = {r.doc_id: r.component_id for r in near_dedup.near_dedup(table(spark, rows)).collect()}
    assert len(set(want.values())) > 200 and got == want


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 90)], "u long, v long")
    got = {r.node: r.component for r in components.components(chain).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 90: 90, 100: 90}


def test_word_hashes_split_as_the_contract():
    texts = ["A b\x0bc\x0c d\re", "", "é É", "x" * 5000]
    raw = [t.encode() for t in texts]
    _, counts = shingling.word_hashes(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw]))
    assert counts.tolist() == [5, 0, 2, 1]


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(1, "Ann has 12 apples and gives Tom 5 of them after 3 hours in total."), (2, "short one here"), (3, None), (4, "")], "item_id long, text string")
    rows = [
        (1, "Intro words. Eva has 40 apples and gives Bob 7 of them after 9 days in total. More words follow."),
        (2, "Quite another text about apples and hours, with 12 of them."),
        (3, "say: short one here, indeed"),
        (4, None),
        (5, ""),
        (6, LONG),
        (7, "Ann has 12 apples and gives Tom 5 of them after 3 hours in total."),
        (None, "Ann has 12 apples and gives Tom 5 of them after 3 hours in total."),
    ]
    got = {(r.doc_id, r.item_id): r.kind for r in decontamination.decontamination(table(spark, rows), bench).collect()}
    assert got == {(1, 1): "reparameterised", (3, 2): "verbatim", (7, 1): "verbatim", (None, 1): "verbatim"}
    assert decontamination.decontamination(table(spark, rows).limit(0), bench).count() == 0
    assert decontamination.decontamination(table(spark, rows), bench.limit(0)).count() == 0
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    held = {(r.doc_id, b.item_id) for r in docs.collect() for b in items.collect() if b.text in r.text}
    assert {(r.doc_id, r.item_id) for r in decontamination.decontamination(docs, items).collect()} == held


def test_decontamination_with_null_keys(spark):
    ask = "Ann has 12 apples and gives Tom 5 of them after 3 hours in total."
    bench = spark.createDataFrame([(None, ask), (2, "He needs to find the answer to 7 quite long questions.")], "item_id long, text string")
    other = ask.replace("12", "40").replace("Tom", "Bob")
    got = {(r.doc_id, r.item_id): (r.slots > 0, r.kind) for r in decontamination.decontamination(table(spark, [(None, other), (3, ask)]), bench).collect()}
    assert got == {(None, None): (True, "reparameterised"), (3, None): (True, "verbatim")}


def test_decontamination_judges_each_occurrence(spark):
    ask = "Ann has {} apples and gives Tom {} of them after {} hours in total."
    bench = spark.createDataFrame([(1, ask.format(12, 5, 3))], "item_id long, text string")
    variants = [ask.format(40, 7, 9).replace("Ann", "Eva"), ask.format(31, 8, 2).replace("Tom", "Bob"), ask.format(77, 21, 6)]
    noise = " ".join(f"Then {a} has {i} apples and gives {b} {i + 3} of them." for i, (a, b) in enumerate([("Joe", "Kim"), ("Lea", "Max"), ("Pat", "Sue"), ("Una", "Wim")], 50))
    rows = [(1, " ".join(variants)), (2, " ".join([variants[0], ask.format(12, 5, 3), variants[1]])), (3, f"{noise} {ask.format(12, 5, 3)} {noise}"), (4, noise)]
    got = {r.doc_id: r.kind for r in decontamination.decontamination(table(spark, rows), bench).collect()}
    assert got == {1: "reparameterised", 2: "verbatim", 3: "verbatim"}


def test_decontamination_wants_windows_in_one_place(spark):
    """Windows of an item that lie scattered and out of order, far apart in a long text, are no occurrence; inserted words are."""
    words = "if seven red trains leave a small town at noon and every second one stops at three quiet villages how late is it".split()
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    rng = random.Random(9)
    windows = [words[i : i + 5] for i in range(len(words) - 4)]
    rng.shuffle(windows)
    filler = lambda n: [f"filler{rng.randrange(10**6)}x" for _ in range(n)]
    scattered = " ".join(w for part in windows for w in (*part, *filler(60)))
    inserted = " ".join([*filler(30), *words[:12], "just", "now", *words[12:], *filler(30)])
    got = {r.doc_id: r.kind for r in decontamination.decontamination(table(spark, [(1, scattered), (2, inserted), (3, " ".join(words))]), bench).collect()}
    assert got == {2: "verbatim", 3: "verbatim"}


def test_license_scan(spark):
    mit = license_scan.TEMPLATES["MIT"][1]
    rows = [(1, f"{'pad ' * 300}{mit.upper()}{' pad' * 50}"), (2, "Licensed under CC BY-NC 4.0."), (3, None), (4, ""), (5, LONG), (6, "a license of no kind at all"), (6, "a license of no kind at all"), (None, "Released under the MIT License.")]
    got = {(r.doc_id, r.license) for r in license_scan.license_scan(table(spark, rows)).collect()}
    assert got == {(1, "MIT"), (2, "CC-BY-NC-4.0"), (None, "MIT")}
    assert license_scan.license_scan(table(spark, rows).limit(0)).count() == 0
    assert license_scan.license_scan(table(spark, rows), {}).count() == 0


def test_license_scan_equals_exact_containment(spark, docs):
    def split(t):
        return re.sub(r"[\W_]+", " ", (t or "").lower()).split()

    def runs(w):
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    templates = [(name, set(runs(split(t)))) for name, ts in license_scan.TEMPLATES.items() for t in ts if len(split(t)) >= 5]
    sizes = {}
    for name, ts in license_scan.TEMPLATES.items():
        for t in ts:
            n = len(split(t))
            sizes[frozenset(runs(split(t)))] = next(s for s in license_scan.WINDOWS if n <= s * 3 // 4)
    want = {}
    for r in docs.collect():
        g = runs(split(r.text))
        for name, wanted in templates:
            size = sizes[frozenset(wanted)]
            for start in range(0, max(1, len(g)), size // 4):
                share = len(wanted & set(g[start : start + size - 4])) / len(wanted)
                if share >= 0.75:
                    want[r.doc_id, name] = max(want.get((r.doc_id, name), 0), share)
    got = {(r.doc_id, r.license): r.contained for r in license_scan.license_scan(docs).collect()}
    assert want and got == pytest.approx(want)


def test_license_scan_finds_long_templates(spark):
    full = " ".join(f"clause{i} term{i % 13}" for i in range(500))
    rows = [(1, f"{'pad ' * 300}{full}{' pad' * 900}"), (2, full), (3, "pad " * 2000), (4, full[: len(full) // 2])]
    got = {(r.doc_id, r.license): r.contained for r in license_scan.license_scan(table(spark, rows), {"Long": (full,)}).collect()}
    assert got == {(1, "Long"): 1.0, (2, "Long"): 1.0}


def test_license_scan_with_a_table_of_full_texts(spark):
    """Texts of thousands of words as rows of a table, found by a join; equal to exact containment."""
    rng = random.Random(6)
    words = [f"term{i}" for i in range(4000)]
    full = {f"L{k}": " ".join(rng.choice(words) for _ in range(rng.randint(2000, 3500))) for k in range(3)}
    rows = [*full.items(), *(("MIT", t) for t in license_scan.TEMPLATES["MIT"]), ("short", "two words"), ("none", None)]
    table_ = spark.createDataFrame(rows, "license string, text string")
    cut = full["L2"].split()
    texts = [(1, "intro " * 50 + full["L1"] + " outro" * 30), (2, " ".join(cut[: len(cut) * 9 // 10])), (3, " ".join(cut[: len(cut) // 2])), (5, None), (None, "say " + license_scan.TEMPLATES["MIT"][1]), (6, "x " + license_scan.TEMPLATES["MIT"][1])]
    df = table(spark, texts)
    got = {(r.doc_id, r.license): r.contained for r in license_scan.license_scan(df, table_, literals=1000).collect()}
    assert set(got) == {(1, "L1"), (2, "L2"), (None, "MIT"), (6, "MIT")}
    assert got[1, "L1"] == 1.0 and 0.85 < got[2, "L2"] < 0.95
    assert license_scan.license_scan(df, table_.limit(0)).count() == 0


def test_url_filters(spark):
    urls = ["http://A.Example.com/en/7x?q", "https://example.net/de/8", "x://b.net/de/1#t", "ftp://h.org/es/", None, "no scheme", "http://com/en/", "http://xcom/en/", "http://example.net?x/de/8", "http://example.org/fr/"]
    df = spark.createDataFrame([(i, u, None if i % 2 else '<a href="http://evil.org/x">', "x") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.url_filters(df).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = host.lower()
        fits = [r for r in url_filters.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text), default=None)
        assert got[i][:3] == (host, path, best.text if best else None)
        if best:
            assert got[i][3] == best.verdict
    assert got[4][3] == "allow"
    assert url_filters.url_filters(df.limit(0)).count() == 0


def graph(spark, edges, seeds):
    e = spark.createDataFrame([("s", *x) for x in edges], "side string, src string, dst string, weight double")
    got = url_filters.spread(e, spark.createDataFrame([("s", *x) for x in seeds], "side string, host string, seed double"))
    return {r.host: r["rank"] for r in got.collect()}


def test_pagerank_equals_power_series(spark):
    got = graph(spark, [("a", "b", 1.0), ("b", "c", 1.0), ("x", "y", 1.0)], [("a", 1.0)])
    assert got["a"] > got["b"] > got["c"] > 0 and "y" not in got
    rng, hosts = random.Random(4), "abcdefgh"
    edges = [(a, b, float(rng.randint(1, 4))) for a in hosts for b in hosts if a != b and rng.random() < 0.4]
    seeds = {"a": 0.7, "d": 0.3}
    total = {h: sum(w for a, _, w in edges if a == h) for h in hosts}
    moving = {h: 0.15 * seeds.get(h, 0.0) for h in hosts}
    want = dict(moving)
    for _ in range(200):
        moving = {h: sum(0.85 * moving[a] * w / total[a] for a, b, w in edges if b == h) for h in hosts}
        want = {h: want[h] + moving[h] for h in hosts}
    assert graph(spark, edges, list(seeds.items())) == pytest.approx({h: x for h, x in want.items() if x > 0}, rel=1e-4)


def test_distrust_reaches_every_host(spark):
    chain = [(i, f"http://h{i}.info/x", f'<a href="http://h{i + 1}.info/">') for i in range(18)]
    rows = [*chain, (18, "http://h18.info/x", '<a href="http://a.com/en/">'), (19, "http://a.com/en/1", ""), (20, "http://s1.s2.s3.s4.s5.s6.s7.com/x", ""), (21, "http://s7.com/en/1", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filters.url_filters(df).collect()}
    assert all(r.verdict == "block" and r.distrust > 0 for r in got.values())
    small = spark.createDataFrame([(1e-20,), (0.123456789123,), (0.0,)], "x double").select(url_filters.significant(F.col("x"))).collect()
    assert [r[0] for r in small] == pytest.approx([1e-20, 0.123457, 0.0], rel=1e-9, abs=0)


def test_url_filters_null_keys_and_repeats(spark):
    rows = [(None, "http://x.com/en/1", None), (1, "http://q.example.org/zz", '<a href="//x.com/">'), (1, "http://q.example.org/zz", '<a href="//x.com/">'), (2, "http://fine.example.net/de/1", None)]
    got = Counter((r.page_id, r.host, r.verdict) for r in url_filters.url_filters(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert got == {(None, "x.com", "block"): 1, (1, "q.example.org", "block"): 2, (2, "fine.example.net", "allow"): 1}


def test_quality(spark, edge, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    good = [got[k].keep for k, q in known.items() if q == 1]  # a limit is a quantile of a few of them here
    assert sum(good) >= 0.97 * len(good)
    assert sum(not got[k].keep for k, q in known.items() if q == 0) > 0.5 * sum(q == 0 for q in known.values())
    few = spark.createDataFrame([(5, 1, 0), (6, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality(edge, few).collect()
    assert len(rows) == len(EDGE) and all(r.n_tokens >= 1 for r in rows)
    assert quality.quality(edge.limit(0), few).count() == 0 and quality.quality(edge, few.limit(0)).count() == len(EDGE)


def test_kneser_ney_sums_to_one(spark, docs):
    model = quality.fit(docs.limit(60), 60, least=40)
    assert 30 < len(model.vocabulary.hashes) < 400
    v = model.vocabulary.size
    for a, b in ((0, 0), (5, 7), (60, 61)):
        p = model.score(np.concatenate([[a, b, c] for c in range(v)]))[::3]
        assert 10.0 ** p.astype(float) @ np.ones(v) == pytest.approx(1, abs=0.02)


def kneser_ney(texts, v):
    """Interpolated modified Kneser-Ney, written plainly: log10 P of c after a, b."""
    three = Counter(g for t in texts for g in zip(t, t[1:], t[2:]))
    two, one = Counter((b, c) for _, b, c in three), Counter()
    for _, c in two:
        one[c] += 1

    def discounts(counts):
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2])
        d = 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]
        return [min(max(x, 0.1), k + 0.9) for k, x in enumerate(d)]

    d3, d2 = discounts(three), discounts(two)
    by_ab, by_b = {}, {}
    for (a, b, _), n in three.items():
        by_ab.setdefault((a, b), []).append(n)
    for (b, _), n in two.items():
        by_b.setdefault(b, []).append(n)

    def p1(c):
        return 0.995 * one[c] / sum(one.values()) + 0.005 / v

    def step(n, counts, d, lower):
        if not counts:
            return lower
        freed = sum(d[min(x, 3) - 1] for x in counts)
        return ((n - d[min(n, 3) - 1] if n else 0) + freed * lower) / sum(counts)

    def p(a, b, c):
        return step(three[a, b, c], by_ab.get((a, b)), d3, step(two[b, c], by_b.get(b), d2, p1(c)))

    return lambda a, b, c: math.log10(p(a, b, c))


def test_perplexity_equals_brute_force(spark, docs):
    rows = docs.where("length(text) < 3000").limit(80)
    model = quality.fit(rows, 80, most=10**9, least=30)
    ids = quality.WordIds(model.vocabulary.describe, 1, np.int32)
    spell = lambda t: model.vocabulary.tokens(ids, [t or ""])[0].tolist()
    learned = {r.doc_id for r in rows.where(quality.in_sample("doc_id", 80, 10**9)).select("doc_id").collect()}
    texts = {r.doc_id: spell(r.text) for r in rows.collect()}
    logp = kneser_ney([texts[k] for k in learned], model.vocabulary.size)
    want = {k: sum(logp(*g) for g in zip(t, t[1:], t[2:])) for k, t in texts.items()}
    for got in (quality.perplexity(rows, model), quality.perplexity_by_joins(rows, model)):
        got = {r.doc_id: r for r in got.collect()}
        assert {k: r.n_tokens for k, r in got.items()} == {k: len(t) - 2 for k, t in texts.items()}
        for k in want:
            assert got[k].logp == pytest.approx(want[k], rel=2e-4, abs=1e-3)


def test_quality_learns_from_all_trusted_text_by_joins_too(spark, docs, monkeypatch):
    share = spark.range(5000).where(quality.in_sample("id", 10**7, quality.TRUSTED)).count() / 5000
    assert share == pytest.approx(0.8, abs=0.03)  # however many trusted documents there are
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    monkeypatch.setattr(quality, "ENTRIES", 0)
    got = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert (got[k].n_tokens, got[k].keep) == (r.n_tokens, r.keep)
        assert got[k].score == pytest.approx(r.score, rel=1e-4) and (got[k].limit or 0.0) == pytest.approx(r.limit or 0.0, rel=1e-4)


def test_shards_equal_brute_force_when_middle_words_are_divided(spark, docs):
    rows = docs.where("length(text) < 3000").limit(60).select("doc_id", "text").cache()
    texts = quality.learned(rows, 60, 10**9, "doc_id", "text")
    words, often = quality.learn_words(texts, 5)
    assert (quality.Shards.by(often).parts > 1).any()
    model = quality.fit_sharded(texts, words, often)
    ids = quality.WordIds(words.describe, 1, np.int32)
    spelled = {r.doc_id: words.tokens(ids, [r.text or ""])[0].tolist() for r in rows.collect()}
    logp = kneser_ney([spelled[r.doc_id] for r in rows.where(quality.in_sample("doc_id", 60, 10**9)).collect()], words.size)
    whole, spans = quality.scores_by_shards(rows, model, F.lit(True))
    got = {r.doc_id: r for r in whole.collect()}
    assert got.keys() == spelled.keys() and spans.where("mean is null or mean < 0").isEmpty()
    for k, t in spelled.items():
        assert got[k].n_tokens == len(t) - 2
        assert got[k].logp == pytest.approx(sum(logp(*g) for g in zip(t, t[1:], t[2:])), rel=2e-4, abs=1e-3)


def test_a_shard_takes_its_pieces_one_after_another_in_little_memory():
    import tracemalloc

    rng, v = np.random.default_rng(3), 5000
    b, a, c = rng.integers(0, 40, 400_000), rng.integers(0, 300, 400_000), rng.integers(0, v, 400_000)
    b[:50_000], a[:50_000] = 7, 7  # one context goes through several pieces
    rows, n = np.unique(np.stack([b, a, c]), axis=1, return_counts=True)
    n = (n + rng.integers(0, 3, len(n))).astype(np.int32)
    b, a, c = rows.astype(np.int32)
    bc, of_bc = np.unique(b.astype(np.int64) * v + c, return_counts=True)
    model = (v, np.full(v, 1 / v, np.float32), np.full(v, 900, np.float32), np.full(v, 0.5, np.float32), (0.5, 0.75, 0.9), (0.5, 0.75, 0.9))
    cut = lambda size: [np.stack([x[i : i + size] for x in (b, a, c, n)]) for i in range(0, len(b), size)]
    two = lambda: [np.stack([bc // v, bc % v, of_bc]).astype(np.int32)]
    whole = quality.Shard(model, cut(len(b)), two())
    pieces, size = cut(3000)[::-1], 3000
    rng.shuffle(pieces)
    tracemalloc.start()
    shard = quality.Shard(model, pieces, two())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * len(b) and not pieces
    for name in ("ba", "back3", "bac", "p3", "bc", "p2"):
        assert getattr(shard, name) == pytest.approx(getattr(whole, name), rel=1e-5)
    off = np.array([0, 0.5, 0.75, 0.9])[np.minimum(n, 3)]
    mine = np.flatnonzero((b == 7) & (a == 7))
    low = np.array([(k - [0, 0.5, 0.75, 0.9][min(k, 3)]) / 900 for k in of_bc[np.searchsorted(bc, b[mine].astype(np.int64) * v + c[mine])].tolist()]) + 0.5 / v
    want = (n[mine] - off[mine]) / n[mine].sum() + off[mine].sum() / n[mine].sum() * low
    assert 10.0 ** shard.log_probs(b[mine], a[mine], c[mine]) == pytest.approx(want, rel=1e-4)
    assert len(quality.Shard(model, [], []).log_probs(b[:3], a[:3], c[:3])) == 3


def test_shuffles_are_freed_and_trigrams_packed(spark):
    def left():
        return sum(p.stat().st_size for p in Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*.data"))

    before, own = left(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    with common.freed_shuffles(spark):
        common.stored(spark.range(300_000).repartition(3, "id"), "freed")
    assert left() <= before and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == own
    columns = [np.array(x, np.int64) for x in ([0, 1, 2**31 - 1], [5, 0, 7], [70_000, 1, 2])]
    assert [x.tolist() for x in quality.unpacked(quality.packed(*columns), 3, 3)] == [x.tolist() for x in columns]


def test_limits_are_quantiles_by_length(spark):
    rows = [("en", 3, float(i)) for i in range(1000)] + [("de", 3, float(i)) for i in range(5000, 5010)]
    got = {(r.g, r.k): r.limit for r in quality.limits(spark.createDataFrame(rows, "g string, k int, mean double"), 0.9).collect()}
    assert got["en", 3] == pytest.approx(899, abs=1) and got["de", 3] == pytest.approx(908, abs=2)  # too few: of all languages


def test_language_id(spark, edge, docs):
    train = docs.where(~language_id.held_out())
    model = language_id.train(train)
    got = {r.doc_id: r for r in language_id.language_id(docs.select("doc_id", "text"), model).collect()}
    truth = {r.doc_id: r.lang for r in docs.where(language_id.held_out()).collect()}
    assert sum(got[k].lang_pred == v for k, v in truth.items()) >= 0.95 * len(truth)
    rows = language_id.language_id(edge, model).collect()
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {1: "und", 2: "und", 3: "und"}
    assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
    empty = language_id.train(edge.limit(0))
    assert {r.lang_pred for r in language_id.language_id(edge, empty).collect()} == {"und"}


def test_rare_scripts_and_many_languages():
    assert language_id.features(["\U00030000\U00031000"])[2].tolist() == [list(language_id.SCRIPTS).index("han") + 1]
    scores = np.zeros((1, 300), np.float32)
    scores[0, 280] = 5
    assert language_id.viterbi(scores, np.zeros(4, np.int32), np.array([4]), 1.0).tolist() == [280] * 4


def test_word_scores_are_posteriors(spark, docs):
    model = language_id.train(docs.where(~language_id.held_out()))
    words = ["the", "und", "12"]
    got = model.describe(words)
    for w, row in zip(words, got):
        bucket, _, script = language_id.features([w])
        if script[0] < 0:
            assert row.tolist() == [0.0] * (len(model.langs) + 1)
            continue
        total = [sum(float(model.logp[k][b]) for b in bucket) if model.scripts[k][script[0]] else -1e9 for k in range(len(model.langs))]
        norm = max(total) + math.log(sum(math.exp(x - max(total)) for x in total))
        assert row[:-1] == pytest.approx([max(x - norm, -12.0) for x in total], abs=1e-3)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    scores = rng.standard_normal((30, 3)).astype(np.float32) * 3
    counts = np.array([4, 0, 5, 1])
    numbers = rng.integers(0, 30, counts.sum()).astype(np.int32)
    got, at = language_id.viterbi(scores, numbers, counts, 1.5), 0
    from itertools import product

    for n in counts:
        s = scores[numbers[at : at + n]]
        worth = lambda p: sum(s[i, k] for i, k in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
        if n:
            assert worth(got[at : at + n]) == pytest.approx(max(map(worth, product(range(3), repeat=int(n)))), abs=1e-4)
        at += n


def test_language_model_base(spark, edge, docs):
    for df in (docs, edge):
        rows = [(r.doc_id, [*language_model.split(r.text or ""), None]) for r in df.collect()]
        learned = [w for k, ws in rows if k is not None and zlib.crc32(str(k).encode()) % 7 != 2 for w in ws]
        c, n = Counter(learned), len(learned)
        got = language_model.language_model(df, ~language_id.held_out(fold=7)).collect()
        assert Counter(r.doc_id for r in got) == Counter(k for k, _ in rows)
        by = {k: ws for k, ws in rows}
        for r in got:
            ws = by[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
            assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in ws))
            assert r.score <= 0
        if df is docs:
            out = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 7 == 2]
            assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert language_model.language_model(edge.limit(0), F.lit(True)).count() == 0


def test_scores_do_not_depend_on_company():
    net, rng = language_model.Network(2), np.random.default_rng(1)
    docs = [rng.integers(0, language_model.HEAD, n) for n in (5, 0, 300, 17, 2000, 3)]
    model = language_model.Model(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), net)
    alone = [model.score([d])[0] for d in docs]
    assert model.score(docs) == pytest.approx(alone, rel=1e-4)
    for d, got in zip(docs, alone):  # a symbol at a time
        h, total = np.zeros((1, language_model.HIDDEN), np.float32), 0.0
        for x, y in zip([language_model.EDGE, *d], [*d, language_model.EDGE]):
            out, h = net.run(np.array([[x]]), h)
            total += net.log_probs(out.reshape(1, -1), np.array([y]))[0][0]
        assert got == pytest.approx(total / math.log(10), rel=1e-4)


def test_gates_lie_in_one_piece_with_lanes_last():
    net, rng, n = language_model.Network(5), np.random.default_rng(2), language_model.HIDDEN
    net.p = {k: v * 30 for k, v in net.p.items()}  # gates that are all shut or open
    symbols, tape = rng.integers(0, language_model.SYMBOLS, (6, 7)), []
    out, _ = net.run(symbols, np.zeros((7, n), np.float32), tape)
    before, gates, inners = tape
    assert (before.shape, gates.shape, inners.shape) == ((6, n, 7), (6, 3 * n, 7), (6, n, 7))
    assert all(x.flags.c_contiguous and np.isfinite(x).all() for x in tape)
    z, new = gates[:, :n], gates[:, 2 * n :]
    assert out.transpose(0, 2, 1) == pytest.approx(new + z * (before - new), abs=1e-5)


def test_lanes_hold_a_very_long_document():
    docs = [np.zeros(200_000, np.int32)] + [np.zeros(60, np.int32)] * 500
    symbols, _, owner, _ = language_model.lanes_of(docs, 256)
    assert symbols.size <= 3 * sum(len(d) + 1 for d in docs) and (owner >= 0).sum() == sum(len(d) + 1 for d in docs)


def test_stretches_come_from_every_document():
    for text in (b"", b"one", b"many words here " * 500, b"x" * 5000):
        parts = list(language_model.stretches(text))
        assert parts and all(0 <= r < language_model.ROUNDS for r, *_ in parts)
        assert len(parts) == -(-max(1, len(text) // language_model.STRETCH) // language_model.SHARE)
        assert all(w in text for *_, w in parts)


def test_every_word_and_end_is_learned_once(monkeypatch):
    monkeypatch.setattr(language_model, "STRETCH", 40)
    for text in (b"", b"   ", b"one", b" ".join(b"w%d" % i for i in range(300)), b"a " + b"x" * 500 + b" b  c ", b"y" * 300, b" " * 90 + b"z"):
        learned, ends = [], 0
        for _, first, last, words in language_model.stretches(text):
            learned += words.split()[not first :]
            ends += last and (first or bool(words.split()))
        assert sorted(learned) == sorted(text.split()) and ends == 1


def test_texts_are_encoded_once_for_all_rounds_and_scores(spark, edge, docs, monkeypatch):
    kept, stored = {}, language_model.stored
    monkeypatch.setattr(language_model, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    rows = docs.where("length(text) < 90000").limit(60).select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows] + [(None, "no key"), (10**6, None), (10**6 + 2, "x" * 50_000 + " y z" * 20_000), (10**6 + 2, " ")]
    got = language_model.language_model(spark.createDataFrame(rows, "doc_id long, text string"), ~language_model.held_out(fold=7))
    assert got.count() == len(rows)
    whole = kept["encoded"].where("row is not null").collect()
    assert Counter((r.k, r.n_tokens, len(r.symbols) // 2) for r in whole) == Counter((k, len(w) + 1, len(w)) for k, w in ((k, language_model.split(t or "")) for k, t in rows))
    learns = [t or "" for k, t in rows if k is not None and zlib.crc32(str(k).encode()) % 7 != 2]
    want = Counter((*x[:3], len(x[3].split())) for t in learns for x in language_model.stretches(t.encode().lower()))
    assert Counter((r["round"], r["first"], r["last"], len(r.symbols) // 2) for r in kept["encoded"].where("round is not null").collect()) == want
    batches = [pa.record_batch([language_model._binaries(np.arange(n), np.array([n - n // 3, n // 3]))], names=["symbols"]) for n in (3, 10, 0, 5)]
    lots = [language_model._documents(b.column(0)) for b in language_model.in_lots(iter(batches), 12)]
    assert [[x.tolist() for x in lot] for lot in lots] == [[[0, 1], [2], [0, 1, 2, 3, 4, 5, 6], [7, 8, 9]], [[], [], [0, 1, 2, 3], [4]]]


def test_words_are_looked_up_once_and_softmax_holds_for_any_weights():
    class Word(str):
        hashed = 0

        def __hash__(self):
            Word.hashed += 1
            return str.__hash__(self)

    ids = quality.WordIds(lambda new: np.array([[len(w)] for w in new]), 1, np.int64)
    assert ids.of([["b", "aa"], [], ["b", "ccc"]])[0].tolist() == [0, 1, 0, 2] and ids.rows.ravel().tolist() == [1, 2, 3]
    again, sizes = ids.of([[Word("aa"), Word("b")], [Word("ccc")]])
    assert again.tolist() == [1, 0, 2] and sizes.tolist() == [2, 1] and Word.hashed == 3
    rng = np.random.default_rng(4)
    for scale in (1, 1000):
        net = language_model.Network(6)
        net.p = {k: x.astype(np.float64) * scale for k, x in net.p.items()}
        h, target = rng.uniform(-1, 1, (50, language_model.HIDDEN)), rng.integers(0, language_model.SYMBOLS, 50)
        log_softmax = lambda x: x - x.max() - np.log(np.exp(x - x.max()).sum())
        for got, state, t in zip(net.log_probs(h, target)[0], h, target):
            kind = t // language_model.IN_CLASS if t < language_model.HEAD else t - language_model.HEAD + language_model.HEAD_CLASSES
            want = log_softmax(state @ net.p["c"] + net.p["cb"])[kind]
            want += log_softmax(state @ net.p["o"][kind] + net.p["ob"][kind])[t % language_model.IN_CLASS] if t < language_model.HEAD else 0
            assert got == pytest.approx(want, rel=1e-6)


def test_gradients_are_right():
    net = language_model.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    symbols, target = rng.integers(0, language_model.SYMBOLS, (5, 3)), rng.integers(0, language_model.SYMBOLS, (5, 3))
    weight, state = np.ones((5, 3), np.float32), np.zeros((3, language_model.HIDDEN))

    def loss():
        h, _ = net.run(symbols, state)
        return -net.log_probs(h.reshape(-1, language_model.HIDDEN).astype(np.float64), target.ravel())[0].mean()

    g, _ = net.gradients(symbols, target, weight, state)
    for k in net.p:
        at = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        old = net.p[k][at]
        net.p[k][at] = old + 1e-2
        up = loss()
        net.p[k][at] = old - 1e-2
        down = loss()
        net.p[k][at] = old
        assert (up - down) / 2e-2 == pytest.approx(g[k][at], rel=0.05, abs=1e-4)


def test_pipeline(spark):
    import corpus_pipeline

    import __spark_entry__

    got = corpus_pipeline.run(spark, SF).collect()
    assert got and __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    ids = {r.doc_id for r in got}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(b in docs[k] for k in ids for b in items)
    kept = brute([(k, docs[k]) for k in ids])
    assert all(k == v for k, v in kept.items())


def test_pipeline_edges(spark, tmp_path):
    """Empty tables, columns with the names used inside, and a very long text."""
    import corpus_pipeline as cp

    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this stands anywhere in these few texts")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, LONG, "en", 11, 12, 13), (2, "two words", "en", 21, 22, 23), (2, "two words", "en", 21, 22, 23), (None, None, None, 31, 32, 33)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, _row long, _n int, keep int")
    for name, stage in cp.STAGES:
        for left in (df, df.limit(0)):
            out = stage(spark, left, str(tmp_path))
            kept = out.collect()
            if name != "packing":
                assert out.columns == df.columns and set(map(tuple, kept)) <= set(rows), name
            if left is not df:
                assert not kept, name
    assert {r._row for r in cp.keep_quality(spark, df, str(tmp_path)).collect()} == {11, 21, 31}  # no limit without trusted texts
    assert sorted(r._row for r in cp.keep_first_copies(spark, df, str(tmp_path)).collect()) == [11, 21, 31]


def test_pipeline_judges_rows_and_not_ids(spark, docs, tmp_path):
    import corpus_pipeline as cp

    item = "The quick brown fox jumps over the lazy dog near the old river bank"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = ["alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine", "red green blue white black brown grey pink"]
    rows = [(None, f"say {item} now"), (None, clean[0]), (7, f"say {item} now"), (7, clean[1]), (8, clean[2]), (8, clean[2]), (None, clean[2]), (9, ""), (9, "")]
    df = table(spark, rows).repartition(3)

    def left(out):
        assert out.columns == df.columns
        return Counter((r.doc_id, r.text) for r in out.collect())

    assert left(cp.drop_benchmarks(spark, df, str(tmp_path))) == Counter(r for r in rows if item not in r[1])
    got = left(cp.keep_first_copies(spark, df, str(tmp_path)))
    assert sum(n for (_, x), n in got.items() if item in x) == 1 and sum(n for (_, x), n in got.items() if x == clean[2]) == 1
    assert got[None, clean[0]] == got[7, clean[1]] == got[9, ""] == 1 and sum(got.values()) == 5
    texts = docs.where("lang = 'en'").orderBy("doc_id").limit(2).collect()
    odd = " ".join(f"#{i}@{i * 7}*" for i in range(60))
    mixed = docs.unionByName(spark.createDataFrame([(None, texts[0].text), (None, odd), (-5, texts[1].text), (-5, odd)], "doc_id long, text string"), allowMissingColumns=True)
    kept = Counter((r.doc_id, r.text) for r in cp.keep_languages(spark, mixed, SF).where("doc_id is null or doc_id = -5").collect())
    assert kept == {(None, texts[0].text): 1, (-5, texts[1].text): 1}
    kept = Counter((r.doc_id, r.text) for r in cp.keep_quality(spark, mixed.fillna({"lang": "en"}), SF).where("doc_id is null or doc_id = -5").collect())
    assert kept == {(None, texts[0].text): 1, (-5, texts[1].text): 1}


def test_small_batches_leave_the_session_as_it_was(spark):
    names = ["maxRecordsPerBatch", "maxBytesPerBatch"]
    conf = lambda: [spark.conf.get(f"spark.sql.execution.arrow.{n}") for n in names]
    before = conf()
    with pytest.raises(ValueError), common.small_batches(spark):
        assert conf() == ["2500", str(common.BATCH_BYTES)]
        raise ValueError
    assert conf() == before
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1000000")  # a user's own size stays
    with common.small_batches(spark):
        assert conf() == ["2500", "1000000"]
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before[1])


def test_batches_end_by_bytes(spark):
    big = spark.range(40, numPartitions=1).select(F.concat(F.repeat(F.lit("x"), 1_000_000), F.col("id").cast("string")).alias("t"))
    sizes = lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in bs)
    rows = [r.n for r in common.stored(big.mapInArrow(sizes, "n long"), "sizes").collect()]
    assert sum(rows) == 40 and max(rows) <= common.BATCH_BYTES // 1_000_000 + 1
