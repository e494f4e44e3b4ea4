"""Blob ledger, spelling variants and the trie of conversation prefixes against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import ledger, prefixes, spelling


# --- secrets


def found(df):
    return sorted((r.id if r.id is not None else -1, [tuple(s) for s in r.spans]) for r in df.collect())


SECRET = [
    (1, 'x = 1; API_KEY: "abcdefABCDEF0123+/="'), (2, "password = short"), (3, "token: secret: abcdefghijklmnop"), (4, "ſecret=abcdefghijklmnop"),
    (5, "é😀 AKIAABCDEFGHIJKLMN and deadbeefdeadbeef0"), (6, None), (7, ""), (None, "passwd=aaaaaaaaaaaa"), (None, "passwd=aaaaaaaaaaaa"), (8, "AKIAABC"),
    (9, "-----BEGIN RSA PRIVATE KEY-----"), (9, "eyJhbGciOiJI.eyJzdWIi.c2ln"), (10, "z" * 300_000 + " secret=" + "q" * 50_000),
]


def brute_spans(text):
    """The contract's own patterns, with the whole match dropped when it is short."""
    text, out = text or "", []
    letters = "".join
    word = letters(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password")
    keys = "|".join([word] + [letters(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("passwd", "secret", "token", "api_?key")])
    base = [
        ("assign", rf"""({keys})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16),
    ]
    for rank, (kind, pattern, group, least) in enumerate(base):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def test_spans_are_those_of_the_patterns(spark, tmp_path):
    parts = ["password", "TOKEN", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "ABCDEF0123456789", "deadbeef", "0123456789abcdef", "é", "😀", "x", ".", "secret=", "\n"]
    draw = random.Random(7)
    rows = SECRET + [(100 + i, "".join(draw.choices(parts, k=draw.randint(1, 30)))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ledger.scan(df, str(tmp_path / "ledger"), rules=ledger.BASE)
    assert got.count() == len(rows)
    assert found(got) == sorted((-1 if i is None else i, brute_spans(t)) for i, t in rows)


def test_the_method_adds_kinds(spark, tmp_path):
    df = spark.createDataFrame(SECRET, "doc_id long, text string")
    kinds = {k for _, spans in found(ledger.scan(df, str(tmp_path / "l"))) for k, _, _ in spans}
    assert kinds == {"assign", "access", "hex", "key", "signed"}


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    rows = lambda: [(bytes(r.blob), tuple(r.rules)) for r in spark.read.schema(ledger.LEDGER).parquet(folder).collect()]
    first = spark.createDataFrame([(1, "token=aaaaaaaaaaaa"), (2, "token=aaaaaaaaaaaa"), (3, "clean")], "doc_id long, text string")
    one, two = ledger.Rule("assign", "token=([a-z]+)", 3, 1), ledger.Rule("word", "clean")
    assert found(ledger.scan(first, folder, (one,))) == [(1, [("assign", 0, 18)]), (2, [("assign", 0, 18)]), (3, [])]
    assert len(rows()) == 2  # a shared text once
    ledger.scan(first, folder, (one,))
    assert len(rows()) == 2
    more = first.unionByName(spark.createDataFrame([(4, "clean"), (5, "new token=bbbb")], "doc_id long, text string"))
    assert found(ledger.scan(more, folder, (one,)))[4] == (5, [("assign", 4, 14)]) and len(rows()) == 3
    both = found(ledger.scan(more, folder, (one, two)))
    assert both[2:4] == [(3, [("word", 0, 5)]), (4, [("word", 0, 5)])]
    # the new rule looks at all three blobs, the old one at none again
    assert Counter(r for _, r in rows()) == {("assign@1",): 3, ("word@1",): 3}
    later = ledger.Rule("assign", "token=([a-z]+)", 5, 1, version="2")
    assert found(ledger.scan(more, folder, (later,)))[4] == (5, []) and len(rows()) == 9
    assert Counter(r for _, r in rows())[("assign@2",)] == 3


def test_half_a_run_is_used_by_the_next(spark, tmp_path):
    """Rows that a lost run left in the ledger are not found again, and nothing is missing."""
    folder = str(tmp_path / "ledger")
    df = spark.createDataFrame([(i, f"token=aaaaaaaaaaaa{i}") for i in range(40)], "doc_id long, text string")
    ledger.scan(df.where("doc_id % 3 = 0"), folder)
    assert found(ledger.scan(df, folder)) == [(i, [("assign", 0, 18 + len(str(i)))]) for i in range(40)]
    assert spark.read.parquet(folder).select("blob").distinct().count() == spark.read.parquet(folder).count() == 40


def test_a_hot_blob_keeps_all_its_places(spark, tmp_path):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("token=aaaaaaaaaaaa")).otherwise(F.concat(F.lit("no "), F.col("id"))).alias("text"))
    got = ledger.scan(df, str(tmp_path / "ledger"))
    assert got.count() == 6000 and got.where("size(spans) = 1").agg(F.countDistinct("id")).first()[0] == 2000


def test_ledger_with_odd_rows(spark, odd, empty, tmp_path):
    got = ledger.digests(ledger.scan(odd, str(tmp_path / "a")))
    assert got.count() == odd.count() and got.columns == ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert got.where("id = 4").first().base_sha256 == hashlib.sha256(b"").hexdigest()
    assert ledger.scan(empty, str(tmp_path / "b")).count() == 0


# --- spelling


def edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    out = {}
    near = {w: [v for v in words if edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], words[form[w]] if form[w] else None, root)
    return out


def as_dict(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_variants_against_brute_force(spark):
    draw = random.Random(3)
    words = {}
    for _ in range(40):
        base = "".join(draw.choices("abcdeéÿ", k=draw.randint(6, 9)))
        words[base] = draw.choice([1, 10, 100, 1000])
        for _ in range(8):
            i, c = draw.randrange(len(base)), draw.choice("abcdeéÿ÷")
            made = draw.choice([base[:i] + base[i + 1 :], base[:i] + c + base[i:], base[:i] + c + base[i + 1 :], base[:i] + base[i : i + 2][::-1] + base[i + 2 :]])
            words.setdefault(made, draw.choice([1, 10, 100]))
    got = as_dict(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute_variants(words)
    assert any(f and words[f] < 1000 and r != f for _, _, f, _, r in got.values())  # chains of two and more


def test_tiles_of_a_hot_block(spark, monkeypatch):
    """Anagrams are one block; in tiles of eight words the answer is the same."""
    draw = random.Random(5)
    words = {"".join(draw.sample("aabbccdd", 8)): draw.randint(1, 50) for _ in range(120)} | {"aabbccd": 500, "aabbccdde": 7}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    monkeypatch.setattr(spelling, "TILE_WORDS", 8)
    monkeypatch.setattr(spelling, "TASK_PAIRS", 500)
    assert as_dict(spelling.variants(df)) == brute_variants(words)


def test_near_pairs_of_long_words():
    codes = lambda w: np.frombuffer(w.encode("latin-1"), np.uint8).reshape(1, -1)
    long = "ab" * 5000
    for other, near in ((long[:77] + "c" + long[78:], True), (long + "b", True), (long[:-1] + "aa", False), (long[:-2] + "ba", False), (long, False)):
        assert (len(spelling.near_pairs(codes(long), codes(other))[0]) == 1) == near


def test_word_counts_against_brute_force(spark, odd, empty):
    texts = [(1, "Wonderful wonderful WONDERFUL, naïveté naïveté×2 ÄÖÜäöüß"), (2, "wonderful shorty naïveté"), (2, "wonderful shorty naïveté"), (None, "nothing nothing"), (3, None), (4, "x" * 40_000)]
    texts += [(10 + i, f"separate together wonderful {'separates' * (i % 3)}") for i in range(400)]
    for slips in (None, 31, 3):
        counts = Counter()
        for name, text in texts:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                run = "".join(c.lower() if c < "\x80" else c for c in run)
                h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
                if slips and h % slips == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= 7:
                    counts[run] += 1
        got = spelling.word_counts(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), slips=slips)
        assert dict(map(tuple, got.collect())) == {w: n for w, n in counts.items() if n >= 2}
    assert spelling.variants(spelling.word_counts(empty)).count() == 0
    assert spelling.variants(spelling.word_counts(odd)).count() > 0


# --- conversation prefixes


def brute_trie(convs):
    """``convs``: id to list of (role, text)."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(own), len(p), parent, len(own), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def spliced(table):
    by = defaultdict(list)
    for c, turn, role, text in table:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in by.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    return out


def table_of(seed, n=260, most=7):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(0, 900), n):
        k = draw.randint(1, most)
        start = [None] if draw.random() < 0.2 else []
        rows += [(c, t, draw.choice(["user", "bot", None]), draw.choice(["hi", "é😀", "", None, "so long a text"])) for t in (start + list(range(k)))[:k]]
    return rows


@pytest.mark.parametrize("stretch,shard", [(4096, 250_000), (3, 40), (1, 7)])
def test_trie_against_brute_force(spark, stretch, shard):
    """Also with conversations in several stretches and prefixes over the ends of many shards."""
    rows = table_of(stretch)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    turns, convs = prefixes.shared_heads(prefixes.numbered_turns(df))
    assert rows_of(prefixes.trie(turns, convs, stretch, shard)) == brute_trie(spliced(rows))


def test_trie_of_copies_and_a_long_conversation(spark):
    told = {c: [("u", "hello"), ("b", "yes")] for c in range(500)} | {c: [("u", "hello")] for c in range(500, 700)}
    told |= {1000: [("u", str(i)) for i in range(1500)], 1001: [("u", str(i)) for i in range(1490)] + [("u", "else")], 1002: []}
    rows = [(c, i, *t) for c, v in told.items() for i, t in enumerate(v)]
    turns = prefixes.numbered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    turns = turns.withColumnRenamed("at", "depth")
    convs = spark.createDataFrame([(c,) for c in told], "conv long")
    assert rows_of(prefixes.trie(turns, convs, stretch=400, shard_turns=600)) == brute_trie(told)


def test_trie_with_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, shard int, depth string, k1 int"
    rows = [(5, 1, "u", "a", 1, "x", 2), (5, 1, "u", "a", 1, "x", 2), (None, 1, "u", "lost", 1, "x", 2), (6, None, None, None, 1, "x", 2), (7, 0, "u", "y" * 300_000, 0, "", 0)]
    df = spark.createDataFrame(rows, schema)
    turns, convs = prefixes.shared_heads(prefixes.numbered_turns(df))
    want = spliced([(c, t, r, x) for c, t, r, x, *_ in rows if c is not None])
    assert rows_of(prefixes.trie(turns, convs)) == brute_trie(want)
    turns, convs = prefixes.shared_heads(prefixes.numbered_turns(df.limit(0)))
    assert prefixes.trie(turns, convs).count() == 0


def test_extents_by_scan():
    draw = np.random.default_rng(2)
    lcp = np.append(0, draw.integers(0, 5, 300))
    table = prefixes._least(lcp)
    at = np.repeat(np.arange(len(lcp)), 4)
    depth = np.tile(np.arange(1, 5), len(lcp))
    first, last = prefixes.extents(table, at, depth)
    for a, d, f, e in zip(at, depth, first, last):
        want_f = a
        while want_f > 0 and lcp[want_f] >= d:
            want_f -= 1
        want_e = a
        while want_e + 1 < len(lcp) and lcp[want_e + 1] >= d:
            want_e += 1
        assert (f, e) == (want_f, want_e)
    assert all(prefixes._range_least(table, np.array([a]), np.array([b]))[0] == lcp[a : b + 1].min() for a, b in combinations(range(0, 300, 37), 2))
