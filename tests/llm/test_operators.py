"""Operators against plain Python on small tables, and on odd rows."""

import collections
import hashlib
import random
import re
import tracemalloc
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larkspur.llm import arrays, bpe, exact, graph, jaccard, lines, quotes, setjoin, spans, suffixes, toxicity, urls, warc

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def lowered(text):
    return (text or "").encode().translate(LOWER)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# --- words ----------------------------------------------------------------------


@pytest.mark.parametrize("kind, pattern", [(arrays.NOT_SPACE, rb"[^\x20\x09-\x0D]+"), (arrays.ALNUM, rb"[0-9a-z\x80-\xff]+")])
def test_words_and_shingles(kind, pattern):
    texts = ["Hello wOrld a b c hello world", None, "", "abc", "abc", "x" * 100 + " y", "É é ab", "12 a,b;c", "a" * 65, "a b a b a b a b"]
    of = arrays.words(*arrays.utf8(pa.array(texts)), kind)
    values, bounds = arrays.shingles(of, 5)
    seen = {}
    for i, text in enumerate(texts):
        words = re.findall(pattern, lowered(text))
        got = of.hashes[of.bounds[i] : of.bounds[i + 1]]
        assert len(words) == len(got)
        assert all(seen.setdefault(w, g) == g for w, g in zip(words, got))
        sets = {tuple(words[j : j + 5]) for j in range(len(words) - 4)} or ({tuple(words)} if words else set())
        assert bounds[i + 1] - bounds[i] == len(sets)
        assert (np.diff(values[bounds[i] : bounds[i + 1]].astype(object)) > 0).all()
    assert len(set(seen.values())) == len(seen)
    k1, k2 = arrays.keys(of)
    assert k1[3] == k1[4] and len(set(zip(k1, k2))) == len({tuple(re.findall(pattern, lowered(t))) for t in texts})


# --- 1 --------------------------------------------------------------------------


def test_bpe_equals_the_library():
    class Shared:
        value = open(PATH, encoding="utf-8").read()

    rng = random.Random(5)
    texts = [None, "", "<|endoftext|>a<|endoftext|> b", "  a  b\n\n c\t", "a" * 3000, "don't we'll I'D 's's", "日本語テキスト 😀😀 é", "\x00\x01 \x7f", "a   b", "a  ", "a\n ", " ", "  a",
             "a\n \nb", "a \n b", "a\x1c \x1cb\x85c  d ", "x\x1f y ½ ² Ⅷ áb", "　 　"]
    texts += ["".join(rng.choice("abcdeeethio nrst   \n\x1c 'A1.é") for _ in range(rng.randint(1, 200))) for _ in range(800)]
    reference = Tokenizer.from_file(PATH)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
    out = [b for e in bpe._encode([batch], Shared) for b in bpe._decode([e], Shared)]
    got = [(ids, text) for b in out for ids, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
    for text, (ids, decoded) in zip(texts, got):
        expected = reference.encode(text or "", add_special_tokens=False).ids
        assert ids == expected and decoded == reference.decode(expected, skip_special_tokens=False)


def test_bpe_store_forgets_nothing_it_needs(monkeypatch):
    class Shared:
        value = open(PATH, encoding="utf-8").read()

    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    texts = [f"w{i} alpha beta{i % 5} " + "long" * 30 for i in range(60)]
    reference = Tokenizer.from_file(PATH)
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t])], ["doc_id", "text"]) for i, t in enumerate(texts)]
    got = [b.column(1).to_pylist()[0] for b in bpe._encode(batches, Shared)]
    assert got == [reference.encode(t).ids for t in texts]


def test_bpe_odd_rows(odd, empty):
    out = bpe.decode(bpe.encode(odd, PATH), PATH).collect()
    assert sorted(r.decoded for r in out) == sorted((r.text or "") for r in odd.collect())
    assert bpe.decode(bpe.encode(empty, PATH), PATH).count() == 0
    assert sorted(map(repr, bpe.round_trip(odd, PATH).collect())) == sorted(map(repr, out)) and bpe.round_trip(empty, PATH).count() == 0


def test_decoding_goes_by_few_tokens(monkeypatch):
    monkeypatch.setattr(bpe, "DECODED_TOKENS", 3)
    ids = [[0, 1], [], [2, 3, 4, 5], [6], [7, 8], []]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
    spelled = {i: bytes([97 + i]) for i in range(9)}
    parts = list(bpe._texts([batch, batch.slice(1, 3), batch.slice(0, 0)], spelled))
    assert [p.num_rows for p in parts[:3]] == [2, 1, 3]
    assert [x for p in parts for x in p.column(2).to_pylist()] == ["ab", "", "cdef", "g", "hi", "", "", "cdef", "g"]
    assert [x for p in parts for x in p.column(1).to_pylist()] == ids + ids[1:4]


# --- 2 --------------------------------------------------------------------------


def test_spans_against_brute_force(spark):
    docs = documents(spark).select("doc_id", "text").collect()
    words = lambda s: tuple(re.findall(rb"[0-9a-z\x80-\xff]+", lowered(s)))
    places = collections.defaultdict(list)
    worded = {}
    for doc, text in docs:
        parts = [w for w in map(words, spans.sentences(text)) if w]
        worded[doc] = parts
        for i in range(len(parts) - 1):
            if len(parts[i]) + len(parts[i + 1]) >= 20:
                places[(parts[i], parts[i + 1])].append((doc, i))
    gone = {d: set() for d, _ in docs}
    for found in places.values():
        for doc, i in sorted(found)[1:]:
            gone[doc] |= {i, i + 1}
    result = {r.doc_id: r for r in spans.remove_repeats(documents(spark)).collect()}
    assert {d: (r.n_sentences, r.n_removed) for d, r in result.items()} == {d: (len(worded[d]), len(gone[d])) for d in worded}
    for doc, text in docs:
        kept = [w for i, w in enumerate(worded[doc]) if i not in gone[doc]]
        assert [w for w in map(words, spans.sentences(result[doc].text)) if w] == kept or gone[doc]
        assert gone[doc] or result[doc].text == text
    assert sum(map(len, gone.values())) > 0


def test_spans_cover_short_and_single_sentences(spark):
    """Passages of short sentences, of one long sentence, and with short sentences at their ends go whole, between any neighbours."""
    rng = random.Random(6)
    sentence = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) + "."
    sizes = [[9] * 7, [3, 4, 2] * 8, [60], [50], [2, 3, 40, 4, 1], [1, 30, 1], [15, 5], [1] * 20, [30, 60, 2]]
    passages = [[sentence(n) for n in size] for size in sizes]
    frames = [([sentence(rng.choice([2, 7, 30])) for _ in range(3)], [sentence(rng.choice([1, 6, 30])) for _ in range(3)]) for _ in range(3 * len(sizes))]
    docs = [(i, " ".join([*before, *passages[i % len(sizes)], *after])) for i, (before, after) in enumerate(frames)]
    short = [sentence(6), sentence(6)]  # too few words for a span
    docs += [(100 + i, " ".join([sentence(30), *short, sentence(30)])) for i in range(2)] + [(200, " ".join([sentence(4), sentence(49)])), (None, None)]
    docs += [(200, docs[0][1])]  # a text of its own and a copy with one id
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    out = collections.defaultdict(list)
    for r in spans.remove_repeats(df, long_words=spans.LONG_WORDS).collect():
        out[r.doc_id].append(r)
    for i, (before, after) in enumerate(frames):
        expected = docs[i][1] if i < len(sizes) else " ".join([*before, *after])
        assert [r.text for r in out[i]] == [expected]
    assert [r.n_removed for i in (100, 101) for r in out[i]] == [0, 0] and out[None][0].text == ""
    assert sorted((r.n_sentences, r.n_removed) for r in out[200]) == [(2, 0), (13, 13)]


def spans_of(size):
    """The spans of the query's own mode among the sentences of one text: the shortest runs of two or more with 20 words, and long sentences."""
    out = set()
    for i in range(len(size)):
        for j in range(i + 2, len(size) + 1):
            if sum(size[i:j]) >= 20:
                out.add((i, j))
                break
        for k in range(i - 1, -1, -1):
            if sum(size[k : i + 1]) >= 20:
                out.add((k, i + 1))
                break
        if size[i] >= 50:
            out.add((i, i + 1))
    return out


def test_spans_of_the_query_against_brute_force(spark):
    """Short and long sentences, shared and null ids, equal rows."""
    rng = random.Random(12)
    pool = [" ".join(f"w{rng.randrange(60)}" for _ in range(n)) + "." for n in (1, 3, 5, 9, 14, 21, 50, 55) for _ in range(3)]
    docs = [(rng.choice([None, *range(25)]), " ".join(rng.choices(pool, k=rng.randint(0, 9)))) for _ in range(60)]
    docs += rng.sample(docs, 12) + [(None, None), (3, None)]
    words = lambda s: tuple(re.findall(rb"[0-9a-z\x80-\xff]+", lowered(s)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = [(r.doc_id, r.text, r.h) for r in df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    seen, want = {}, []
    for number, (doc, text, h) in enumerate(rows):
        parts = [w for w in map(words, spans.sentences(text)) if w]
        again, gone = number > 0 and rows[number - 1] == rows[number], set()
        for a, b in sorted(spans_of([len(w) for w in parts])):
            earlier = seen.setdefault(tuple(parts[a:b]), (number, a, b))
            if again or earlier != (number, a, b):
                gone |= set(range(a, b))
        want.append((doc, len(parts), len(gone), [w for i, w in enumerate(parts) if i not in gone]))
    got = [(r.doc_id, r.n_sentences, r.n_removed, [w for w in map(words, spans.sentences(r.text)) if w]) for r in spans.remove_repeats(df, long_words=spans.LONG_WORDS).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and 0 < sum(w[2] for w in want) < sum(w[1] for w in want)


def test_no_text_is_lost_by_a_shared_id(spark):
    text = lambda k: " ".join(f"a{k}x{i} b c d e f g h i j k." for i in range(3))
    rows = [(1, text(1)), (7, text(1)), (7, text(2)), (8, text(3)), (8, text(3)), (None, text(4)), (None, text(4)), (None, text(5))]
    out = [(r.doc_id, r.n_removed, r.text) for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), long_words=spans.LONG_WORDS).collect()]
    assert sorted(map(repr, out)) == sorted(map(repr, [(1, 0, text(1)), (7, 3, ""), (7, 0, text(2)), (8, 0, text(3)), (8, 3, ""), (None, 0, text(4)), (None, 3, ""), (None, 0, text(5))]))


def test_a_hot_span_is_dealt_to_several_tasks(spark):
    line = "one two three four five six seven eight nine ten. " * 2
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, line).otherwise(F.lit("short.")).alias("text"))
    assert spans.remove_repeats(df, long_words=spans.LONG_WORDS).where("n_removed = 2").count() == 1499


def test_spans_odd_rows(odd, empty):
    out = spans.remove_repeats(odd).collect()
    assert len(out) == odd.count()
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by[3].text == "" and by[9].n_removed >= 3999 and by[8].n_removed == 0
    assert spans.remove_repeats(empty).count() == 0


# --- 3 --------------------------------------------------------------------------


def brute_matches(docs, items, window):
    words = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", lowered(t))
    out = {}
    for key, text in docs:
        own, hit, found = words(text), set(), set()
        for item, item_text in items:
            theirs = words(item_text)
            size = min(window, len(theirs))
            for i in range(len(theirs) - size + 1 if size else 0):
                for j in range(len(own) - size + 1):
                    if own[j : j + size] == theirs[i : i + size]:
                        hit |= set(range(j, j + size))
                        found.add(str(item))
        out[key] = (len(own), len(hit), sorted(found))
    return out


def test_items_are_prepared_once(monkeypatch):
    """A full block of items costs a shard little beyond its own text."""
    import time

    rng = np.random.default_rng(1)
    items = suffixes.read_items([" ".join(f"w{x}" for x in rng.integers(0, 50_000, 200)) for _ in range(4_000)], list(map(str, range(4_000))))
    shard = arrays.words(*arrays.utf8(pa.array([" ".join(f"w{x}" for x in rng.integers(0, 50_000, 2_000)) for _ in range(100)] + ["a b"], pa.string())), arrays.ALNUM)
    suffixes.matches(shard, items, 10)
    sorted_, unique = [], np.unique
    monkeypatch.setattr(np, "unique", lambda x, *more, **kw: sorted_.append(len(x)) or unique(x, *more, **kw))
    start = time.process_time()
    suffixes.matches(shard, items, 10)
    assert all(n < 10_000 for n in sorted_) and time.process_time() - start < 2


@pytest.mark.parametrize("block_bytes", [16 << 20, 60])
def test_decontamination_against_brute_force(spark, block_bytes):
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "été", "7"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))) for i in range(60)] + [(60, None), (61, "")]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 8)))) for i in range(12)] + [(12, None), (12, "alpha beta"), (13, docs[0][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, matches string")
    found = suffixes.find_matches(df, spark.createDataFrame(items + [(None, "gamma gamma")], "item_id long, text string"), window=5, block_bytes=block_bytes)
    got = {r.doc_id: (r.n_words, r.n_hit, sorted({m.item_id for m in r.matches})) for r in found.collect()}
    assert got == brute_matches(docs, items, 5)


def test_longest_matches_and_places(spark):
    text = " ".join(f"w{i}" for i in range(100))
    df = spark.createDataFrame([(1, f"start {text} end")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "other " + " ".join(f"w{i}" for i in range(30, 75)) + " words")], "item_id string, text string")
    (match,) = suffixes.find_matches(df, items).first().matches
    assert tuple(match) == ("a", 31, 1, 45)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    codes = rng.integers(1, 3, 200)
    codes[[50, 120]] = 0
    gaps = np.append(np.flatnonzero(codes == 0), len(codes))
    ends = gaps[np.searchsorted(gaps, np.arange(len(codes)))]
    order = suffixes.suffix_array(codes, ends, 200)
    tails = [tuple(codes[i : ends[i]]) for i in order]
    assert tails == sorted(tails)


@pytest.mark.parametrize("block_bytes", [16 << 20, 20])
def test_items_without_id_contaminate(spark, block_bytes):
    """They count everywhere but in the digest of the ids, as in the query's SQL."""
    sha = lambda ids: hashlib.sha256(ids.encode()).hexdigest()
    df = spark.createDataFrame([(1, "x alpha beta y"), (2, "x gamma delta alpha beta epsilon zeta"), (3, "gamma delta"), (4, "clean"), (None, "alpha beta")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "alpha beta"), (None, "epsilon zeta"), (7, "gamma delta"), (None, None), (None, "")], "item_id long, text string")
    out = suffixes.contamination(df, items, block_bytes=block_bytes).collect()
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out}
    assert got == {1: (2, 1, sha(""), True), 2: (6, 2, sha("7"), True), 3: (2, 1, sha("7"), True), 4: (0, 0, sha(""), False), None: (2, 1, sha(""), True)}


def test_decontamination_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "no id at all")], "item_id long, text string")
    out = suffixes.contamination(odd, items).collect()
    assert len(out) == odd.count() and [r.n_items for r in out if r.contaminated] == [1]
    assert suffixes.contamination(empty, items).count() == 0
    assert suffixes.contamination(odd, items.limit(0)).where("contaminated").count() == 0


# --- 4 --------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [exact.TABLE_BYTES, 2_000])
def test_exact_dedup_and_its_spilling(spark, limit):
    rng = random.Random(2)
    data = [(i, rng.choice(["Alpha", "alpha", "beta", None, "", "x" * 900]) if rng.random() < 0.6 else f"text {i % 70} " * 9) for i in range(400)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    groups = collections.defaultdict(list)
    for i, t in data:
        groups[lowered(t)].append(i)
    expected = {i: (max(g), len(g), i == max(g), hashlib.sha256(t).hexdigest()) for t, g in groups.items() for i in g}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.deduplicate(df, limit=limit).collect()}
    assert got == expected


def test_exact_dedup_odd_rows(odd, empty):
    out = exact.deduplicate(odd).collect()
    assert len(out) == odd.count()
    assert sum(r.kept for r in out) == len({r.text_sha256 for r in out})
    (twice,) = {(r.keep_id, r.group_size) for r in out if r.doc_id == 2}
    assert twice == (2, 3) and [r.kept for r in out if r.doc_id == 2].count(True) == 1
    assert {r.keep_id for r in out if r.doc_id is None} == {None, 4}
    assert exact.deduplicate(empty).count() == 0


@pytest.mark.parametrize("limit", [exact.TABLE_BYTES, 3_000, 300])
def test_copies_take_no_memory(limit):
    """Rows come out as they are read, before the next is asked for; a text's copies are one entry, also after spilling."""
    rng = random.Random(1)
    texts = [f"text {i}" * 10 for i in range(40)] + ["hot"]
    read, seen, out = [], collections.defaultdict(list), []

    def records():
        for row in range(60_000):
            text = "hot" if row % 3 else rng.choice(texts)
            seen[text].append((int(row % 5 > 0), (row * 7919) % 1000 if row % 5 else 0, row))
            read.append(row)
            yield exact.xxhash.xxh3_128_intdigest(text.encode()), text.encode(), (0, *seen[text][-1], 0, 0)

    waiting = 0
    for made in exact._one_by_one(records(), limit):
        out.append(made)
        waiting = max(waiting, len(read) - len(out))
    rows = [r for r in out if r[4] is None]
    known = {r[4]: r for r in out if r[4] is not None}
    assert len(rows) == 60_000 and sorted(r[1] for r in rows) == list(range(60_000))
    assert {t: (int(k[5]), k[6], k[7], k[8]) for t, k in known.items()} == {t: (*max(v), len(v)) for t, v in seen.items()}
    uids = collections.defaultdict(set)
    for r in rows:
        uids[r[3]].add(r[2])
    assert all(uids[k[3]] == {k[2]} for k in known.values()) and len({k[2] for k in known.values()}) == len(known)
    assert limit < 5_000 or waiting <= 1


def test_a_million_copies_stay_below_the_limit():
    import tracemalloc

    records = ((k, b"one" if k else b"two", (0, 1, i, i, 0, 0)) for i in range(1_000_000) for k in (i % 2,))
    tracemalloc.start()
    rows = sum(1 for _ in exact._one_by_one(records, 1 << 20))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1_000_002 and peak < 1 << 20


def test_open_addressing_compares_content():
    table = exact.ContentTable(4)
    for i in range(200):
        table.add(7, str(i % 50).encode(), [(i,)])  # all hashes equal
    assert len(table.contents) == 50 and all(len(m) == 4 for _, m in table)


# --- 5 --------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    body = "päge " * 400
    pages = [(1, "http://a/", body), (2, "http://b/\r\nX: y", body), (3, None, "small"), (4, "http://c/", "small"), (5, "http://d/", None), (6, "x", body.upper()), (2, "http://b/", body), (None, "u", body)]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, path string").repartition(3)
    out = warc.archive(df, folder=str(tmp_path)).collect()
    assert len(out) == len(pages)
    payload = {p: (h or "").encode() for p, _, h in pages}
    for r in out:
        assert (r.payload_bytes, r.payload_digest) == (len(payload[r.page_id]), hashlib.sha1(payload[r.page_id]).hexdigest())
    assert sorted(((r.page_id or 0), r.record_type, r.refers_to) for r in out) == [
        (0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (2, "response", None), (3, "response", None), (4, "response", None), (5, "response", None), (6, "response", None),
    ]
    assert warc.archive(df.limit(0), folder=str(tmp_path / "none")).count() == 0


def test_warc_members_stand_alone(spark, tmp_path):
    import gzip
    import json

    df = spark.createDataFrame([(i, f"http://h/{i}", "z" * (i * 700)) for i in range(40)], "page_id long, url string, html string").withColumn("refers_to", F.lit(None).cast("long"))
    raw = warc.write_archives(df, str(tmp_path / "raw"), limit=50_000)
    assert raw.count() > 1
    members = warc.normalise(raw, str(tmp_path / "members")).collect()
    found = 0
    for path, n in members:
        data = open(path, "rb").read()
        index = [json.loads(x) for x in open(path + ".idx")]
        assert len(index) == n and index[-1]["offset"] + index[-1]["length"] == len(data)
        for e in index:
            assert gzip.decompress(data[e["offset"] : e["offset"] + e["length"]]).startswith(b"WARC/1.1\r\n")
            found += 1
    assert found == 40


# --- 6 and 7 --------------------------------------------------------------------


def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", lowered(text))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def similar(a, b):
    return bool(a) and 100 * len(a & b) >= 75 * len(a | b)


def near_copies(seed):
    """Groups of near copies with several centres, short texts, shared passages."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 400)}"
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(5):
        base = [word() for _ in range(rng.randint(8, 80))]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [" ".join(passage + [word() for _ in range(rng.randint(3, 30))]) for _ in range(40)]
    texts += [" ".join(word() for _ in range(rng.randint(0, 6))) for _ in range(40)] + [None, "", "one two", "One  two"]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_against_brute_force(spark, seed):
    data = near_copies(seed)
    sets = {i: shingle_set(t) for i, t in data}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sets, 2):
        if similar(sets[a], sets[b]) and root(a) != root(b):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {i: (len(s), root(i)) for i, s in sets.items()}


def few_shared(n, words, size=150):
    """Texts that share some shingles with very many others each, and near copies of a few of them."""
    rng = random.Random(n)
    texts = [[rng.randrange(words) for _ in range(size)] for _ in range(n)]
    texts += [[*t[:60], 99, *t[60:]] for t in texts[:20]]
    return [(i, " ".join(f"w{x}" for x in t)) for i, t in enumerate(texts)]


def sets_of(spark, data, rule=jaccard.Rule()):
    df = spark.createDataFrame(data, "doc_id long, text string")
    rows = [(i, len(s), sorted(hash(x) for x in s)) for i, s in ((i, shingle_set(t)) for i, t in data)]
    return df, spark.createDataFrame(rows, "v long, n long, tokens array<long>")


def test_depths_are_chosen_by_measured_overlaps(spark, monkeypatch):
    """Lists whose members share one token ask for longer prefixes, lists of near copies don't; fewer pairs are verified and no link is lost."""
    data = few_shared(400, 7)
    _, sets = sets_of(spark, data)
    sets = jaccard.cut(sets)
    verified, linked = [], setjoin.linked
    monkeypatch.setattr(setjoin, "linked", lambda pairs, *more: verified.append(pairs.count()) or linked(pairs, *more))
    roots = {}
    for depths in (jaccard.DEPTHS, (1,)):
        roots[depths] = sorted(map(tuple, jaccard._links(sets, jaccard.Rule(), depths=depths).collect()))
        verified.append(None)
    deep, plain = verified[:3], verified[4:7]
    assert roots[jaccard.DEPTHS] == roots[(1,)] == [(400 + i, i) for i in range(20)]
    assert sum(deep) < sum(plain) / 10 and plain[2] > 1000
    rare = setjoin.rarity(sets).mapInArrow(jaccard.partial(jaccard._prefixes, rule=jaccard.Rule(), deepest=8), ", ".join(f"{c} {k}" for c, k in jaccard.POSTING.items()))
    depths = collections.Counter(r.depth for r in jaccard.chosen(jaccard.cut(rare), jaccard.Rule()).select("v", "depth").distinct().collect())
    assert sum(n for k, n in depths.items() if k > 1) > 100


@pytest.mark.parametrize("seed", [1, 2, 5])
def test_links_at_every_depth(spark, monkeypatch, seed):
    """Whatever depths sets ask for, also unlike ones, the components are those of brute force."""
    data = near_copies(seed)
    sets = {i: shingle_set(t) for i, t in data}
    want = {i: i for i in sets}
    for a, b in combinations(sets, 2):
        if similar(sets[a], sets[b]) and want[a] != want[b]:
            low, high = sorted((want[a], want[b]))
            want = {i: low if r == high else r for i, r in want.items()}
    forced = lambda postings, rule, depths: postings.withColumn(
        "depth", F.least(F.pmod(F.xxhash64("v"), F.lit(4)) * 2 + 1, F.ceil(F.col("n") * 0.75)).cast("int")
    ).where("level <= depth")
    monkeypatch.setattr(jaccard, "chosen", forced)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == want


def test_jaccard_odd_rows(odd, empty):
    out = jaccard.near_duplicates(odd).collect()
    assert len(out) == odd.count()
    by = collections.defaultdict(set)
    for r in out:
        by[r.doc_id].add((r.n_shingles, r.component_id))
    assert by[2] == {(4, 1)} and by[3] == by[4] == by[5] or {c for _, c in by[4]} == {4}
    assert by[9] and {c for _, c in by[9]} == {8} and {c for _, c in by[7]} == {6}
    assert jaccard.near_duplicates(empty).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 40), (40, 45), (60, 60), (70, 71), (71, 70), (None, 3)]
    got = dict(rows_of(graph.components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {i: 0 for i in range(1, 31)} | {50: 40, 45: 40, 71: 70}


def test_lines_against_brute_force(spark):
    rng = random.Random(8)
    texts = [t for _, t in near_copies(3)]
    data = [(i, None if i == 7 else "\n".join(rng.choice(texts) or "" for _ in range(rng.randint(0, 6)))) for i in range(60)]
    places = [((i, n), line) for i, t in data for n, line in enumerate((t or "").split("\n"))]
    sets = [shingle_set(x) for _, x in places]
    expected = {p: any(similar(sets[j], sets[k]) for j in range(k)) for k, (p, _) in enumerate(places)}
    df = spark.createDataFrame([(i, t, 0) for i, t in data], "doc_id long, text string, line int")
    got = {(r.doc_id, r.line): r.removed for r in lines.line_flags(df).collect()}
    assert got == expected
    result = {r.doc_id: r for r in lines.without_repeats(df).collect()}
    for i, t in data:
        kept = [x for n, x in enumerate((t or "").split("\n")) if not expected[(i, n)]]
        assert result[i].text == "\n".join(kept) and result[i].n_removed == sum(expected[(i, n)] for n in range(result[i].n_lines))


def test_no_line_is_lost_by_a_shared_id(spark):
    a, b, c = ("\n".join(f"{x} line {i} of words that nobody else has in this order {x}{i}" for i in range(2)) for x in "abc")
    rows = [(1, a), (7, a), (7, b), (8, c), (8, c), (None, "lone words\n\n"), (None, "lone words\n\n"), (None, "quite other words\nof which nobody knows")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = sorted((repr(r.doc_id), r.n_removed, r.text) for r in lines.without_repeats(df).collect())
    texts = collections.defaultdict(list)
    for i, n, text in out:
        texts[i].append((n, text))
    assert texts["1"] == [(0, a)] and texts["7"] == [(0, b), (2, "")] and texts["8"] == [(0, c), (2, "")]
    assert (0, "lone words\n\n") in texts["None"] and (1, "\n") in texts["None"]
    flags = collections.Counter((r.doc_id, r.removed) for r in lines.line_flags(df).collect())
    assert flags[8, True] == 2 and flags[8, False] == 2 and sum(flags.values()) == 18
    assert sum(n for (_, removed), n in flags.items() if removed) == sum(n for _, n, _ in out)


def test_lines_odd_rows(odd, empty):
    out = lines.without_repeats(odd).collect()
    assert len(out) == odd.count()
    assert {r.doc_id: r.text for r in out}[14] == "a\nb\n"
    assert lines.without_repeats(empty).count() == 0


# --- 8 --------------------------------------------------------------------------


def test_url_rules(spark):
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("Example.net", "/en/", "allow"), ("example.net", "/en/x", "block"), ("org", "/fr/", "allow"), ("org", "/fr/", "block"), (None, "/", "block"), ("", "", "allow")],
        "host string, path string, verdict string",
    )
    urls_ = {
        "http://example.net/en/y": ("example.net", "/en/y", "Example.net/en/".lower(), "allow"), "http://WWW.example.NET/en/xyz?q#f": ("www.example.net", "/en/xyz", "example.net/en/x", "block"),
        "https://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"), "ftp://a.org/fr/": ("a.org", "/fr/", "org/fr/", "block"), "http://a.org/FR/": ("a.org", "/FR/", None, "deny"),
        "http://x.net": ("x.net", "", None, "deny"), "http://x.net?a=/": ("x.net", "", None, "deny"), "no scheme": ("", "", "", "allow"), None: ("", "", None, "deny"),
        "http://" + "a." * 3000 + "net/" + "p" * 5000: ("a." * 3000 + "net", "/" + "p" * 5000, "net/", "block"),
    }
    df = spark.createDataFrame([(i // 2, u, "c") for i, u in enumerate([u for u in urls_ for _ in (0, 1)])], "page_id long, url string, rule string")
    out = urls.verdicts(df, rules, default="deny").collect()
    assert len(out) == 2 * len(urls_)
    assert {(r.host, r.path, r.rule, r.verdict) for r in out} == set(urls_.values())
    assert urls.verdicts(df.limit(0), rules).count() == 0


# --- 9 --------------------------------------------------------------------------


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(4)
    weights, start, moves = rng.normal(size=5), 0.3, rng.normal(size=(2, 2))
    forward, backward = toxicity.forward_backward(np.exp(weights)[:, None], np.ones((5, 1), dtype=bool), start, moves)
    total, toxic = 0.0, np.zeros(5)
    for path in np.ndindex(*[2] * 5):
        p = np.exp(sum(w for w, y in zip(weights, path) if y) + start * path[0] + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += p
        toxic += p * np.array(path)
    odds = (forward * backward)[:, 0]
    assert np.allclose(odds / (1 + odds), toxic / total)


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    from larkspur.llm.queries import op9_toxicity

    scored = op9_toxicity(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("predicted", "toxic").collect()
    right = sum(p == y for p, y in scored)
    assert right / len(scored) > 0.97  # a few labels of these tables follow nothing in the text


def test_toxicity_odd_rows(spark, odd, empty):
    texts = pa.array(["you are a moron here", "what a lovely day", "moron. really", "nice words only"] * 30)
    model = toxicity.fit(texts, np.array([1.0, 0.0, 1.0, 0.0] * 30))
    data = spark.createDataFrame([(1, "Çé a MORON spoke"), (2, "nice day")], "doc_id long, text string")
    first, second = toxicity.scores(data, model).orderBy("doc_id").collect()
    assert (first.predicted, second.predicted) == (1, 0) and [(s.start, s.end) for s in first.spans] == [(5, 10)]
    out = toxicity.scores(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert toxicity.scores(empty, model).count() == 0


# --- 10 -------------------------------------------------------------------------


def test_quotations_build_the_tree(spark):
    talk = [
        (1, 0, "a", "The first question is about apples.\nAnd a second line."), (1, 1, "b", "I like pears more."),
        (1, 2, "c", "> The first  question is about APPLES.\nApples are red."), (1, 3, "d", "On Monday b wrote:\n> I like pears more.\nPears are green."),
        (1, 4, "e", "> Apples are red.\n>> The first question is about apples.\nSome are green."), (1, 5, "f", "Right."),
        (2, 0, "a", "> quoted from nowhere\nhello"), (None, 0, "a", None), (None, 0, "a", None), (2, 1, "b", ""),
    ]
    df = spark.createDataFrame([(*r, 0, "k") for r in talk], "conv_id long, turn long, role string, text string, position int, key string")
    out = quotes.reply_ordered(df).orderBy("conv_id", "position").collect()
    first = [(r.turn, r.reply_to, r.branch) for r in out if r.conv_id == 1]
    assert first == [(0, None, 0), (1, 0, 0), (3, 1, 1), (2, 0, 1), (4, 2, 2), (5, 4, 2)]
    assert {r.turn: r.text for r in out if r.conv_id == 1}[3] == "Pears are green."
    assert [(r.turn, r.reply_to) for r in out if r.conv_id == 2] == [(0, None), (1, 0)]
    assert [(r.position, r.text) for r in out if r.conv_id is None] == [(1, ""), (2, "")]
    assert quotes.reply_ordered(df.limit(0)).count() == 0


def test_quotations_of_a_hot_line(spark, monkeypatch):
    """Only quoted units are ordered, and a line that a whole conversation repeats is cut into segments, with the same result."""
    talk = [(None, i, "a", f"> thanks\nanswer {i}" if i % 7 == 6 else f"> line {i - 3}\nthanks" if i % 5 == 4 else f"thanks\nline {i}") for i in range(120)]
    df = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    seen = []
    running_max = quotes.running_max
    monkeypatch.setattr(quotes, "running_max", lambda rows, *more: seen.append(rows) or running_max(rows, *more))
    plain = sorted(rows_of(quotes.reply_ordered(df)))
    asked = {r.unit for r in seen[0].where("level IS NOT NULL").collect()}
    assert {r.unit for r in seen[0].where("level IS NULL").collect()} <= asked and quotes._unit("thanks") in asked
    monkeypatch.setattr(quotes, "running_max", lambda *more: running_max(*more, 10))
    assert sorted(rows_of(quotes.reply_ordered(df))) == plain
    turns = {r[2]: r[5] for r in plain}
    lately = lambda i: max(j for j in range(i) if talk[j][3].endswith("thanks") or talk[j][3].startswith("thanks"))
    assert all(turns[i] == lately(i) for i in range(6, 120, 7))


def brute_order(talk):
    """(position, reply_to, branch) of the messages (own, units, quoted) of one conversation, by walking its tree."""
    parents, leaves = [None], [False]
    for i, (_, _, quoted) in enumerate(talk):
        if i == 0:
            continue
        votes = collections.defaultdict(list)
        for level, unit in quoted:
            had = [j for j in range(i) if unit in talk[j][1]]
            if had:
                votes[had[-1]].append(level)
        best = max(votes, key=lambda j: (-min(votes[j]), len(votes[j]), j), default=i - 1)
        parents.append(best)
        leaves.append(best != i - 1)
    children = collections.defaultdict(list)
    for i, p in enumerate(parents):
        children[p].append(i)
    out, stack = {}, [(0, 0)]
    while stack:
        i, branch = stack.pop()
        out[i] = (len(out) + 1, parents[i], branch)
        stack += [(c, branch + leaves[c]) for c in reversed(children[i])]
    return out


@pytest.mark.parametrize("max_rows", [None, 6])
def test_quotations_against_brute_force(spark, monkeypatch, max_rows):
    """Random threads with quotes of quotes, of passages, of repeated lines and of nothing; also where conversations are cut into segments."""
    rng = random.Random(21)
    said, rows = {}, []
    for c in (None, *range(14)):
        texts = []
        for turn in range(rng.randint(1, 24)):
            lines_ = [f"line {rng.randrange(40)} of c{c}" for _ in range(rng.randint(0, 3))]
            if texts and rng.random() < 0.5:
                source = rng.choice(texts)
                lines_ = [f"> {x}" for x in source.split("\n")[: rng.randint(1, 4)]] + lines_
                if rng.random() < 0.3:
                    lines_ = ["somebody wrote:", *lines_]
            texts.append("\n".join(lines_) if rng.random() < 0.95 else None)
            texts[-1] = texts[-1] or ""
            rows.append((c, turn, "u", texts[-1]))
        said[c] = [quotes.parse(t) for t in texts]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    if max_rows:
        monkeypatch.setattr(quotes.ordered, "rows_per_task", lambda *_: max_rows)
    got = collections.defaultdict(dict)
    for r in quotes.reply_ordered(df).collect():
        got[r.conv_id][r.turn] = (r.position, r.reply_to, r.branch)
        assert r.text == said[r.conv_id][r.turn][0]
    want = {c: brute_order(talk) for c, talk in said.items()}
    assert got == want and max(b for w in want.values() for _, _, b in w.values()) >= 2


def test_quotations_of_a_deep_thread(spark):
    """Every message quotes the one two before it: as many branches as messages, numbered without paths; null turns come first."""
    talk = [(1, None, "a", "an early one")] + [(1, i, "a", f"> m{i - 2}\nm{i}" if i > 1 else f"m{i}") for i in range(300)]
    out = {r.turn: r for r in quotes.reply_ordered(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")).collect()}
    assert len(out) == 301 and out[None].position == 1
    want = brute_order([quotes.parse(t) for *_, t in talk])
    assert {(-1 if k is None else k) + 1: (r.position, r.branch) for k, r in out.items()} == {i: (p, b) for i, (p, _, b) in want.items()}


def test_quotations_keep_every_message(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    out = quotes.reply_ordered(table).collect()
    assert sorted((r.conv_id, r.turn, r.text) for r in out) == sorted((r.conv_id, r.turn, r.text) for r in table.collect())
    assert all(r.position == r.turn + 1 for r in out)


# --- shared steps ---------------------------------------------------------------


def test_screening_in_many_buckets(spark, monkeypatch):
    """However the tokens are dealt, no class that links is lost."""
    data = near_copies(4)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(setjoin, "BUCKET_TOKENS", 50)
    out = {r.doc_id: r.component_id for r in jaccard.near_duplicates(df).collect()}
    sets = {i: shingle_set(t) for i, t in data}
    assert all(out[a] == out[b] for a, b in combinations(sets, 2) if similar(sets[a], sets[b]))


@pytest.mark.parametrize("most,buckets", [(3, 1), (3, 4), (1, 2), (1 << 16, 1), (1 << 16, 50)])
def test_screening_counts_every_token(monkeypatch, most, buckets):
    """What each unit of several pieces shares with others, counted in buckets and in entries of few tokens."""
    monkeypatch.setattr(setjoin, "MOST", most)
    rng = random.Random(4)
    pool = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randint(0, 40))) for _ in range(25)]
    batches = [pa.RecordBatch.from_arrays([pa.array([rng.choice(pool) if rng.random() < 0.7 else None for _ in range(9)], pa.string())], ["text"]) for _ in range(4)]
    rule = setjoin.Rule()
    rows = [r for b in setjoin._post(iter(batches), setjoin.whole, rule, buckets) for r in b.to_pylist()]
    got = collections.Counter()
    for bucket in {r["bucket"] for r in rows}:
        found = setjoin._match(setjoin.pd.DataFrame([r for r in rows if r["bucket"] == bucket]))
        for k, n in zip(found["k1"], found["shared"]):
            got[k] += n
    holders, prefix = collections.Counter(), collections.defaultdict(list)
    for i, b in enumerate(batches):
        of = arrays.words(*setjoin.whole(b.column(0)), arrays.NOT_SPACE)
        k1, _ = arrays.keys(of)
        values, bounds = arrays.shingles(of, rule.size)
        for u in {int(k): u for u, k in reversed(list(enumerate(k1)))}.values():  # copies in a piece are one unit
            n = int(bounds[u + 1] - bounds[u])
            own = values[bounds[u] : bounds[u + 1]][: n - rule.least(n) + rule.levels(n)].tolist() if n else []
            prefix[int(k1[u])].append(own)
            holders.update(own)
    want = {k: sum(holders[t] > 1 for own in lists for t in own) for k, lists in prefix.items()}
    assert {k: n for k, n in got.items() if n} == {k: n for k, n in want.items() if n} and sum(want.values()) > 50


@pytest.mark.parametrize("step", [1, 2, 3, 7, 100])
def test_runs_join_sets_over_batches(step):
    """Sets of one row, of several batches and of exactly a batch come out whole, in order, once."""
    sizes = [1, 5, 3, 3, 1, 9, 2]
    v = np.repeat(np.arange(len(sizes)) * 10, sizes)
    rows = pa.RecordBatch.from_arrays([pa.array(v), pa.array(v + 100), pa.array(np.arange(len(v))), pa.array(np.arange(len(v)) * 7)], ["v", "n", "df", "t"])
    batches = [rows.slice(0, 0), *(rows.slice(i, step) for i in range(0, len(v), step))]
    got = [r for b in setjoin.runs(batches) for r in b.to_pylist()]
    assert [(r["v"], r["n"], len(r["rare"])) for r in got] == [(i * 10, i * 10 + 100, s) for i, s in enumerate(sizes)]
    assert [x for r in got for x in r["rare"]] == [{"df": i, "t": i * 7} for i in range(len(v))]
    assert list(setjoin.runs([rows.slice(0, 0)])) == []


def test_key_filter_loses_no_key(spark, monkeypatch):
    """Also where the table is so small that most other rows pass."""
    keys = spark.range(500).select(F.xxhash64("id").alias("k1"))
    rows = spark.range(3000).select(F.xxhash64("id").alias("k1"), "id")
    for slots in (1, 8, 1 << 18):
        monkeypatch.setattr(setjoin, "FILTER_SLOTS", slots)
        kept = setjoin.may_be_in(rows, keys)
        assert kept.columns == ["k1", "id"]
        assert kept.where("id < 500").count() == 500
    assert kept.count() < 600
    assert setjoin.may_be_in(rows, keys.where("k1 IS NULL")).count() == 0


def test_match_holds_little_beside_its_bucket(monkeypatch):
    """Sorting a bucket's tokens takes a few bytes a token beside them, not arrays of 64 bits over all of them."""
    monkeypatch.setattr(setjoin, "SLICE_TOKENS", 1 << 14, raising=False)
    units, tokens = 100, 1 << 14
    chooser = np.random.default_rng(3)
    pieces = [chooser.choice(1 << 22, tokens, replace=False).astype(np.uint32) for _ in range(16)]
    rows = [
        {"units": np.arange(1 + units * p, 1 + units * (p + 1)).tobytes(), "counts": np.full(units, tokens // units, np.uint16).tobytes(),
         "tokens": t[: tokens // units * units].tobytes(), "anonymous": 0, "bucket": 0}
        for p, t in enumerate(pieces)
    ]
    frame = setjoin.pd.DataFrame(rows)
    tracemalloc.start()
    found = setjoin._match(frame)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    held = collections.Counter(t for r in rows for t in np.frombuffer(r["tokens"], np.uint32).tolist())
    assert found["shared"].sum() == sum(n for n in held.values() if n > 1)
    assert most < 24 * sum(held.values())


def test_rarity_moves_each_token_once(spark):
    rows = [(1, 3, [5, 6, 7]), (2, 2, [6, 7]), (3, 1, [7]), (4, 1, [9]), (5, 0, [])]
    found = setjoin.rarity(spark.createDataFrame(rows, "v long, n long, tokens array<long>"))
    assert sorted(map(tuple, found.collect())) == [(1, 3, 2, 6), (1, 3, 3, 7), (2, 2, 2, 6), (2, 2, 3, 7), (3, 1, 3, 7)]
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning(t#") == 1


@pytest.mark.parametrize("frequent", [False, True])
def test_rarity_by_blocks(spark, monkeypatch, frequent):
    """Line dedup gets the tokens, counts and order that rows give, from any number of parts, and moves no row a token; a token of too many sets is dealt by set."""
    monkeypatch.setattr(setjoin, "PART_TOKENS", 50)
    if frequent:
        monkeypatch.setattr(setjoin, "MOST_HELD", 30)
        monkeypatch.setattr(setjoin, "SAMPLED_SETS", 1)
    rng = random.Random(4)
    rows = [(i << 33, sorted({rng.randrange(-200, 200) for _ in range(rng.randrange(9))} | ({77} if i % 2 else set()))) for i in range(120)]
    sets = spark.createDataFrame([(v, len(t), t) for v, t in rows], "v long, n long, tokens array<long>").repartition(3)
    held = collections.Counter(x for _, t in rows for x in t)
    want = [(v, len(t), held[x], x) for v, t in rows for x in sorted(t, key=lambda x: (held[x], x)) if held[x] > 1]
    found = setjoin.by_rarity(sets, lambda batches: batches, "v long, n long, df long, t long")
    got = [tuple(r) for r in found.collect()]
    assert sorted(got, key=lambda r: r[0]) == want and held[77] > 50  # a set's tokens stay in their order
    empty = setjoin.by_rarity(sets.where("n < 0"), lambda batches: batches, "v long, n long, df long, t long")
    assert empty.count() == 0
    asked = []
    monkeypatch.setattr(setjoin, "by_rarity", lambda *a, by=setjoin.by_rarity: asked.append(1) or by(*a))
    assert lines._later(sets, setjoin.Rule()).count() >= 0 and asked == [1]


def test_only_named_sets_are_moved(spark, monkeypatch):
    """Sets that no pair names stay where they are; a wrong bit lets some pass, which the join drops."""
    sets = spark.range(5000).select(F.col("id").alias("v"), F.lit(4).cast("long").alias("n"), F.sequence(F.col("id") * 0, F.lit(3)).alias("tokens"))
    pairs = spark.createDataFrame([(7, 3), (8, 3), (4999, 0)], "v long, w long")
    moved, sieve = [], setjoin.sieve
    monkeypatch.setattr(setjoin, "sieve", lambda *a: moved.append(sieve(*a)) or moved[-1])
    assert sorted(map(tuple, setjoin.linked(pairs, sets, setjoin.Rule()).collect())) == [(7, 3), (8, 3), (4999, 0)]
    assert [3 <= m.where("_asked").count() + (i == 1) < 50 for i, m in enumerate(moved)] == [True, True]


def test_toxicity_features_are_made_once_a_word():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 12))) for _ in range(3000)]
    texts = pa.array([" ".join(rng.choices(vocabulary, k=400)) + "." for _ in range(500)] + [None, ""], pa.string())
    of = toxicity.chains(texts).words
    known, numbers = toxicity.numbered(of)
    assert (known[numbers] == toxicity.features(of)).all() and known[0] == 0 and (np.diff(known.astype(object)) > 0).all()
    toxic = np.arange(len(texts)) % 7 == 0
    tracemalloc.start()
    toxicity.fit(texts, toxic.astype(float))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak / len(of.hashes) < 220, peak / len(of.hashes)


def test_bpe_worker_gives_back_what_arrow_has_freed(monkeypatch):
    released = []
    monkeypatch.setattr(bpe.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: released.append(1)})())
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        shared = type("Shared", (), {"value": file.read()})
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some text", None]})
    assert [r["decoded"] for b in bpe._there_and_back(iter([batch]), shared) for r in b.to_pylist()] == ["some text", ""]
    assert released == [1]


def test_toxicity_fit_takes_its_texts_a_piece_at_a_time():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 12))) for _ in range(3000)]
    texts = pa.array([". ".join(" ".join(rng.choices(vocabulary, k=20)) for _ in range(20)) for _ in range(1500)] + [None, ""], pa.string())
    of, whole = toxicity.lexicon(texts), toxicity.chains(texts)
    known, numbers = toxicity.numbered(whole.words)
    assert (of.known == known).all() and (of.features[of.word] == numbers).all()
    assert (of.texts == whole.words.bounds).all() and (of.bounds == whole.bounds).all()
    none = toxicity.lexicon(pa.array([], pa.string()))
    assert len(none.word) == 0 and none.known.tolist() == [0] and none.texts.tolist() == none.bounds.tolist() == [0]
    tracemalloc.start()
    toxicity.fit(texts, (np.arange(len(texts)) % 7 == 0).astype(float))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak / len(of.word) < 90, peak / len(of.word)


@pytest.mark.parametrize("k", range(8))
def test_shingles_of_a_few_words(k):
    """A piece of three words in all."""
    of = arrays.words(*arrays.utf8(pa.array([" ".join("abcdefgh"[:k]), None], pa.string())), arrays.NOT_SPACE)
    values, bounds = arrays.shingles(of, 5)
    assert bounds.tolist() == [0, *[min(k, 1) + max(k - 5, 0)] * 2] and len(set(values.tolist())) == len(values) == bounds[-1]


def test_shingles_with_equal_first_bits(monkeypatch):
    """Values that differ in their last bits only are in order, and equal ones are one."""
    last = np.array([5, 3, 5, 1, 4, 3], dtype=np.uint64)
    monkeypatch.setattr(arrays, "mix", lambda x: last[: len(x)])
    of = arrays.Words(np.arange(6, dtype=np.uint64), np.array([0, 4, 6, *[6] * 30]), np.arange(6), np.arange(6) + 1, b"")
    values, bounds = arrays.shingles(of, 1)
    assert values.tolist() == [1, 3, 5, 3, 4] and bounds.tolist() == [0, 3, 5, *[5] * 30]


def test_line_sets_come_from_the_first_lines(spark, monkeypatch):
    """Texts are not cut into words again to find the lines that are compared, nor read to find equal rows."""
    monkeypatch.setattr(setjoin, "token_sets", lambda *a: pytest.fail("texts are hashed again"))
    known = []
    monkeypatch.setattr(lines, "apart", lambda docs, rows, by=lines.apart: known.append(rows.count()) or by(docs, rows))
    words = [f"w{i}" for i in range(40)]
    first, near = " ".join(words), " ".join([*words[:39], "other"])
    rows = [(None, f"{first}\n\n"), (1, f"x y\n{near}"), (1, f"x y\n{near}"), (2, f"\n{first}\nz"), (2, "x y"), (3, None)]
    got = collections.Counter(map(tuple, lines.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == collections.Counter([(None, 3, 0, f"{first}\n\n"), (1, 2, 1, "x y"), (1, 2, 2, ""), (2, 3, 1, "\nz"), (2, 1, 1, ""), (3, 1, 0, "")])
    assert known == [6]


def test_lines_are_taken_out_of_a_batch_at_once():
    rows = [("a\nb\nc", [1]), ("", []), ("a\n\n b", None), ("a\n", [0, 1]), ("ż\nó\n", [2, 0]), ("\n", None)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(["q", *[t for t, _ in rows], "q"], pa.string()), pa.array([[0], *[g for _, g in rows], None], pa.list_(pa.int32()))], ["doc_id", "text", "gone"])
    got = [tuple(r.values()) for b in lines._strip([batch, batch.slice(1, 6), batch.slice(0, 0)]) for r in b.to_pylist()]
    middle = [(1, 3, 1, "a\nc"), (2, 1, 0, ""), (3, 3, 2, ""), (4, 2, 2, ""), (5, 3, 2, "ó"), (6, 2, 0, "\n")]
    assert got == [(0, 1, 1, ""), *middle, (7, 1, 1, ""), *middle]
