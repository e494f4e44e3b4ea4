"""Benchmark decontamination with suffix arrays over shards of the training text.

A task takes its documents shard by shard, sorts the suffixes of the shard's
word sequence and binary-searches every test suffix in that order. What it
finds are places of test windows; places on one diagonal join into the longest
verbatim matches. Words and word pairs no test item has cannot be part of a
match; they end a stretch and their suffixes are left out of the array.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import arrays
from larkspur.session import cut

#: Bytes of training text in a shard, and of test items in one block (what a task holds of them).
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20

MATCH = "array<struct<item_id:string,doc_start:int,item_start:int,length:int>>"
MATCH_TYPE = pa.list_(pa.struct([("item_id", pa.string()), ("doc_start", pa.int32()), ("item_start", pa.int32()), ("length", pa.int32())]))


class Windows(NamedTuple):
    """The windows of one width: codes of their items' words or word pairs, one after another, and where windows start among them."""

    width: int
    gram: int  # words that a code stands for
    grams: np.ndarray  # the known pairs, sorted
    codes: np.ndarray
    starts: np.ndarray
    numbers: np.ndarray  # items whose words these are
    bounds: np.ndarray


class Items:
    """Test items of one block: ids, word hashes one after another, bounds. What searching needs of them is worked out once a worker."""

    def __init__(self, ids: list[str], words: np.ndarray, bounds: np.ndarray):
        self.ids, self.words, self.bounds = ids, words, bounds
        self._known: dict[int, tuple[np.ndarray, list[Windows]]] = {}

    def __getstate__(self):
        return self.ids, self.words, self.bounds

    def __setstate__(self, state):
        self.__init__(*state)

    def windows(self, window: int) -> tuple[np.ndarray, list[Windows]]:
        """The items' vocabulary, and their windows by width."""
        if window not in self._known:
            vocabulary, lengths, out = np.unique(self.words), np.diff(self.bounds), []
            for width in sorted({min(int(n), window) for n in lengths if n}):
                numbers = np.flatnonzero(lengths == width if width < window else lengths >= window)
                size = lengths[numbers]
                own = coded(vocabulary, self.words[np.repeat(self.bounds[numbers], size) + arrays.within(size)])
                bounds = np.append(0, np.cumsum(size))
                many = size - width + 1
                starts = np.repeat(bounds[:-1], many) + arrays.within(many)
                # in a match of two words or more every pair of neighbours is one of the items'
                gram, grams, codes = 1, vocabulary[:0], own
                if width > 1:
                    gram, pair = 2, own[:-1] * (len(vocabulary) + 1) + own[1:]
                    inside = np.ones(len(pair), dtype=bool)
                    inside[bounds[1:-1] - 1] = False
                    grams = np.unique(pair[inside])
                    codes = np.append(np.where(inside, coded(grams, pair), 0), 0)
                out.append(Windows(width, gram, grams, codes.astype(np.int32), starts, numbers, bounds))
            self._known[window] = vocabulary, out
        return self._known[window]


def read_items(rows: list, ids: list[str]) -> Items:
    of = arrays.words(*arrays.utf8(pa.array(rows, pa.string())), arrays.ALNUM)
    return Items(ids, of.hashes, of.bounds)


def coded(vocabulary: np.ndarray, values: np.ndarray) -> np.ndarray:
    """1 + place of each value in a sorted vocabulary; 0 where it isn't there."""
    if len(vocabulary) == 0:
        return np.zeros(len(values), dtype=np.int64)
    at = np.minimum(np.searchsorted(vocabulary, values), len(vocabulary) - 1)
    return np.where(vocabulary[at] == values, at + 1, 0)


def suffix_array(codes: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Places in ``codes`` in the order of their suffixes' first ``depth`` codes, by prefix doubling.

    A suffix ends where its stretch does, at ``ends[place]``; a shorter one comes first.
    """
    rank = codes.astype(np.int64)
    place, k = np.arange(len(codes)), 1
    order = np.argsort(rank, kind="stable")
    while k < depth and len(codes):
        ahead = np.where(place + k < ends, rank[np.minimum(place + k, len(codes) - 1)], 0)
        key = rank * (int(rank.max()) + 1) + ahead
        order = np.argsort(key, kind="stable")
        step = np.empty(len(key), dtype=np.int64)
        step[0], step[1:] = 1, key[order][1:] != key[order][:-1]
        rank[order] = np.cumsum(step)
        if step.all():
            break
        k *= 2
    return order


def search(codes: np.ndarray, order: np.ndarray, queries: np.ndarray, right: bool) -> np.ndarray:
    """For each query row, how many suffixes in ``order`` come before it (with ``right``: before or start with it)."""
    padded = np.append(codes, np.zeros(queries.shape[1], dtype=codes.dtype))
    low, high = np.zeros(len(queries), dtype=np.int64), np.full(len(queries), len(order))
    depth = np.arange(queries.shape[1])
    for _ in range(len(order).bit_length()):
        open_ = low < high
        mid = (low + high) // 2
        diff = padded[order[np.minimum(mid, len(order) - 1)][:, None] + depth] - queries
        first = (diff != 0).argmax(axis=1)
        sign = diff[np.arange(len(diff)), first]
        before = (sign <= 0) if right else (sign < 0)
        low, high = np.where(open_ & before, mid + 1, low), np.where(open_ & ~before, mid, high)
    return low


def occurrences(words: np.ndarray, doc_of: np.ndarray, items: Items, window: int) -> Iterator[tuple]:
    """(width, places, item numbers, item offsets): where the items' windows stand among ``words``."""
    vocabulary, known = items.windows(window)
    theirs = coded(vocabulary, words)
    for width, gram, grams, mine, starts, numbers, bounds in known:
        if gram == 2:
            follows = (doc_of[1:] == doc_of[:-1]) & (theirs[1:] > 0) & (theirs[:-1] > 0)
            codes = np.append(np.where(follows, coded(grams, theirs[:-1] * (len(vocabulary) + 1) + theirs[1:]), 0), 0)[: len(words)]
        else:
            codes = theirs
        depth = width - gram + 1
        # stretches of known grams that are long enough for a window
        live = np.flatnonzero(codes)
        if len(live) == 0:
            continue
        new = np.append(True, (np.diff(live) > 1) | (doc_of[live[1:]] != doc_of[live[:-1]]))
        stretch = np.cumsum(new) - 1
        size = np.bincount(stretch)
        keep = size[stretch] >= depth
        if not keep.any():
            continue
        live, stretch = live[keep], stretch[keep]
        # one zero between stretches
        slot = np.arange(len(live)) + np.append(0, np.cumsum(np.diff(stretch) > 0))
        text = np.zeros(slot[-1] + 1, dtype=np.int64)
        text[slot] = codes[live]
        back = np.zeros(len(text), dtype=np.int64)
        back[slot] = live
        gaps = np.append(np.flatnonzero(text == 0), len(text))
        order = suffix_array(text, gaps[np.searchsorted(gaps, np.arange(len(text)))], depth)
        # only windows all of whose codes the shard has, equal ones once
        present = np.zeros(int(max(mine.max(), text.max())) + 1, dtype=bool)
        present[text] = True
        present[0] = False
        starts_ = starts
        for i in range(depth):
            starts_ = starts_[present[mine[starts_ + i]]]
        if len(starts_) == 0:
            continue
        table = mine[starts_[:, None] + np.arange(depth)].astype(np.int64)
        unique, which = np.unique(table, axis=0, return_inverse=True)
        low, high = search(text, order, unique, False), search(text, order, unique, True)
        count = high - low
        place = back[order[np.repeat(low, count) + arrays.within(count)]]
        window_at = np.repeat(np.arange(len(unique)), count)
        # and their places belong to every item that has the window
        by = np.argsort(which, kind="stable")
        edge = np.searchsorted(which[by], np.arange(len(unique) + 1))
        many = np.diff(edge)[window_at]
        source = starts_[by[np.repeat(edge[window_at], many) + arrays.within(many)]]
        at = np.searchsorted(bounds, source, "right") - 1
        yield width, np.repeat(place, many), numbers[at], source - bounds[at]


def matches(of: arrays.Words, items: Items, window: int) -> tuple[np.ndarray, ...]:
    """(document, item number, document start, item start, length) of the longest verbatim matches."""
    doc_of = np.repeat(np.arange(len(of.bounds) - 1), np.diff(of.bounds))
    out = []
    for width, place, number, offset in occurrences(of.hashes, doc_of, items, window):
        order = np.lexsort((place, place - offset, number, doc_of[place]))
        place, number, offset = place[order], number[order], offset[order]
        joined = (np.diff(place) == 1) & (np.diff(offset) == 1) & (np.diff(number) == 0) & (np.diff(doc_of[place]) == 0)
        first = np.flatnonzero(np.append(True, ~joined)) if len(place) else np.zeros(0, dtype=np.int64)
        length = np.diff(np.append(first, len(place))) + width - 1
        doc = doc_of[place[first]]
        out.append((doc, number[first], place[first] - of.bounds[doc], offset[first], length))
    if not out:
        return (np.zeros(0, dtype=np.int64),) * 5
    return tuple(np.concatenate(x) for x in zip(*out))


def covered(doc: np.ndarray, start: np.ndarray, length: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many words of each document the matches cover."""
    edge = np.zeros(bounds[-1] + 1, dtype=np.int64)
    np.add.at(edge, bounds[doc] + start, 1)
    np.add.at(edge, bounds[doc] + start + length, -1)
    return arrays.segment_sums((np.cumsum(edge)[:-1] > 0).astype(np.int64), bounds)


def _find(batches: Iterable[pa.RecordBatch], block: Broadcast, window: int, more: bool) -> Iterator[pa.RecordBatch]:
    items = block.value
    for batch in batches:
        for piece in arrays.pieces(batch, 1, size=SHARD_BYTES):
            of = arrays.words(*arrays.utf8(piece.column(1)), arrays.ALNUM)
            doc, number, start, offset, length = matches(of, items, window)
            before = piece.column(2).to_pylist()
            found: list[list] = [list(x or ()) for x in before]
            for d, i, s, o, n in zip(doc.tolist(), number.tolist(), start.tolist(), offset.tolist(), length.tolist()):
                found[d].append({"item_id": items.ids[i], "doc_start": s, "item_start": o, "length": n})
            old = [(d, m["doc_start"], m["length"]) for d, ms in enumerate(before) for m in ms or ()]
            all_ = [np.concatenate([a, np.array(b, dtype=np.int64)]) for a, b in zip((doc, start, length), zip(*old) if old else ((), (), ()))]
            hit = covered(*all_, of.bounds)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1) if more else pa.nulls(len(piece), pa.string()), pa.array(found, MATCH_TYPE), pa.array(np.diff(of.bounds)), pa.array(hit)],
                ["doc_id", "text", "matches", "n_words", "n_hit"],
            )


def find_matches(
    df: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES, unnamed: bool = False
) -> DataFrame:
    """One row (doc_id, n_words, n_hit, matches) per row of ``df``.

    Words are runs of digits, a-z (A-Z read as such) and characters outside ASCII. A window is ``window`` consecutive
    words of an item, or a whole item of fewer. ``matches`` lists the maximal verbatim matches (item_id as text,
    word places, length in words), n_hit counts the words inside them. Null and empty texts have no words; an
    item without words has no window. An item without id is left out, or with ``unnamed`` found under a null item_id; equal items are one, and items may share an id.
    Repeated rows are rows like any other, other columns are not read, and an empty table gives an empty one.

    The items are worked off in blocks of about ``block_bytes``, each a pass over the documents whose memory the
    block bounds; usually there is one. Between passes the rows are written to the shared folder.
    """
    spark = df.sparkSession
    items = items.select(F.col(f"`{item_id}`").cast("string").alias("item_id"), F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("text"))
    items = (items if unnamed else items.where("item_id IS NOT NULL")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + 16).alias("x")).first()["x"] or 0
    blocks = max(1, -(-size // block_bytes))
    kind = df.schema[id].dataType.simpleString()
    found = df.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), F.lit(None).cast(MATCH).alias("matches"))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        block = spark.sparkContext.broadcast(read_items([r["text"] for r in rows], [r["item_id"] for r in rows]))
        more = b + 1 < blocks
        found = found.select("doc_id", "text", "matches").mapInArrow(
            partial(_find, block=block, window=window, more=more), f"doc_id {kind}, text string, matches {MATCH}, n_words long, n_hit long"
        )
        if more:
            found = cut(found)
    return found.select("doc_id", "n_words", "n_hit", "matches")


def contamination(df: DataFrame, items: DataFrame, **names) -> DataFrame:
    """One row (doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest) per row of ``df``; see ``find_matches``.

    Items without id count too, all together as one in n_items; only items_sha256, of the ids, leaves them out.
    """
    found = find_matches(df, items, unnamed=True, **names)
    ids = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), F.coalesce(F.array_max("matches.length"), F.lit(0)).alias("longest"),
    )
