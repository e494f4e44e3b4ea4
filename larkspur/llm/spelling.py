"""Spelling variants of words, by blocked Gram matrices of letter counts.

An edit changes few letter counts: words that differ by one replaced character
have count vectors at squared distance two, by one more character at distance
one. Words are blocked by length and by the counts of groups of letters;
blocks that an edit can lead to meet, and the matrix product of their count
vectors gives all squared distances of a pair of tiles at once. What is left is
compared character by character.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm import arrays
from larkspur.session import cut

# Letters of words once A-Z are lower-case.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
#: Groups of letters whose counts name a block, and words and characters of a tile.
GROUPS = 8
TILE_WORDS = 1024
TILE_CHARACTERS = 1 << 20
#: Distances that one task should work out.
TASK_PAIRS = 1 << 29
#: Different words that a task counts before it hands them on; pairs of characters compared at a time.
HELD_WORDS = 200_000
COMPARED = 1 << 22
#: A form is so many times as frequent as its variant.
TIMES = 10

COLUMN = np.zeros(256, dtype=np.int64)
COLUMN[LETTERS] = np.arange(len(LETTERS))


def slipped(name: str, run: str, every: int) -> str:
    """``run`` with a character left out, for one in ``every`` pairs of a document's name and a run."""
    h = zlib.crc32(f"{name}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counts(batches: Iterable[pa.RecordBatch], least: int, slips: int | None) -> Iterator[pa.RecordBatch]:
    """Partial (word, n) of (id, text) rows."""
    # a whole run is as long as what a slip leaves of it, or longer
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least)
    held: Counter[str] = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for piece in arrays.pieces(batch, 1):
            data, bounds = arrays.utf8(piece.column(1))
            low = data.tobytes().translate(arrays.LOWER)
            for i, name in enumerate(piece.column(0).to_pylist()):
                found = Counter(runs.findall(low[bounds[i] : bounds[i + 1]].decode()))
                for run, n in found.items():
                    word = slipped(name, run, slips) if slips else run
                    if len(word) >= least:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield flush()
    if held:
        yield flush()


def word_counts(df: DataFrame, id: str = "doc_id", text: str = "text", least: int = 7, times: int = 2, slips: int | None = None) -> DataFrame:
    """(word, n): maximal runs of Latin letters in the whole texts, A-Z as a-z, with ``least`` characters and ``times`` occurrences or more.

    ``slips`` leaves a character out of one in so many pairs of row id and run, by their hash, before words are measured and
    counted: misspellings that are known, for trials. A task works on a few MB of texts at a time, or on one very long text. Null text has no words, a null id reads as empty; repeated rows and ids count like any
    other; other columns are not read; an empty table gives an empty one.
    """
    docs = df.select(F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    counted = docs.mapInArrow(partial(_counts, least=least, slips=slips), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def _steps() -> list[list[int]]:
    """Changes of a block's counts that one edit can make, each pair of blocks in one direction: none, one letter for another, one more."""
    one = [[int(i == k) for i in range(GROUPS)] for k in range(GROUPS)]
    swaps = [[a - b for a, b in zip(one[i], one[j])] for i, j in combinations(range(GROUPS), 2)]
    return [[0] * GROUPS, *swaps, *one]


def _block(word: str) -> Column:
    """Counts of each group of letters; the groups take every GROUPS-th letter."""
    size = F.char_length(word)
    groups = ["".join(map(chr, LETTERS[k::GROUPS])) for k in range(GROUPS)]
    return F.array(*[size - F.char_length(F.translate(word, g, "")) for g in groups])


def _tiles_of(rows: str, block: str) -> Column:
    """Into how many tiles a block of so many words goes."""
    size = F.aggregate(block, F.lit(0), lambda a, b: a + b)
    return F.ceil(F.col(rows) / F.greatest(F.lit(1), F.least(F.lit(TILE_WORDS), F.floor(F.lit(TILE_CHARACTERS) / size)))).cast("int")


def _codes(joined: str, n: int) -> np.ndarray:
    """Words of one length, written one after another, as rows of characters."""
    return np.frombuffer(joined.encode("latin-1"), dtype=np.uint8).reshape(n, -1)


def _vectors(codes: np.ndarray) -> np.ndarray:
    n, size = codes.shape
    # sums of squares have to be exact
    kind = np.float32 if size < 2048 else np.float64
    place = np.repeat(np.arange(n) * len(LETTERS), size) + COLUMN[codes.ravel()]
    return np.bincount(place, minlength=n * len(LETTERS)).reshape(n, -1).astype(kind)


def near_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` that one edit apart; words of ``b`` have as many characters as those of ``a`` or one more."""
    x, y = _vectors(a), _vectors(b)
    used = x.any(axis=0) | y.any(axis=0)
    x, y = x[:, used], y[:, used]
    close = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T) <= 2
    left, right = np.nonzero(close)
    size, longer = a.shape[1], b.shape[1] > a.shape[1]
    keep = np.empty(len(left), dtype=bool)
    step = max(1, COMPARED // b.shape[1])
    for at in range(0, len(left), step):
        p, q = a[left[at : at + step]], b[right[at : at + step]]
        if longer:  # what the words share at their heads and at their tails is the whole of the shorter one
            head = np.logical_and.accumulate(p == q[:, :-1], axis=1).sum(1)
            tail = np.logical_and.accumulate((p == q[:, 1:])[:, ::-1], axis=1).sum(1)
            keep[at : at + step] = head + tail >= size
        else:
            keep[at : at + step] = (p != q).sum(1) == 1
    return left[keep], right[keep]


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def _gram(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For pairs of tiles: each word's number of near words there and the first of them; a tile's words are by frequency, then by spelling."""
    for batch in batches:
        for words_a, ns_a, words_b, ns_b, same in zip(*(batch.column(i).to_pylist() for i in range(5))):
            a, b = _codes(words_a, len(ns_a)), _codes(words_b, len(ns_b))
            i, j = near_pairs(a, b)
            if same:  # a tile with itself
                i, j = i[i < j], j[i < j]
                i, j = np.concatenate([i, j]), np.concatenate([j, i])
            out = []
            sides = ((words_a, ns_a, words_b, ns_b, i, j),) if same else ((words_a, ns_a, words_b, ns_b, i, j), (words_b, ns_b, words_a, ns_a, j, i))
            for own, own_ns, other, other_ns, p, q in sides:
                size, other_size = len(own) // len(own_ns), len(other) // len(other_ns)
                best = np.full(len(own_ns), len(other_ns))
                np.minimum.at(best, p, q)
                n = np.bincount(p, minlength=len(own_ns))
                for w in np.flatnonzero(n):
                    f = int(best[w])
                    out.append((own[w * size : (w + 1) * size], int(n[w]), other_ns[f], other[f * other_size : (f + 1) * other_size]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), NEAR.types)], schema=NEAR)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): of each word of (word, n) that has near words, their number and the most frequent of them.

    Ties go to the word that is smaller by code points. Words are of Latin letters, each in one row. Blocks of any size are cut
    into tiles, and pairs of tiles are dealt out by the number of distances they ask for.
    """
    placed = words.withColumn("block", _block("word"))
    blocks = cut(placed.groupBy("block").agg(F.count(F.lit(1)).alias("rows")).withColumn("tiles", _tiles_of("rows", "block")))
    entry = F.struct((-F.col("n")).alias("m"), "word")
    dealt = placed.join(blocks, "block").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    tiles = dealt.groupBy("block", "tile").agg(F.array_sort(F.collect_list(entry)).alias("w"))  # about TILE_WORDS at most
    tiles = cut(tiles.select("block", "tile", F.array_join("w.word", "").alias("words"), F.transform("w.m", lambda m: -m).alias("ns")))

    steps = F.array(*[F.array(*map(F.lit, s)) for s in _steps()])
    ways = blocks.select(F.col("block").alias("a"), F.col("tiles").alias("tiles_a"), F.explode(steps).alias("step")).withColumn("block", F.zip_with("a", "step", lambda x, y: x + y))
    met = ways.join(blocks, "block").select(
        "a", F.col("block").alias("b"), F.explode(F.sequence(F.lit(0), F.col("tiles_a") - 1)).alias("tile_a"), "tiles"
    ).withColumn("tile_b", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    sizes = tiles.select("block", "tile", F.size("ns").cast("long").alias("size"))
    side = lambda of, s: of.select(F.col("block").alias(s), F.col("tile").alias(f"tile_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in of.columns[2:]])
    pairs = met.where("a <> b OR tile_a <= tile_b").join(side(sizes, "a"), ["a", "tile_a"]).join(side(sizes, "b"), ["b", "tile_b"])
    pairs = cut(pairs.select("a", "tile_a", "b", "tile_b", (F.col("size_a") * F.col("size_b")).alias("work")))
    work = pairs.agg(F.coalesce(F.sum("work"), F.lit(0))).first()[0]
    pairs = pairs.drop("work").repartition(1 + work // TASK_PAIRS)
    both = pairs.join(side(tiles, "a"), ["a", "tile_a"]).join(side(tiles, "b"), ["b", "tile_b"])
    same = (F.col("a") == F.col("b")) & (F.col("tile_a") == F.col("tile_b"))
    found = both.select("words_a", "ns_a", "words_b", "ns_b", same.alias("same")).mapInArrow(_gram, "word string, n_near long, form_n long, form string")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("m"), "form")).alias("best"))
    return best.select("word", "n_near", (-F.col("best.m")).alias("form_n"), F.col("best.form").alias("form"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each word's chain of forms, by pointer doubling. Each step is to a far more frequent word, so chains are short."""
    up = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = up.join(up.select(F.col("word").alias("root"), F.col("root").alias("next")), "root")
        if further.isEmpty():
            return up
        up = cut(up.join(up.select(F.col("word").alias("w"), F.col("root").alias("next")), F.col("root") == F.col("w"), "left").select("word", F.coalesce("next", "root").alias("root")))


def variants(words: DataFrame) -> DataFrame:
    """One row (word, n, n_near, form, form_n, root) per row of (word, n).

    Near words differ by one character inserted, deleted or replaced. The form is the near word with the largest ``n`` (ties: the smallest by code points)
    if that is ``TIMES`` the word's own or more, else null. The root is the last of the chain of forms, the word itself without one. An empty
    table gives an empty one.
    """
    words = cut(words.select("word", "n"))
    near = words.join(near_words(words), "word", "left")
    real = F.col("form_n") >= F.col("n") * TIMES
    told = cut(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(real, F.col("form")).alias("form"), F.when(real, F.col("form_n")).alias("form_n")))
    roots = _roots(told.where("form IS NOT NULL"))
    return told.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
