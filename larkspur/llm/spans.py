"""Substring dedup by sliding sentence spans.

Runs of consecutive sentences that are just long enough are hashed, the first
place of each run is found by an aggregate over the whole table, and sentences
that any later place covers are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import arrays
from larkspur.llm.rowkeys import apart, keyed, same_row, sieve
from larkspur.session import cut

#: Words from which a sentence is a span of its own.
LONG_WORDS = 50
#: A span with more than this part of all places has its places spread over several tasks.
HOT_PART = 1_000

#: A sentence ends after a full stop, question or exclamation mark (or its full-width form) before white space, or at a line feed.
SENTENCE = re.compile(r"[^\n]*?(?:[.!?。！？]+(?=\s|$)\s*|\n+|$)", re.S)


def sentences(text: str) -> list[str]:
    """The parts of ``text``, which joined give it back; each has its closing white space."""
    parts = [m for m in SENTENCE.findall(text) if m]
    assert sum(map(len, parts)) == len(text)
    return parts


def _bounds(size: np.ndarray, owner: np.ndarray, run: int, least_words: int, long_words: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the spans among sentences of ``size`` words that belong to ``owner``, each once.

    Of every sentence, the shortest run that begins and the shortest that ends there: together they cover
    every longer run whole, up to its last sentence.
    """
    n = len(size)
    here = np.arange(n)
    if long_words is None:
        start = here[: max(n - run + 1, 0)]
        ok = (owner[start] == owner[start + run - 1]) & (np.convolve(size, np.ones(run, size.dtype), "valid") >= least_words if len(start) else True)
        return start[ok], start[ok] + run
    words = np.append(0, np.cumsum(size))
    end = np.maximum(here + run, np.searchsorted(words, words[:-1] + least_words))
    start = np.minimum(here + 1 - run, np.searchsorted(words, words[1:] - least_words, "right") - 1)
    forward = (end <= n) & (owner[np.minimum(end, n) - 1] == owner)
    backward = (start >= 0) & (owner[np.maximum(start, 0)] == owner)
    backward[end[forward] - 1] = False  # the shortest run to that end is the forward one
    alone = here[size >= long_words] if run > 1 else here[:0]
    return np.concatenate([here[forward], start[backward], alone]), np.concatenate([end[forward], here[backward] + 1, alone + 1])


def _parted(texts: list[str]) -> tuple[list[list[str]], np.ndarray, arrays.Words]:
    """The sentences of each text, the text that each sentence is of, and the words of all sentences."""
    parts = [sentences(x) for x in texts]
    of = arrays.words(*arrays.utf8(pa.array([s for p in parts for s in p], pa.string())), arrays.ALNUM)
    return parts, np.repeat(np.arange(len(parts)), [len(p) for p in parts]), of


def _spans(batches: Iterable[pa.RecordBatch], run: int, least_words: int, long_words: int | None) -> Iterator[pa.RecordBatch]:
    """(doc_id, row, at, n, k1, k2) for each span of ``n`` sentences with words; see ``remove_repeats``.

    Sentences without words neither count nor break a run; ``at`` counts sentences with words.
    """
    for batch in batches:
        for piece in arrays.pieces(batch, 2):
            parts, owner, of = _parted(piece.column(2).to_pylist())
            k1, k2 = arrays.keys(of)
            size = np.diff(of.bounds)
            some = size > 0
            k1, k2, size, owner = k1[some].view(np.uint64), k2[some].view(np.uint64), size[some], owner[some]
            start, end = _bounds(size, owner, run, least_words, long_words)
            if len(start) == 0:
                continue
            first = np.searchsorted(owner, np.arange(len(parts)))
            at, n = start - first[owner[start]], end - start
            h1, h2 = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
            for i in range(int(n.max())):
                live = np.flatnonzero(n > i)
                h1[live] = arrays.mix(h1[live] ^ k1[start[live] + i]) * np.uint64(0x9E3779B97F4A7C15)
                h2[live] = arrays.mix(h2[live] ^ k2[start[live] + i]) * np.uint64(0xC2B2AE3D27D4EB4F)
            rows = pa.array(owner[start])
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(rows), piece.column(1).take(rows), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))],
                ["doc_id", "row", "at", "n", "k1", "k2"],
            )


def _strip(batches: Iterable[pa.RecordBatch], run: int, least_words: int, long_words: int | None) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, found) without the sentences of the spans ``found``; null stands for all spans of the text."""
    for batch in batches:
        for piece in arrays.pieces(batch, 1):
            texts = piece.column(1).to_pylist()
            parts, owner, of = _parted(texts)
            size = np.diff(of.bounds)
            some = size > 0
            n = np.bincount(owner[some], minlength=len(parts))
            # places of a text's sentences with words, among its sentences
            first, at = np.append(0, np.cumsum(n)), arrays.within(np.array([len(p) for p in parts]))[some]
            gone, out = [], []
            for i, found in enumerate(piece.column(2).to_pylist()):
                worded = at[first[i] : first[i + 1]]
                if found is None:
                    ends = zip(*_bounds(size[some][first[i] : first[i + 1]], np.zeros(len(worded), int), run, least_words, long_words))
                else:
                    ends = ((s["at"], s["at"] + s["n"]) for s in found)
                covered = {int(x) for a, b in ends for x in worded[a:b]}
                gone.append(len(covered))
                out.append("".join(p for k, p in enumerate(parts[i]) if k not in covered) if covered else texts[i])
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(n, pa.int32()), pa.array(gone, pa.int32()), pa.array(out, pa.string())], ["doc_id", "n_sentences", "n_removed", "text"]
            )


def repeated_spans(df: DataFrame, id: str = "doc_id", text: str = "text", run: int = 2, least_words: int = 20, long_words: int | None = None) -> DataFrame:
    """(doc_id, row, at, n) of every span of n sentences whose words stand at an earlier place (doc_id, row, at) too; ``row`` is the xxhash64 of the text.

    Equal rows with one id have the same places. Places of a span that very many texts share are dealt to several tasks.
    """
    kind = df.schema[id].dataType.simpleString()
    spans = cut(keyed(df, id, text).mapInArrow(partial(_spans, run=run, least_words=least_words, long_words=long_words), f"doc_id {kind}, row long, at int, n int, k1 long, k2 long"))
    place = F.struct("doc_id", "row", "at")
    first = cut(spans.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count("*").alias("places")).where("places > 1"))
    total = spans.count()
    # fewer than HOT_PART rows
    hot = first.where(F.col("places") * HOT_PART > total).select("k1", "k2", (F.col("places") * HOT_PART / max(total, 1)).cast("int").alias("_parts"))
    parts = F.coalesce("_parts", F.lit(1))
    left = spans.join(F.broadcast(hot), ["k1", "k2"], "left").withColumn("_part", (F.monotonically_increasing_id() % parts).cast("int")).drop("_parts")
    right = first.drop("places").join(F.broadcast(hot), ["k1", "k2"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return left.join(right, ["k1", "k2", "_part"]).where(~place.eqNullSafe(F.col("first"))).select("doc_id", "row", "at", "n")


def remove_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", run: int = 2, least_words: int = 20, long_words: int | None = None) -> DataFrame:
    """One row (doc_id, n_sentences, n_removed, text) per row of ``df``, without the repeated sentences.

    A span is ``run`` consecutive sentences with at least ``least_words`` words together. With ``long_words`` it takes as many more
    sentences as it needs for ``least_words``, so that every repeated run of ``run`` or more sentences with as many words is
    covered whole, and a sentence of ``long_words`` words or more is a span too. Words are compared with
    A-Z as a-z and without punctuation. The first place of a span stays, by id (null first), then by the hash of the text, then by position; sentences covered by any
    other place go, in the same document too. Null reads as empty and comes back as empty text. Texts with fewer
    sentences are not changed. Texts that share an id lose their own repeats only; of equal rows one keeps what stands first in it. A task
    works on a few MB of texts at a time, or on one very long text. Other columns are not read; an empty table gives an empty one.
    """
    how = {"run": run, "least_words": least_words, "long_words": long_words}
    kind = df.schema[id].dataType.simpleString()
    spans = repeated_spans(df, id, text, **how).distinct()
    found = cut(spans.groupBy("doc_id", "row").agg(F.collect_list(F.struct("at", "n")).alias("found")))  # three times as many as a text has sentences at most
    docs, copies = apart(keyed(df, id, text))
    # only texts that may lose something are joined
    marked = sieve(docs, found, F.xxhash64("doc_id", "row"), "asked")
    joined = marked.where("asked").join(found.withColumnsRenamed({"doc_id": "of", "row": "of_row"}), same_row(), "left")
    none = F.array().cast("array<struct<at:int,n:int>>")
    rows = joined.select("doc_id", "text", F.coalesce("found", none).alias("found")).unionByName(marked.where("NOT asked").select("doc_id", "text", none.alias("found")))
    if copies is not None:  # a further copy has no span that isn't in the first
        rows = rows.unionByName(copies.select("doc_id", "text", F.lit(None).cast("array<struct<at:int,n:int>>").alias("found")))
    return rows.mapInArrow(partial(_strip, **how), f"doc_id {kind}, n_sentences int, n_removed int, text string")
