"""Toxic spans by a linear-chain conditional random field, scores by its marginals.

Two states per word: ordinary and toxic. A word's weight for the toxic state is the sum of the weights of its features
(the word and its first bytes); two neighbours' states have a weight of their own. Chains are sentences.
Forward and backward passes run over many chains at once, on the ratio of the two states' sums. Chains of words
without any weight of their own differ in length only; their marginals are computed once.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm import arrays

#: Bounds of the fit: about so many labelled texts, and at most so many of their words.
FIT_TEXTS = 4_000
FIT_WORDS = 2_000_000
#: Longest chain; a longer sentence is several.
CHAIN = 256
#: Lengths of the heads of words that are features.
HEADS = (4, 5, 6, 7)

_STOP = bytes(b in b".!?\n" for b in range(256))
#: Log-likelihood ratio from which a feature marks toxic documents; e^16 is far above the number of features tried.
SURPRISE = 16
#: Words whose features are looked at at a time in the fit.
FIT_SLICE = 1 << 17
SPANS = "array<struct<start:int,end:int,score:double>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _columns(of: arrays.Words) -> Iterator[np.ndarray]:
    yield of.hashes
    for k in HEADS:
        head = of.heads(k)
        yield np.where(head > 0, arrays.mix(head ^ np.uint64(k << 56)), 0)


def features(of: arrays.Words) -> np.ndarray:
    """64-bit numbers of each word's features, one row a word; 0 is no feature."""
    return np.stack(list(_columns(of)), axis=1)


def numbered(of: arrays.Words) -> tuple[np.ndarray, np.ndarray]:
    """All features, ascending, 0 among them, and each word's as places in that list; made once for each distinct word."""
    _, first, word = np.unique(of.hashes, return_index=True, return_inverse=True)
    each = features(arrays.Words(of.hashes[first], of.bounds[:0], of.starts[first], of.ends[first], of.raw))
    known, place = np.unique(np.append(each.ravel(), np.uint64(0)), return_inverse=True)
    return known, place[:-1].reshape(each.shape).astype(np.int32)[word]


@dataclass
class Chains:
    """Words of many texts, cut into chains: chain i holds words bounds[i] to bounds[i + 1]."""

    words: arrays.Words
    bounds: np.ndarray


def chains(column: pa.Array) -> Chains:
    data, offsets = arrays.utf8(column)
    of = arrays.words(data, offsets, arrays.ALNUM)
    stops = np.flatnonzero(np.frombuffer(of.raw.translate(_STOP), dtype=bool))
    sentence = np.searchsorted(stops, of.starts, "right")
    new = np.zeros(len(sentence), dtype=bool)
    new[1:] = sentence[1:] != sentence[:-1]
    new[of.bounds[:-1][of.bounds[:-1] < len(new)]] = True
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(new)))
    parts = -(-sizes // CHAIN)
    first = np.repeat(first, parts) + arrays.within(parts) * CHAIN
    return Chains(of, np.append(first, len(new)))


@dataclass
class Lexicon:
    """Chains of the texts of a fit, each word named by its place in the list of distinct ones."""

    known: np.ndarray  # all features, ascending, 0 among them
    features: np.ndarray  # each distinct word's as places in that list
    word: np.ndarray
    texts: np.ndarray  # text i has words texts[i] to texts[i + 1]
    bounds: np.ndarray  # chain i has words bounds[i] to bounds[i + 1]


def lexicon(texts: pa.Array) -> Lexicon:
    """What the fit needs of its texts, taken a piece of them at a time; a text's bytes are not needed after that."""
    seen, new, each, words, sizes, lengths = np.zeros(0, np.uint64), [], [], [], [], []
    for piece in arrays.pieces(pa.RecordBatch.from_arrays([texts], ["text"]), 0, size=arrays.CUT_BYTES):
        of = chains(piece.column(0))
        own, first, word = np.unique(of.words.hashes, return_index=True, return_inverse=True)
        first = first[~np.isin(own, seen)]
        new.append(of.words.hashes[first])
        each.append(features(arrays.Words(new[-1], of.words.bounds[:0], of.words.starts[first], of.words.ends[first], of.words.raw)))
        seen = np.union1d(seen, new[-1])
        words.append((own, word.astype(np.int32)))
        sizes.append(np.diff(of.words.bounds))
        lengths.append(np.diff(of.bounds))
    ends = lambda parts: np.append(0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *parts])))
    word = np.concatenate([np.zeros(0, np.int32), *(np.searchsorted(seen, own).astype(np.int32)[w] for own, w in words)])
    order = np.argsort(np.concatenate([np.zeros(0, np.uint64), *new]))
    of_each = np.concatenate([np.zeros((0, 1 + len(HEADS)), np.uint64), *each])[order]
    known, number = np.unique(np.append(of_each.ravel(), np.uint64(0)), return_inverse=True)
    return Lexicon(known, number[:-1].reshape(of_each.shape).astype(np.int32), word, ends(sizes), ends(lengths))


@dataclass
class Model:
    features: np.ndarray  # those with a weight, ascending
    weights: np.ndarray
    bias: float
    start: float  # weight of beginning in the toxic state
    moves: np.ndarray  # weights of moving from state i to state j
    score: np.ndarray  # of a document's score: weights of its summary and the constant

    def emission(self, of: arrays.Words) -> np.ndarray:
        out = np.full(len(of.hashes), self.bias)
        if len(self.features) == 0:
            return out
        seen = np.zeros(1 << 20, dtype=bool)  # most words have no weight; a small table tells them apart
        low = np.uint64(len(seen) - 1)
        seen[self.features & low] = True
        for column in _columns(of):
            maybe = np.flatnonzero(seen[column & low])
            at = np.minimum(np.searchsorted(self.features, column[maybe]), len(self.features) - 1)
            hit = self.features[at] == column[maybe]
            out[maybe[hit]] += self.weights[at[hit]]
        return out


def _padded(weights: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of chains of like length: each word's place (-1 in the padding) and odds, one column a chain."""
    sizes = np.diff(bounds)
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    at = 0
    while at < len(order):
        top = int(sizes[order[at]])
        top += max(2, top // 4)
        end = min(int(np.searchsorted(sizes[order], top, "right")), at + 20_000)
        some = order[at:end]
        length = int(sizes[some[-1]])
        step = np.arange(length)[:, None]
        place = np.where(step < sizes[some], bounds[some] + step, -1)
        yield place, np.exp(np.clip(np.where(place >= 0, weights[place], 0.0), -30, 30))
        at = end


def forward_backward(odds: np.ndarray, live: np.ndarray, start: float, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ratios toxic to ordinary of the forward and the backward sums, word by chain."""
    (m00, m01), (m10, m11) = np.exp(moves)
    forward, backward = np.empty_like(odds), np.ones_like(odds)
    forward[0] = odds[0] * math.exp(start)
    for t in range(1, len(odds)):
        before = forward[t - 1]
        forward[t] = odds[t] * (m01 + before * m11) / (m00 + before * m10)
    for t in range(len(odds) - 2, -1, -1):
        after = odds[t + 1] * backward[t + 1]
        backward[t] = np.where(live[t + 1], (m10 + after * m11) / (m00 + after * m01), 1.0)
    return forward, backward


def _all_marginals(weights: np.ndarray, bounds: np.ndarray, model: Model) -> np.ndarray:
    out = np.zeros(len(weights))
    for place, odds in _padded(weights, bounds):
        live = place >= 0
        forward, backward = forward_backward(odds, live, model.start, model.moves)
        out[place[live]] = (forward * backward)[live]
    return out


def marginals(weights: np.ndarray, bounds: np.ndarray, model: Model) -> np.ndarray:
    """Odds of the toxic state of every word, given its whole chain."""
    sizes = np.diff(bounds)
    busy = arrays.segment_sums((weights != model.bias).astype(np.int64), bounds) > 0
    out = np.zeros(len(weights))
    # one plain chain of each length
    plain = np.arange(CHAIN + 1)
    at = np.append(0, np.cumsum(plain))
    table = _all_marginals(np.full(at[-1], model.bias), at, model)
    quiet = sizes[~busy]
    out[np.repeat(~busy, sizes)] = table[np.repeat(at[quiet], quiet) + arrays.within(quiet)]
    of_busy = np.repeat(busy, sizes)
    out[of_busy] = _all_marginals(weights[of_busy], np.append(0, np.cumsum(sizes[busy])), model)
    return out


def summary(odds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each document: log-odds of its most toxic word, and log of 1 + its expected number of toxic words."""
    chance = odds / (1 + odds)
    filled = np.flatnonzero(np.diff(bounds) > 0)
    top = np.full(len(bounds) - 1, 1e-6)
    if len(filled):
        top[filled] = np.maximum.reduceat(odds, bounds[filled])
    return np.stack([np.clip(np.log(np.maximum(top, 1e-6)), -14, 14) / 4, np.log1p(np.maximum(arrays.segment_sums(chance, bounds), 0)), np.ones(len(top))], axis=1)


def fit_chain(known: np.ndarray, numbers: np.ndarray, labels: np.ndarray, bounds: np.ndarray, rounds: int = 50) -> Model:
    """Maximum likelihood with a small quadratic penalty.

    ``numbers`` has each word's features as places in ``known``, whose first is no feature; ``labels`` its state.
    Features no toxic word has get no weight. Chains of words without other features count by their length.
    """
    active = np.zeros(len(known), dtype=bool)
    active[numbers[labels > 0]] = True
    active[0] = False
    used = np.flatnonzero(active)
    model = Model(known[used], np.zeros(len(used)), -4.0, 0.0, np.zeros((2, 2)), np.zeros(3))
    sizes = np.diff(bounds)
    busy = arrays.segment_sums(_any(active, numbers).astype(np.int64), bounds) > 0
    plain, times = np.unique(sizes[~busy & (sizes > 0)], return_counts=True)
    own = np.repeat(busy, sizes)
    numbers = numbers[own]
    numbers[~active[numbers]] = 0
    numbers = np.concatenate([numbers, np.zeros((plain.sum(), numbers.shape[1]), dtype=numbers.dtype)])
    labels = np.concatenate([labels[own], np.zeros(plain.sum(), dtype=labels.dtype)])
    bounds = np.append(0, np.cumsum(np.concatenate([sizes[busy], plain])))
    weight = np.concatenate([np.ones(busy.sum()), times])
    of_word = np.repeat(weight, np.diff(bounds))
    chain_of = np.repeat(np.arange(len(weight)), np.diff(bounds))
    flat_word, column = np.nonzero(numbers)
    flat = np.searchsorted(used, numbers[flat_word, column]) + 1
    inner = chain_of[1:] == chain_of[:-1]
    true_moves = np.bincount((labels[:-1] * 2 + labels[1:])[inner], weights=of_word[1:][inner], minlength=4).reshape(2, 2)
    state: dict[str, tuple] = {}

    def step(name: str, value, slope, rate, t):
        m, v = state.get(name, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        state[name] = (m, v)
        return value - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)

    for t in range(1, rounds + 1):
        emission = np.bincount(flat_word, weights=model.weights[flat - 1], minlength=len(labels)) + model.bias
        slope = np.zeros(len(emission))
        moves, start = -true_moves, 0.0
        for at, odds in _padded(emission, bounds):
            live = at >= 0
            many = weight[chain_of[at[0]]]
            forward, backward = forward_backward(odds, live, model.start, model.moves)
            both = forward * backward
            chance = both / (1 + both)
            truth = np.where(live, labels[at], 0)
            slope[at[live]] = (chance - truth)[live]
            start += float(((chance[0] - truth[0]) * many).sum())
            if len(at) > 1:
                # expected less true numbers of moves between the states
                (m00, m01), (m10, m11) = np.exp(model.moves)
                before, after = forward[:-1], odds[1:] * backward[1:]
                share = live[1:] * many / (m00 + m01 * after + before * (m10 + m11 * after))
                moves += [[m00 * share.sum(), m01 * (share * after).sum()], [m10 * (share * before).sum(), m11 * (share * before * after).sum()]]
        rate = 0.3 * (1 - t / (rounds + 1))
        slope *= of_word
        by_feature = np.bincount(flat, weights=slope[flat_word], minlength=len(used) + 1)[1:]
        model.weights = step("weights", model.weights, by_feature + 0.02 * model.weights, rate, t)
        model.bias = float(step("bias", model.bias, slope.sum(), rate, t))
        model.start = float(step("start", model.start, start + model.start, rate, t))
        model.moves = step("moves", model.moves, moves + model.moves, rate / 4, t)
    return model


def _any(marks: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether one of a word's features is marked."""
    out = np.zeros(len(numbers), dtype=bool)
    for column in numbers.T:
        out |= marks[column]
    return out


def token_labels(numbers: np.ndarray, features: int, bounds: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """States of the words, from labels of their documents.

    A word is toxic if its document is and one of its features marks toxic documents: nearly all documents that have
    it are toxic, far too many of them for chance.
    """
    total, bad = np.zeros(features, dtype=np.int64), np.zeros(features)
    at = 0
    while at < len(toxic):  # some texts at a time; a feature counts once in each
        end = max(int(np.searchsorted(bounds, bounds[at] + FIT_SLICE, "right")) - 1, at + 1)
        owner = np.repeat(np.arange(end - at), np.diff(bounds[at : end + 1]))
        pairs = np.unique(np.concatenate([np.unique(column * np.int64(end - at) + owner) for column in numbers[bounds[at] : bounds[end]].T]))
        feature, doc = pairs // (end - at), pairs % (end - at)
        total += np.bincount(feature, minlength=features)
        bad += np.bincount(feature, weights=toxic[at:end][doc], minlength=features)
        at = end
    share = min(max(float(toxic.mean()) if len(toxic) else 0.5, 1e-3), 0.999)
    rate = bad / np.maximum(total, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        surprise = bad * np.log(rate / share) + np.where(rate < 1, (total - bad) * np.log((1 - rate) / (1 - share)), 0)
    marks = (rate >= 0.9) & (surprise > SURPRISE)
    marks[0] = False
    return (_any(marks, numbers) & np.repeat(toxic > 0, np.diff(bounds))).astype(np.int64)


def fit(texts: pa.Array, toxic: np.ndarray) -> Model:
    """A model of labelled texts: states of words, then the chain, then the score of documents."""
    of = lexicon(texts)
    numbers = of.features[of.word]
    labels = token_labels(numbers, len(of.known), of.texts, toxic)
    model = fit_chain(of.known, numbers, labels, of.bounds)
    del numbers, labels
    weights = np.zeros(len(of.known))
    weights[np.searchsorted(of.known, model.features)] = model.weights
    emission = np.full(len(of.features), model.bias)
    for column in of.features.T:
        emission += weights[column]
    odds = np.empty(len(of.word))
    at = 0
    while at < len(of.bounds) - 1:  # some chains at a time
        end = max(int(np.searchsorted(of.bounds, of.bounds[at] + FIT_SLICE, "right")) - 1, at + 1)
        own = slice(of.bounds[at], of.bounds[end])
        odds[own] = marginals(emission[of.word[own]], of.bounds[at : end + 1] - of.bounds[at], model)
        at = end
    x = summary(odds, of.texts)
    prior = np.array([0.0, 0.0, -2.0])  # without labels no text is toxic
    weight = prior
    for _ in range(30):  # Newton's method with a small penalty
        chance = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        slope = x.T @ (chance - toxic) + 0.1 * (weight - prior)
        curve = (x * (chance * (1 - chance))[:, None]).T @ x + 0.1 * np.eye(3)
        weight = weight - np.linalg.solve(curve, slope)
    model.score = weight
    return model


def _fit(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    texts, toxic, left = [], [], words * 8
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if left > 0:
                texts.append(text or "")
                toxic.append(label)
                left -= len(texts[-1])
    model = fit(pa.array(texts, pa.string()), np.array(toxic, dtype=np.float64))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])


def train(df: DataFrame, labels: DataFrame, where: Column | None = None, id: str = "doc_id", text: str = "text", label: str = "toxic", texts: int = FIT_TEXTS, words: int = FIT_WORDS) -> Model:
    """A model fitted in one task on about ``texts`` labelled texts with at most ``words`` words.

    ``labels`` has ids and 0 or 1; null labels and ids are left out, ``where`` (on the id, named ``doc_id``) chooses rows. The sample is
    taken by a hash of the id, the same part of both tables, before they are joined.
    """
    marked = labels.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    marked = marked if where is None else marked.where(where)
    total = marked.count()
    chosen = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 20)) < int((1 << 20) * min(1.0, texts / max(1, total)))
    docs = df.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    sample = docs.where(chosen).join(marked.where(chosen), "doc_id").select("text", "toxic")
    sample = sample.repartition(1).sortWithinPartitions(F.xxhash64("text"), "toxic")
    row = sample.mapInArrow(partial(_fit, words=words), "model binary").first()
    return pickle.loads(row["model"]) if row else fit(pa.array([], pa.string()), np.zeros(0))


def _score(batches: Iterable[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model: Model = shared.value
    for batch in batches:
        for piece in arrays.pieces(batch, 1):
            of = chains(piece.column(1))
            odds = marginals(model.emission(of.words), of.bounds, model)
            bounds = of.words.bounds
            score = 1 / (1 + np.exp(-np.clip(summary(odds, bounds) @ model.score, -30, 30)))
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(score), pa.array(_spans(piece.column(1), of, odds), SPAN_TYPE)], ["doc_id", "score", "spans"])


def _spans(column: pa.Array, of: Chains, odds: np.ndarray) -> list[list[dict]]:
    """Runs of words of one chain that are more likely toxic than not, with places in characters."""
    out: list[list[dict]] = [[] for _ in range(len(of.words.bounds) - 1)]
    hot = np.flatnonzero(odds >= 1)
    if len(hot) == 0:
        return out
    chain = np.searchsorted(of.bounds, hot, "right")
    first = np.append(True, (np.diff(hot) > 1) | (np.diff(chain) > 0))
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(hot)) - 1
    doc = np.searchsorted(of.words.bounds, hot[starts], "right") - 1
    _, offsets = arrays.utf8(column)
    # characters before each place, counted once for the whole piece
    head = np.append(0, np.cumsum((np.frombuffer(of.words.raw, dtype=np.uint8) & 0xC0) != 0x80))
    for d, a, b in zip(doc.tolist(), starts.tolist(), ends.tolist()):
        i, j = hot[a], hot[b]
        zero = head[offsets[d]]
        peak = float(odds[i : j + 1].max())
        out[d].append({"start": int(head[of.words.starts[i]] - zero), "end": int(head[of.words.ends[j]] - zero), "score": peak / (1 + peak)})
    return out


def scores(df: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (doc_id, score, predicted, spans) per row of ``df``.

    ``score`` from 0 to 1, ``predicted`` 1 from 0.5 on; ``spans`` are the offending places in characters with their largest marginal.
    Null and empty texts have no words and get the score of a text without any sign. Whole texts are read; repeated
    rows and null ids are rows like any other; other columns are not read; an empty table gives an empty one. The model has a
    few thousand weights; the bounds of the fit bound them.
    """
    docs = df.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = df.schema[id].dataType.simpleString()
    found = docs.mapInArrow(partial(_score, shared=df.sparkSession.sparkContext.broadcast(model)), f"doc_id {kind}, score double, spans {SPANS}")
    return found.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
