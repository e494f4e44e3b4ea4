"""Steps that set-similarity joins share: content classes, screening, rarity order, verification.

A unit is a document or a line; its set holds the hashes of its distinct
five-word shingles. Two units link when ``100 * common >= percent * union``.
``least(n)`` is the fewest tokens a set of n can share with any partner. By the
prefix principle, two linked sets that both take ``n - least(n) + k`` tokens in
one common order share at least k of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm import arrays
from larkspur.llm.rowkeys import sieve
from larkspur.session import cut

#: Posted tokens that one screening task should hold.
BUCKET_TOKENS = 6_000_000
#: Tokens of a bucket that are sorted at a time.
SLICE_TOKENS = 1 << 19
#: Tokens that one entry of a posted row counts.
MOST = (1 << 16) - 1
#: Tokens that one counting task should hold.
PART_TOKENS = 1 << 20
#: With more sets than this, tokens that are expected in more of them are found on one set of so many, and given that count.
MOST_HELD, SAMPLED_SETS = 1 << 20, 1 << 10
#: Rows of 64 bits in the key filter that is broadcast: 4 MB at most.
FILTER_SLOTS = 1 << 18


@dataclass(frozen=True)
class Rule:
    """When two sets link, how they are cut into tokens."""

    size: int = 5
    percent: int = 75

    def least(self, n):
        return -(-self.percent * n // 100)

    def levels(self, n):
        """Matches asked for in screening: an eighth of the set."""
        return -(-n // 8)


Units = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def whole(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text is one unit."""
    return arrays.utf8(column)


def lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each line of a text is one unit; a text of k line feeds has k + 1."""
    data, offsets = arrays.utf8(column)
    cuts = np.flatnonzero(data == 10) + 1
    return data, np.sort(np.concatenate([offsets, cuts]))


def text_only(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.col(f"`{text}`").cast("string").alias("text"))


def _prefixes(column: pa.Array, units: Units, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A key of each unit, the size of its prefix in hash order, and the tokens of all prefixes."""
    of = arrays.words(*units(column), arrays.NOT_SPACE)
    values, bounds = arrays.shingles(of, rule.size)
    n = np.diff(bounds)
    take = n - rule.least(n) + rule.levels(n)
    return arrays.keys(of)[0], take, arrays.mix(values[np.repeat(bounds[:-1], take) + arrays.within(take)] ^ np.uint64(0x5851F42D4C957F2D))


def _post(batches: Iterable[pa.RecordBatch], units: Units, rule: Rule, buckets: int) -> Iterator[pa.RecordBatch]:
    """One row for each piece of text and bucket: the prefixes' tokens that hash there.

    A token that two units of the piece share is counted here and posted once
    for all of them, with weight two; so a token is posted once a piece at most. Units go by one of their keys, 8 bytes with 2 for the count: two that have it
    in common would only be counted together, and pass the screen the sooner.
    """
    for batch in batches:
        for piece in arrays.pieces(batch, 0):
            found = [_prefixes(part.column(0), units, rule) for part in arrays.pieces(piece, 0, size=arrays.CUT_BYTES)]
            k1, take, token = (np.concatenate(x) for x in zip(*found))
            n = len(k1)
            _, first = np.unique(k1, return_index=True)  # copies inside a piece are one unit
            one = np.zeros(n, dtype=bool)
            one[first] = True
            token, unit = token[np.repeat(one, take)], np.repeat(np.arange(n), np.where(one, take, 0))
            order = np.argsort(token)
            token, unit = token[order], unit[order]
            same = np.zeros(len(token) + 1, dtype=bool)
            same[1:-1] = token[1:] == token[:-1]
            shared, head = same[:-1] | same[1:], ~same[:-1]
            local = np.bincount(unit[shared], minlength=n)
            # shared tokens are posted under no unit (the last one)
            unit = np.where(shared, n, unit)[head]
            token = token[head]
            bucket = (token >> np.uint64(32)).astype(np.int64) % buckets
            order = np.argsort(bucket * (n + 1) + unit)
            token, unit, bucket = token[order].astype(np.uint32), unit[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = []
            key = np.append(k1, 0)
            # one row for each unit in a bucket, or several if it has more tokens there than two bytes count
            new = np.append(True, (unit[1:] != unit[:-1]) | (bucket[1:] != bucket[:-1])) if len(unit) else np.zeros(0, bool)
            heads = np.flatnonzero(new)
            if len(heads):
                ends = np.append(heads[1:], len(unit))
                wide = np.flatnonzero(ends - heads > MOST)
                if len(wide):
                    heads = np.sort(np.concatenate([heads, *(np.arange(heads[i] + MOST, ends[i], MOST) for i in wide)]))
            counts, own = np.diff(np.append(heads, len(unit))), unit[heads]
            at = np.searchsorted(heads, cuts)
            for b in np.flatnonzero(np.diff(cuts)):
                mine = slice(at[b], at[b + 1])
                anonymous = int(counts[mine][own[mine] == n].sum())
                rows.append((int(b), key[own[mine]].tobytes(), counts[mine].astype(np.uint16).tobytes(), token[cuts[b] : cuts[b + 1]].tobytes(), anonymous))
            some = np.flatnonzero(local)
            if len(some):
                rows.append((int(k1[0] % buckets), key[some].tobytes(), local[some].astype(np.int64).tobytes(), b"", -1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32()))],
                ["bucket", "units", "counts", "tokens", "anonymous"],
            ) if rows else pa.RecordBatch.from_pylist([], POSTED)


POSTED = pa.schema([("bucket", pa.int32()), ("units", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary()), ("anonymous", pa.int32())])


def _repeated(token: np.ndarray) -> np.ndarray:
    """1 for each token that stands in the list more than once, else 0; a slice of the tokens is sorted at a time."""
    out = np.zeros(len(token), dtype=np.uint8)
    slices = min(-(-len(token) // SLICE_TOKENS), 1 << 16)
    part = (token % np.uint32(max(slices, 1))).astype(np.uint16)
    for k in range(slices):
        at = np.flatnonzero(part == k)
        own = token[at]
        order = np.argsort(own)
        own = own[order]
        same = np.zeros(len(own) + 1, dtype=bool)
        same[1:-1] = own[1:] == own[:-1]
        out[at[order[same[:-1] | same[1:]]]] = 1
    return out


def _match(rows: pd.DataFrame) -> pd.DataFrame:
    """How many of each unit's tokens in this bucket some other unit has too.

    A piece posts a token once, so one that stands here twice is in two pieces; those that units of a piece share are counted there.
    """
    posted = (rows["anonymous"] >= 0).to_numpy()
    read = lambda column, which, kind: np.frombuffer(b"".join(rows[column].to_numpy()[which]), dtype=kind)
    key, shared = [read("units", ~posted, np.int64)], [read("counts", ~posted, np.int64)]
    counts = read("counts", posted, np.uint16)
    if len(counts):
        starts = np.cumsum(counts, dtype=np.int64) - counts
        key.append(read("units", posted, np.int64))
        shared.append(np.add.reduceat(_repeated(read("tokens", posted, np.uint32)), starts, dtype=np.int64))
    key, shared = np.concatenate(key), np.concatenate(shared)
    some = (shared > 0) & (key != 0)
    return pd.DataFrame({"k1": key[some], "shared": shared[some]})


def screen(df: DataFrame, text: str, classes: DataFrame, units: Units, rule: Rule) -> DataFrame:
    """Those of ``classes`` (k1, k2, n, ...) that may link with another class; exact in that none is lost.

    Every unit takes a long prefix of its tokens in hash order and must share
    as many of them with others as the prefix principle then demands of it. Copies
    of one class count as others, so a class with copies always passes.
    """
    posted = classes.agg(F.sum(F.col("n") - F.expr(f"{rule.percent} * n div 100") + F.expr("n div 8") + 1).alias("x"))
    buckets = max(1, -(-int(posted.first()["x"] or 0) // BUCKET_TOKENS))
    post = partial(_post, units=units, rule=rule, buckets=buckets)
    counts = cut(
        text_only(df, text)
        .mapInArrow(post, "bucket int, units binary, counts binary, tokens binary, anonymous int")
        .groupBy("bucket").applyInPandas(_match, "k1 long, shared long")
        .groupBy("k1").agg(F.sum("shared").alias("shared"))
    )
    # a partner may be as small as least(n), and then fewer matches are demanded of it
    need = F.ceil(F.ceil(F.col("n") * rule.percent / 100) / 8)
    return may_be_in(classes, counts).join(counts, "k1").where((F.col("shared") >= need) & (F.col("n") > 0)).drop("shared")


def _content(batches: Iterable[pa.RecordBatch], units: Units) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in arrays.pieces(batch, 0):
            data, offsets = units(piece.column(0))
            k1, k2 = arrays.keys(arrays.words(data, offsets, arrays.NOT_SPACE))
            _, first = np.unique(k1, return_index=True)
            first.sort()
            raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([pa.array(k1[first]), pa.array(k2[first]), raw.take(pa.array(first)).cast(pa.binary())], ["k1", "k2", "content"])


def _tokens(batches: Iterable[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in arrays.pieces(batch.set_column(2, "content", batch.column(2).cast(pa.string())), 2, size=arrays.CUT_BYTES):
            values, bounds = arrays.shingles(arrays.words(*arrays.utf8(piece.column(2)), arrays.NOT_SPACE), rule.size)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))], ["v", "n", "tokens"]
            )


def may_be_in(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose k1 may be one of ``keys``; a bit table of bounded size spares the others the shuffle of a join.

    No row of a key is lost. The more keys there are, the more other rows stay, which the join then drops.
    """
    slot, bit = F.pmod("k1", F.lit(FILTER_SLOTS)).alias("_slot"), "CAST(shiftright(k1, 32) & 63 AS INT)"
    bits = keys.groupBy(slot).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("_bits"))
    known = rows.withColumn("_slot", slot).join(F.broadcast(bits), "_slot")
    return known.where(f"shiftright(_bits, {bit}) & 1 = 1").drop("_slot", "_bits")


def token_sets(df: DataFrame, text: str, some: DataFrame, units: Units, rule: Rule) -> DataFrame:
    """(v, n, tokens) of the classes in ``some`` (k1, k2, v, n), from their texts."""
    contents = text_only(df, text).mapInArrow(partial(_content, units=units), "k1 long, k2 long, content binary")
    one = may_be_in(contents, some).join(some.select("k1", "k2", "v", "n"), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    return tokens_of(one, rule)


def tokens_of(sets: DataFrame, rule: Rule) -> DataFrame:
    """(v, n, tokens) of units (v, n, content)."""
    return cut(sets.select("v", "n", "content").mapInArrow(partial(_tokens, rule=rule), "v long, n long, tokens array<long>"))


def numbered(classes: DataFrame, *order: Column) -> DataFrame:
    """``classes`` with numbers v that ascend in ``order``, written so that they stay the same."""
    return cut(classes.sort(*order).withColumn("v", F.monotonically_increasing_id()))


def rarity(sets: DataFrame) -> DataFrame:
    """(v, n, df, t): the tokens that at least two sets have, sorted by set and rarity, with their set counts.

    Tokens of one set alone precede them all in the common order and need no
    place in a join; there are n less those given. All rows of a set are in one partition; see ``runs``.
    """
    # a window moves each token once; a count that is joined back would move it twice
    tokens = sets.select("v", "n", F.explode("tokens").alias("t")).withColumn("df", F.count("*").over(Window.partitionBy("t")))
    return tokens.where("df > 1").select("v", "n", "df", "t").repartition("v").sortWithinPartitions("v", "df", "t")


def by_rarity(sets: DataFrame, each: Callable[[list[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``each`` makes of the rows that ``rarity`` gives, some whole sets at a time, with tokens moved in blocks, not row by row.

    A token goes to the part of its hash to be counted, then to its set's part. Tokens that too many sets have for one task are dealt by set and keep
    the count that a sample gave them: only the order depends on counts, and it is the same for all sets.
    """
    total = sets.agg(F.sum("n").alias("n"), F.count("*").alias("sets")).first()
    parts = max(1, -(-int(total["n"] or 0) // PART_TOKENS))
    known = _frequent(sets) if total["sets"] > MOST_HELD else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    block = "part int, v binary, n binary, df binary, t binary"
    dealt = sets.select("v", "n", "tokens").mapInArrow(partial(_dealt, parts=parts, known=known[0]), "part int, v binary, n binary, t binary")
    counted = dealt.groupBy("part").applyInArrow(lambda rows: _counted(rows, parts, known), block)
    return counted.groupBy("part").applyInArrow(lambda rows: _ranked(rows, each), schema)


def _frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of more than about ``MOST_HELD`` sets in ascending order, and their counts by a sample of sets; few, as each is so frequent."""
    some = sets.where(F.pmod(F.xxhash64("v"), F.lit(SAMPLED_SETS)) == 0).select(F.explode("tokens").alias("t"))
    found = sorted(map(tuple, some.groupBy("t").count().where(F.col("count") > MOST_HELD // SAMPLED_SETS).collect()))
    t, counts = np.array(found, dtype=np.int64).reshape(-1, 2).T
    return t, counts * SAMPLED_SETS


def _packed(part: np.ndarray, parts: int, **columns: np.ndarray) -> pa.RecordBatch:
    """One row for each part that has rows, with its numbers of each column as bytes."""
    order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    ids = np.flatnonzero(np.diff(cuts))
    cuts = cuts[np.append(ids, parts)]
    packed = [
        pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer((cuts * x.itemsize).astype(np.int32)), pa.py_buffer(x[order])])
        for x in columns.values()
    ]
    return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), *packed], ["part", *columns])


def _unpacked(block: pa.Table, **kinds: type) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(x.as_py() for x in block.column(name)), dtype=kind) for name, kind in kinds.items()]


def _dealt(batches: Iterable[pa.RecordBatch], parts: int, known: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column(2).value_lengths().to_numpy()
        v, n = (np.repeat(batch.column(i).to_numpy(), sizes) for i in (0, 1))
        t = batch.column(2).flatten().to_numpy()
        yield _packed(np.where(np.isin(t, known), v, t).view(np.uint64) % np.uint64(parts), parts, v=v, n=n.astype(np.int32), t=t)


def _counted(block: pa.Table, parts: int, known: tuple[np.ndarray, np.ndarray]) -> pa.Table:
    """The tokens of more than one set with their counts, by the parts of the sets."""
    v, n, t = _unpacked(block, v=np.int64, n=np.int32, t=np.int64)
    order = np.argsort(t)
    t = t[order]
    sizes = np.diff(np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1], [True]])))
    df = np.repeat(sizes, sizes)
    if len(known[0]):
        at = np.minimum(np.searchsorted(known[0], t), len(known[0]) - 1)
        df = np.where(known[0][at] == t, known[1][at], df)
    some = df > 1
    order, df, t = order[some], df[some], t[some]
    by_set = np.argsort(v[order], kind="stable")  # a set's tokens side by side, for the sake of compression
    order = order[by_set]
    v = v[order]
    return pa.Table.from_batches([_packed(v.view(np.uint64) % np.uint64(parts), parts, v=v, n=n[order], df=df[by_set], t=t[by_set])])


def _ranked(block: pa.Table, each: Callable[[list[pa.RecordBatch]], Iterable[pa.RecordBatch]]) -> pa.Table:
    v, n, df, t = _unpacked(block, v=np.int64, n=np.int32, df=np.int64, t=np.int64)
    order = np.argsort(t)
    for by in (df, v):
        order = order[np.argsort(by[order], kind="stable")]
    rows = pa.RecordBatch.from_arrays([pa.array(x[order]) for x in (v, n.astype(np.int64), df, t)], ["v", "n", "df", "t"])
    return pa.Table.from_batches(each([rows]))


def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (v, n, rare) of whole sets from the sorted rows of ``rarity``; holds a batch and one set at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        v = batch.column(0).to_numpy()
        last = int(np.searchsorted(v, v[-1]))  # where the set starts that the next batch may go on with
        if last:
            yield _listed([*held, batch.slice(0, last)])
            held = []
        elif held and held[-1].column(0)[0].as_py() != v[0]:
            yield _listed(held)
            held = []
        held.append(batch.slice(last))
    if held:
        yield _listed(held)


def _listed(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    v, n, df, t = (pa.concat_arrays([r.column(i) for r in rows]) for i in range(4))
    own = v.to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    rare = pa.ListArray.from_arrays(pa.array(np.append(starts, len(own)), pa.int32()), pa.StructArray.from_arrays([df, t], ["df", "t"]))
    return pa.RecordBatch.from_arrays([v.take(pa.array(starts)), n.take(pa.array(starts)), rare], ["v", "n", "rare"])


def linked(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (v, w) whose whole sets are similar enough.

    The pairs are written first, so that their size is known; sets that a bit table of bounded size says they do not name are not moved.
    """
    pairs = cut(pairs.select("v", "w"))
    asked = lambda side: sieve(sets, pairs.select(F.col(side).alias("v")), F.xxhash64("v"), "_asked").where("_asked")
    left = asked("v").select("v", F.col("n").alias("n_v"), F.col("tokens").alias("t_v"))
    right = asked("w").select(F.col("v").alias("w"), F.col("n").alias("n_w"), F.col("tokens").alias("t_w"))
    right = right.join(pairs.select("w").distinct(), "w", "left_semi")
    common = pairs.join(left, "v").join(right, "w")
    common = common.select("v", "w", "n_v", "n_w", F.size(F.array_intersect("t_v", "t_w")).alias("c"))
    return common.where(F.col("c") * 100 >= rule.percent * (F.col("n_v") + F.col("n_w") - F.col("c"))).select("v", "w")
