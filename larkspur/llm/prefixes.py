"""The trie of conversation prefixes, from sorted conversations and their common prefixes.

Distinct conversations are sorted by their turns. The lengths of the prefixes
that neighbours share (LCPs) tell everything about the trie: a prefix of d turns belongs to the
members between the nearest places on both sides where fewer than d turns are
shared. A sparse table answers the least LCP of any stretch, so each prefix
finds the ends of its interval by two binary searches of its own.

Turns are known by 128-bit hashes of depth, role and text; the sum of a prefix's
hashes is its key. Long conversations are cut into stretches of turns, which are
sorted by the key of what is before them, so no task ever holds a
whole conversation or all members of a prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm import arrays
from larkspur.operators import ordered
from larkspur.session import cut

#: Turns of one stretch of a conversation.
STRETCH = 4096
#: Turns of distinct stretches that one task sorts and searches, about.
SHARD_TURNS = 250_000
#: Keys are sums modulo this.
WRAP = 1 << 63

NODE = ["depth", "k1", "k2"]
LOCAL = pa.schema(
    [("shard", pa.int32()), ("first", pa.int32()), ("last", pa.int32())]
    + [(c, pa.int64()) for c in ("depth", "k1", "k2", "p1", "p2", "n_convs", "conv_id", "size")]
)


def numbered_turns(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, at, t1, t2, size) of each turn: its place from 1, hashes of role and text, code points of the text.

    Turns are ordered by number, null first; equal numbers by the hashes. Null role and text read as empty. Rows without
    conversation are left out: they belong to none.
    """
    told = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    rows = df.select(
        F.col(f"`{conversation}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.xxhash64(F.lit(1), *told).alias("t1"), F.xxhash64(F.lit(2), *told).alias("t2"), F.char_length(told[1]).cast("long").alias("size"),
    ).where("conv IS NOT NULL")
    return cut(ordered.row_number(cut(rows), ["conv"], ["turn", "t1", "t2"], "at").drop("turn"))


def shared_heads(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations with the head of another, as (conv, depth, t1, t2, size) and all (conv).

    Conversation c gets the first h turns of c - c % ``every`` (all if there are fewer, none if there is no such conversation), then its own turns after its
    first h, with h = crc32(c) % ``most``.
    """
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    base = convs.where(F.col("conv") % every == 0).select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    plan = convs.select("conv", (F.col("conv") - F.col("conv") % every).alias("base"), (F.crc32(F.col("conv").cast("string")) % most).alias("h"))
    plan = cut(plan.join(base, "base", "left").withColumn("m", F.least("h", F.coalesce("n_base", F.lit(0)))))
    heads = turns.where((F.col("conv") % every == 0) & (F.col("at") < most)).withColumnRenamed("conv", "base")
    given = plan.where("m > 0").select("conv", "base", "m").join(heads, "base").where("at <= m").select("conv", F.col("at").alias("depth"), "t1", "t2", "size")
    own = turns.join(plan.select("conv", "h", "m"), "conv").where("at > h").select("conv", (F.col("m") + F.col("at") - F.col("h")).alias("depth"), "t1", "t2", "size")
    return given.unionByName(own), plan.select("conv")


def _wrapped(total: Column) -> Column:
    return F.pmod(total, F.lit(str(WRAP)).cast("decimal(20,0)")).cast("long")


def _stretches(turns: DataFrame, stretch: int) -> DataFrame:
    """(conv, q, b1, b2, k1, k2, seq): stretch q of each conversation, with the keys before it and at its end."""
    place = F.col("depth").cast("long")
    hashed = turns.select(
        "conv", F.expr(f"(depth - 1) div {stretch}").alias("q"),
        F.struct(place.alias("depth"), F.xxhash64(F.lit(3), place, "t1", "t2").alias("g1"), F.xxhash64(F.lit(4), place, "t1", "t2").alias("g2"), "size").alias("turn"),
    )
    sums = [F.sum(F.col(f"turn.g{k}").cast("decimal(20,0)")).cast("decimal(36,0)").alias(f"s{k}") for k in (1, 2)]
    rows = cut(hashed.groupBy("conv", "q").agg(F.array_sort(F.collect_list("turn")).alias("turns"), *sums))  # so many turns at most
    summed = ordered.prefix_sums(rows, ["conv"], ["q"], {"u1": F.col("s1"), "u2": F.col("s2")})
    seq = F.transform("turns", lambda t: F.struct(t["g1"].alias("g1"), t["g2"].alias("g2"), t["size"].alias("size")))
    before = [_wrapped(F.col(f"u{k}") - F.col(f"s{k}")).alias(f"b{k}") for k in (1, 2)]
    return cut(summed.select("conv", "q", *before, *[_wrapped(F.col(f"u{k}")).alias(f"k{k}") for k in (1, 2)], seq.alias("seq")))


def _least(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: entry k has the least of every 2**k values in a row."""
    table = [values]
    while len(table[-1]) > 1 << (len(table) - 1):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def _range_least(table: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least value of each stretch, both ends included: two entries that overlap."""
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), dtype=table[0].dtype)
    for k in np.unique(level):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[k][first[at]], table[k][last[at] - (1 << k) + 1])
    return out


def extents(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place around ``at`` that share ``depth`` turns with it; place i shares ``table[0][i]`` turns with the one before.

    Each end is searched on its own, by steps that halve.
    """
    n = len(table[0])
    first, last = at.copy(), at.copy()
    for k in range(len(table) - 1, -1, -1):
        step, least = 1 << k, table[k]
        # the LCPs between a place and one ``step`` to its left are the ``step`` that end at the place itself
        ok = first - step >= 0
        ok[ok] = least[first[ok] - step + 1] >= depth[ok]
        first[ok] -= step
        ok = last + step < n
        ok[ok] = least[last[ok] + 1] >= depth[ok]
        last[ok] += step
    return first, last


def _common(group: np.ndarray, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Turns that each sequence shares with the one before it; none across groups."""
    size = np.diff(bounds)
    both = np.minimum(size[1:], size[:-1]) * (group[1:] == group[:-1]).all(axis=1)
    place = arrays.within(both)
    differ = (codes[np.repeat(bounds[:-2], both) + place] != codes[np.repeat(bounds[1:-1], both) + place]).any(axis=1)
    cuts = np.append(0, np.cumsum(both))
    upto = np.append(0, np.cumsum(differ))
    clean = upto[1:] - np.repeat(upto[cuts[:-1]], both) == 0
    return np.append(0, arrays.segment_sums(clean.astype(np.int64), cuts))


def _local_nodes(batches: Iterable[pa.RecordBatch], stretch: int) -> Iterator[pa.RecordBatch]:
    """The nodes of the sorted rows (shard, q, b1, b2, n, conv, seq) of one shard, as far as the shard knows them."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    (rows,) = pa.Table.from_batches(held).combine_chunks().to_batches()
    column = lambda name: rows.column(name).to_numpy()
    q, n, conv = column("q"), column("n"), column("conv")
    base = np.stack([column("b1"), column("b2")], axis=1)
    seq = rows.column("seq")
    turns = seq.flatten()
    bounds = np.append(0, np.cumsum(np.asarray(seq.value_lengths())))
    codes = np.stack([turns.field("g1").to_numpy(), turns.field("g2").to_numpy()], axis=1)
    size = turns.field("size").to_numpy()

    lcp = _common(np.concatenate([q[:, None], base], axis=1), codes, bounds)
    # each prefix is a candidate where it stands first
    new = np.diff(bounds) - lcp
    at = np.repeat(np.arange(len(q)), new)
    depth = lcp[at] + 1 + arrays.within(new)
    first, last = extents(_least(lcp), at, depth)
    members = np.append(0, np.cumsum(n))
    keys = []
    turn = bounds[at] + depth - 1
    for k in (0, 1):
        total = np.append(np.uint64(0), np.cumsum(codes[:, k].view(np.uint64)))
        own = base[at, k].view(np.uint64) - total[bounds[at]]
        keys += [((own + total[turn + 1]) & np.uint64(WRAP - 1)).view(np.int64), ((own + total[turn]) & np.uint64(WRAP - 1)).view(np.int64)]
    k1, p1, k2, p2 = keys
    shard = np.full(len(at), column("shard")[0], dtype=np.int32)
    out = [shard, first.astype(np.int32), last.astype(np.int32), q[at] * stretch + depth, k1, k2, p1, p2, members[last + 1] - members[first], _range_least(_least(conv), first, last), size[turn]]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, LOCAL.types)], schema=LOCAL)


def _subtrees(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of a shard's own values over each node's subtree: in order of interval and depth, a subtree is what begins inside the interval."""
    rows = rows.sort_values(["first", "depth"], kind="stable")
    ends = np.searchsorted(rows["first"].to_numpy(), rows["last"].to_numpy(), "right")
    out = rows[["depth", "k1", "k2", "p1", "p2"]].copy()
    for c in ("saved", "leaves"):
        total = np.append(0, np.cumsum(rows[c].to_numpy()))
        out[c] = total[ends] - total[:-1]
    return out


def _same(*names: str) -> list[Column]:
    return [F.col(c) for c in names]


def _subtree_sums(local: DataFrame, own: DataFrame, levels: int, stretch: int) -> DataFrame:
    """(depth, k1, k2, p1, p2, saved, leaves) summed over subtrees; stretches that lie deeper come first and are handed up."""
    done, below = None, None
    for level in range(levels - 1, -1, -1):
        low, high = level * stretch, (level + 1) * stretch
        rows = local.where((F.col("depth") > low) & (F.col("depth") <= high)).join(own.select(*NODE, "owner", "saved", "leaves"), NODE)
        if below is not None:
            rows = rows.join(below, (F.col("depth") == high) & (F.col("k1") == F.col("q1")) & (F.col("k2") == F.col("q2")), "left")
            rows = rows.withColumns({c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("saved", "leaves")})
        # a node that several shards know has its own values in one of them
        mine = [F.when(F.col("shard") == F.col("owner"), F.col(c)).otherwise(0).cast("long").alias(c) for c in ("saved", "leaves")]
        sums = rows.select("shard", "first", "last", *NODE, "p1", "p2", *mine).groupBy("shard").applyInPandas(
            _subtrees, "depth long, k1 long, k2 long, p1 long, p2 long, saved long, leaves long"
        )
        total = cut(sums.groupBy(*NODE, "p1", "p2").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")))
        done = total if done is None else done.unionByName(total)
        below = total.where(F.col("depth") == low + 1).groupBy(F.col("p1").alias("q1"), F.col("p2").alias("q2")).agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
    return done


def _id_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, k1, k2, conv) rows as (depth, k1, k2, conv, ids): the ids of a run of one node, the first of them apart."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        node = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
        starts = np.flatnonzero(np.append(True, (node[1:] != node[:-1]).any(axis=1)))
        names = list(map(str, batch.column(3).to_pylist()))
        ids = [",".join(names[a:b]) for a, b in zip(starts, np.append(starts[1:], len(names)))]
        yield pa.RecordBatch.from_arrays([*(c.take(pa.array(starts)) for c in batch.columns), pa.array(ids)], ["depth", "k1", "k2", "conv", "ids"])


def _id_hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(depth, k1, k2, ends_sha256) from sorted runs; holds one hash and a batch."""
    node, digest = None, None
    for batch in batches:
        out = []
        for *key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if key != node:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*NODE, "ends_sha256"])
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, digest.hexdigest())], [*NODE, "ends_sha256"])


def _ends(stretches: DataFrame, convs: DataFrame, stretch: int) -> DataFrame:
    """(depth, k1, k2, ends_sha256): a digest of the ids, ascending, of the conversations that end at a node.

    Ids are put in order over range partitions, which split a node that very many end at; only their text, run by run, is then brought together.
    """
    last = stretches.groupBy("conv").agg(F.max(F.struct("q", (F.col("q") * stretch + F.size("seq")).alias("depth"), "k1", "k2")).alias("e"))
    zero = F.lit(0).cast("long")
    ends = convs.join(last, "conv", "left").select(*[F.coalesce(f"e.{c}", zero).alias(c) for c in NODE], "conv")
    runs = ends.repartitionByRange(*_same(*NODE, "conv")).sortWithinPartitions(*NODE, "conv").mapInArrow(_id_runs, "depth long, k1 long, k2 long, conv long, ids string")
    return runs.repartition(*_same(*NODE)).sortWithinPartitions(*NODE, "conv").mapInArrow(_id_hashes, "depth long, k1 long, k2 long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, stretch: int = STRETCH, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct prefix (node) of conversations given as ``turns`` (conv, depth from 1, t1, t2, size) and all their ids ``convs`` (conv).

    conv_id: the smallest member; depth; parent_conv_id: that of the prefix one turn shorter, null for the root; n_convs: members;
    n_children; n_leaves: nodes of the subtree without children; saved_tokens: over the subtree, (members - 1) times the code points of a node's
    last turn; ends_sha256: of the members with no further turn, ids ascending and joined by commas. Conversations without turns
    are members of the root. Equal conversations are one row before anything is sorted. An empty table gives an empty one, without a root.
    """
    stretches = _stretches(turns, stretch)
    by = ["q", "b1", "b2", "seq"]
    distinct = cut(stretches.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")))
    found = distinct.agg(F.sum(F.size("seq")).alias("turns"), F.max("q").alias("q")).first()
    shards, levels = 1 + (found.turns or 0) // shard_turns, 1 + (found.q or 0)
    placed = distinct.repartitionByRange(shards, *by).sortWithinPartitions(*by).withColumn("shard", F.spark_partition_id())
    kinds = ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'long'}" for f in LOCAL)
    local = cut(placed.select("shard", "q", "b1", "b2", "n", "conv", "seq").mapInArrow(partial(_local_nodes, stretch=stretch), kinds))

    # a prefix that reaches over the ends of shards is put together here
    nodes = local.groupBy(*NODE).agg(
        *[F.max(c).alias(c) for c in ("p1", "p2", "size")], F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("shard").alias("owner")
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0").select(
        *[zero.alias(c) for c in NODE], none.alias("p1"), none.alias("p2"), zero.alias("size"), "n_convs", "conv_id", F.lit(None).cast("int").alias("owner")
    )
    nodes = cut(nodes.unionByName(root))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut(
        nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero))
        .withColumns({"saved": (F.col("n_convs") - 1) * F.col("size"), "leaves": (F.col("n_children") == 0).cast("long")})
    )
    sums = _subtree_sums(local, nodes.where("depth > 0"), levels, stretch)
    whole = sums.where("depth = 1").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves")).select(*[zero.alias(c) for c in NODE], "saved_tokens", "n_leaves")
    sums = sums.select(*NODE, F.col("saved").alias("saved_tokens"), F.col("leaves").alias("n_leaves")).unionByName(whole)
    above = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    told = nodes.drop("saved", "leaves").join(sums, NODE, "left").join(above, ["depth", "p1", "p2"], "left").join(_ends(stretches, convs, stretch), NODE, "left")
    return told.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
