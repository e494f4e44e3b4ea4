"""Near-duplicate documents by an exact n-gram Jaccard join with adaptive multi-match prefixes.

A document of n shingles that asks for k matches takes the first
``n - least(n) + k`` of them, rarest first; two linked documents share at least
min(k, k') of the tokens that both prefixes hold at that depth. Longer prefixes
cost more postings but let fewer pairs through: how many fewer is measured on the
members of a sample of posting lists, by the length of the list. Each document picks its k by
estimated cost: the postings its prefix would meet, and the verifications of
the sets that share k of its tokens.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import arrays, graph, setjoin
from larkspur.llm.setjoin import Rule
from larkspur.session import cut

#: Match counts a document may choose from; the first is 1.
DEPTHS = (1, 2, 3, 4, 6, 8)
#: What a met posting costs, which is joined, moved and counted; in shingles compared.
POSTING_COST = 4
#: Postings of the lists that overlaps are measured on, about, and members taken from a list. Only the choice of depths depends on them, no link does.
SAMPLED_POSTINGS, SAMPLED_MEMBERS = 8_192, 8

POSTING = {"t": "long", "v": "long", "n": "long", "level": "int", "place": "long", "df": "long", "centre": "double"}


def _measure(batches: Iterable[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in arrays.pieces(batch, 1):
            of = arrays.words(*setjoin.whole(piece.column(1)), arrays.NOT_SPACE)
            k1, k2 = arrays.keys(of)
            _, bounds = arrays.shingles(of, rule.size)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(k1), pa.array(k2), pa.array(np.diff(bounds))], ["doc_id", "k1", "k2", "n"])


def _prefixes(batches: Iterable[pa.RecordBatch], rule: Rule, deepest: int) -> Iterator[pa.RecordBatch]:
    """Postings (t, v, n, level, place, df, centre) of the prefixes that ask for ``deepest`` matches.

    Level is the smallest k whose prefix holds the token, df the number of sets that have it. Centre is the mean log of the set's token counts: of a group of near copies, the
    text that the others were made from has no tokens of its own and comes first.
    """
    for batch in setjoin.runs(batches):
        v, n, rare = (batch.column(i) for i in range(3))
        bounds = rare.offsets.to_numpy()
        df, t = (rare.values.field(i).to_numpy() for i in (0, 1))
        out = []
        for i in range(batch.num_rows):
            size = n[i].as_py()
            own, tokens = df[bounds[i] : bounds[i + 1]], t[bounds[i] : bounds[i + 1]]
            place = size - len(own) + np.arange(len(own))  # after the tokens no other set has
            level = np.maximum(1, place - (size - rule.least(size)) + 1)
            r = int(np.searchsorted(level, deepest, "right"))
            out.append((tokens[:r], np.full(r, v[i].as_py()), np.full(r, size), level[:r], place[:r], own[:r], np.full(r, np.log2(own).sum() / size)))
        if out:
            t_, v_, n_, level, place, df_, centre = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (t_, v_, n_, level.astype(np.int32), place, df_, centre)], list(POSTING))


def _overlaps(postings: DataFrame, depths: tuple[int, ...]) -> DataFrame:
    """(size, hits, s1, s2, ...) by the log of a list's length: of pairs of members of one list, the mean number of tokens that both first prefixes share, and the part
    that shares as many tokens as each depth asks for."""
    every = max(1, postings.count() // SAMPLED_POSTINGS)
    taken = (F.col("level") == 1) & (F.pmod(F.xxhash64("t"), F.lit(every)) == 0) & (F.pmod(F.xxhash64("v", "t"), F.col("df")) < SAMPLED_MEMBERS)
    members = postings.where(taken).select("t", "v", F.floor(F.log2("df")).cast("int").alias("size"))
    pairs = cut(members.join(members.select("t", F.col("v").alias("w")), "t").where("v < w").select("v", "w", "size").distinct())
    own = postings.select("v", "t", "level")
    shared = pairs.join(own, "v").join(own.select(F.col("v").alias("w"), "t", F.col("level").alias("w_level")), ["w", "t"])
    counts = shared.groupBy("v", "w", "size").agg(*[F.count_if((F.col("level") <= k) & (F.col("w_level") <= k)).alias(f"h{k}") for k in depths])
    return counts.groupBy("size").agg(F.avg("h1").alias("hits"), *[F.avg((F.col(f"h{k}") >= k).cast("double")).alias(f"s{k}") for k in depths])


def chosen(postings: DataFrame, rule: Rule, depths: tuple[int, ...] = DEPTHS) -> DataFrame:
    """``postings`` with the depth their set asks for, without those that are deeper.

    A depth costs the postings that its prefix meets and the sets that are expected to share so many tokens: the first prefix's postings over the hits that a
    partner takes, times the part of such partners that the sample found to share as many. List lengths that the sample doesn't have count as if no partner went.
    """
    seen = F.broadcast(_overlaps(postings, depths))  # a row per log of a length, 64 at most
    rows = postings.withColumn("size", F.floor(F.log2("df")).cast("int")).join(seen, "size", "left")
    others = F.col("df") - 1
    met = [F.sum(F.when(F.col("level") <= k, others).otherwise(0)).alias(f"m{k}") for k in depths]
    partners = [F.sum(F.when(F.col("level") == 1, others * F.coalesce(f"s{k}", F.lit(1.0)) / F.greatest(F.coalesce("hits", F.lit(1.0)), F.lit(1.0))).otherwise(0)).alias(f"p{k}") for k in depths]
    costs = [F.when((F.lit(100 * k) <= F.col("n") * rule.percent), F.struct((F.col(f"m{k}") * POSTING_COST + F.col("n") * F.col(f"p{k}")).alias("cost"), F.lit(k).alias("k"))) for k in depths]
    best = F.array_min(F.array_compact(F.array(*costs)))["k"]
    deeper = rows.groupBy("v", "n").agg(*met, *partners).select("v", F.coalesce(best, F.lit(1)).alias("depth")).where("depth > 1")
    return postings.join(deeper, "v", "left").withColumn("depth", F.coalesce("depth", F.lit(1))).where("level <= depth")


def _enough(pairs: DataFrame, rule: Rule) -> DataFrame:
    """Of joined postings (v, w and their levels, depths), the pairs with the matches their depths ask for; a pair may be met in both orders."""
    k = F.least("depth", "w_depth")
    hit = (F.col("level") <= k) & (F.col("w_level") <= k)
    counted = pairs.groupBy("v", "w").agg(F.sum(hit.cast("int")).alias("hits"), F.first(k).alias("k"))
    return counted.where("hits >= k")


def _may_link(rule: Rule):
    """Length filter, and positional filter for the first k common tokens: those before, and what is left from here on."""
    k = F.least("depth", "w_depth")
    rest = F.least(F.col("n") - F.col("place"), F.col("w_n") - F.col("w_place"))
    need = F.ceil((F.col("n") + F.col("w_n")) * rule.percent / (100 + rule.percent))
    return (F.col("n") * 100 >= F.col("w_n") * rule.percent) & (F.col("w_n") * 100 >= F.col("n") * rule.percent) & (rest + k - 1 >= need)


def _renamed(postings: DataFrame, *more: str) -> DataFrame:
    return postings.select("t", *(F.col(c).alias(c if c == "v" else f"w_{c}") for c in ("n", "level", "depth", "place", *more)), F.col("v").alias("w"))


def _links(sets: DataFrame, rule: Rule, rounds: int = 2, depths: tuple[int, ...] = DEPTHS) -> DataFrame:
    """Enough links (v, w) among ``sets`` to connect all that are connected.

    In the first rounds every set is compared with one candidate only: of the
    pivots of its tokens' posting lists (first the most central members, then others), the one with most matches. Then all
    candidate pairs across what is not yet connected are compared. So a large
    group of near copies costs a comparison a member, not one a pair, and no
    link between two groups is lost.
    """
    postings = cut(
        setjoin.rarity(sets).mapInArrow(partial(_prefixes, rule=rule, deepest=depths[-1]), ", ".join(f"{c} {k}" for c, k in POSTING.items()))
    )
    postings = cut(chosen(postings, rule, depths).drop("df"))
    links, root = None, None
    for number in range(rounds + 1):
        labelled = postings.withColumn("root", F.col("v"))
        if root is not None:
            labelled = postings.join(root, F.col("v") == F.col("node"), "left").select(*postings.columns, F.coalesce("root", "v").alias("root"))
        if number < rounds:
            member = F.struct("v", "n", "level", "depth", "place", "root")
            first = F.struct("centre", "v") if number == 0 else F.struct(F.xxhash64("root", F.lit(number)), "centre", "v")
            pivot = labelled.groupBy("t").agg(F.max_by(member, first).alias("p"), F.min("root").alias("lo"), F.max("root").alias("hi"))
            pivot = pivot.where("lo <> hi").select("t", *(F.col(f"p.{c}").alias("w" if c == "v" else f"w_{c}") for c in ("v", "n", "level", "depth", "place", "root")))
            met = labelled.join(pivot, "t").where((F.col("root") != F.col("w_root")) & _may_link(rule))
            pairs = _enough(met, rule).groupBy("v").agg(F.max_by("w", F.struct("hits", "w")).alias("w"))
        else:
            counts = labelled.groupBy("t", "root").agg(F.count("*").alias("c"))
            most = counts.groupBy("t").agg(F.max_by("root", F.struct("c", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1").select("t", "most")
            listed = cut(labelled.join(most, "t"))
            other = _renamed(listed, "root", "most")
            met = listed.where("root <> most").join(other, "t").where(
                (F.col("root") != F.col("w_root")) & ((F.col("w_root") == F.col("w_most")) | (F.col("v") < F.col("w"))) & _may_link(rule)
            )
            # one token may put a pair in one order and the next in the other
            pairs = _enough(met.withColumns({"v": F.least("v", "w"), "w": F.greatest("v", "w")}), rule)
        found = setjoin.linked(pairs, sets, rule)
        links = cut(found if links is None else links.unionByName(found))
        root = graph.components(links.select(F.col("v").alias("a"), F.col("w").alias("b")))
    return root


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """One row (doc_id, n_shingles, component_id) per row of ``df``.

    A-Z is read as a-z; words are runs of anything but space and 0x09 to 0x0D;
    a text's set holds its distinct runs of ``rule.size`` words, or its whole
    sequence if it is shorter. Texts link by exact Jaccard similarity of at
    least ``rule.percent``; component_id is the smallest id reachable by links.

    A null, empty or wordless text has an empty set and links with nothing, also
    not with another one. Repeated rows and ids are rows like any other; copies are one class and are
    compared once. A null id is the component's id only where all its ids are null. Other columns are not read.
    An empty table gives an empty one.
    """
    rows = cut(
        df.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
        .mapInArrow(partial(_measure, rule=rule), f"doc_id {df.schema[id].dataType.simpleString()}, k1 long, k2 long, n long")
    )
    classes = cut(rows.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("least_id"), F.first("n").alias("n")))
    some = setjoin.numbered(setjoin.screen(df, text, classes, setjoin.whole, rule), F.col("least_id").asc_nulls_last())
    sets = setjoin.token_sets(df, text, some, setjoin.whole, rule)
    root = _links(sets, rule)
    named = some.select("k1", "k2", F.col("v").alias("node")).join(root, "node")
    named = named.join(some.select(F.col("v").alias("root"), F.col("least_id").alias("root_id")), "root")
    classes = classes.join(named.select("k1", "k2", "root_id"), ["k1", "k2"], "left")
    least = classes.select("k1", "k2", F.coalesce("root_id", "least_id").alias("component_id"))
    linked = rows.where("n > 0").join(least, ["k1", "k2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
