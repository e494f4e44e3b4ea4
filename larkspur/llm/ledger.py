"""Secret scans over an incremental ledger of blobs.

Every version of a text is named by the digest of its content. The ledger keeps,
for each blob, which versions of which rules have looked at it and what they
found. A scan looks only at pairs of blob and rule version that the ledger
doesn't have, adds them, and joins all findings back to every place of a blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm import arrays
from larkspur.llm.rowkeys import sieve
from larkspur.session import cut

#: A blob with more than this part of all places has its places spread over several tasks.
HOT_PART = 1_000

LEDGER = "blob binary, rules array<string>, findings array<struct<rule:string,start:int,end:int>>"
SCANNED = pa.schema(
    [("blob", pa.binary()), ("todo", pa.int64()), ("findings", pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))]
)


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``pattern`` is matched against the UTF-8 bytes of a text, with A-Z as a-z where ``fold`` says so.

    A match counts if ``group`` has ``least`` bytes or more. Change ``version`` with the pattern, and texts are scanned again.
    """

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    fold: bool = False
    version: str = "1"

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base kinds, in their order.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", least=12, group=2, fold=True),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Kinds besides: heads of private keys, signed tokens.
RULES = (*BASE, Rule("key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"), Rule("signed", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"))


def find(raw: bytes, rules: Iterable[tuple[Rule, re.Pattern]]) -> list[dict]:
    """Leftmost matches of each rule that don't overlap, as code points."""
    low, plain = raw.translate(arrays.LOWER), raw.isascii()
    at = (lambda i: i) if plain else (lambda i: len(raw[:i].decode()))
    out = []
    for rule, pattern in rules:
        for match in pattern.finditer(low if rule.fold else raw):
            if match.end(rule.group) - match.start(rule.group) >= rule.least:
                out.append({"rule": rule.name, "start": at(match.start()), "end": at(match.end())})
    return out


def _scan(batches: Iterable[pa.RecordBatch], rules: tuple[Rule, ...]) -> Iterator[pa.RecordBatch]:
    """Findings of (blob, todo, text) rows; bit i of ``todo`` asks for rule i."""
    compiled = [(r, re.compile(r.pattern.encode())) for r in rules]
    for batch in batches:
        for piece in arrays.pieces(batch, 2):
            data, bounds = arrays.utf8(piece.column(2))
            raw = data.tobytes()
            found = []
            for i, todo in enumerate(piece.column(1).to_pylist()):
                found.append(find(raw[bounds[i] : bounds[i + 1]], [c for k, c in enumerate(compiled) if todo >> k & 1]))
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(found, SCANNED.field(2).type)], schema=SCANNED)


def _bits(rules: tuple[Rule, ...], names: str) -> Column:
    """The rules whose names are in the array column, as bits."""
    seen = [F.when(F.array_contains(names, r.name), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(rules)]
    return sum(seen[1:], seen[0])


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (id, blob, spans) per row of ``versions``, after the ledger has been brought up to date.

    ``spans`` are (kind, start, end) in code points, end exclusive, by start, then by the order of ``rules``. ``ledger`` is a
    folder that all executors reach; it need not exist. Its rows stand for themselves, so those of a run that failed half-way
    are used by the next one and nothing is found twice. A text that several rows share is scanned once; one that nobody else has,
    and that the ledger doesn't know, is scanned where it is read, without a shuffle of texts. At most 62 rules.

    Null text is empty; null and repeated ids and repeated rows are rows like any other; other columns are not read; an empty
    table gives an empty one. A task holds a few MB of texts, or one text.
    """
    spark = versions.sparkSession
    every = (1 << len(rules)) - 1
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger)  # now there is a folder
    kept = spark.read.schema(LEDGER).parquet(ledger)

    docs = versions.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("blob", F.unhex(F.sha2("text", 256)))
    places = cut(docs.select("id", "blob"))
    seen = kept.select("blob", _bits(rules, "rules").alias("seen")).groupBy("blob").agg(F.bit_or("seen").alias("seen"))
    blobs = cut(places.groupBy("blob").agg(F.count(F.lit(1)).alias("n")).join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.lit(0).cast("long"))))
    todo = blobs.where(F.col("seen") != every)

    # nobody else has it and the ledger doesn't know it: no join can tell more
    marked = sieve(sieve(docs.select("blob", "text"), todo, F.xxhash64("blob"), "asked"), blobs.where("n > 1 OR seen > 0"), F.xxhash64("blob"), "shared").where("asked")
    alone = marked.where("NOT shared").select("blob", F.lit(every).cast("long").alias("todo"), "text")
    several = marked.where("shared").join(todo.select("blob", (F.lit(every) - F.col("seen")).alias("todo")), "blob").dropDuplicates(["blob"]).select("blob", "todo", "text")
    kinds = "blob binary, todo long, findings array<struct<rule:string,start:int,end:int>>"
    fresh = alone.unionByName(several).mapInArrow(partial(_scan, rules=rules), kinds)
    asked = F.filter(F.array(*[F.when(F.expr(f"todo >> {i} & 1 = 1"), F.lit(r.name)) for i, r in enumerate(rules)]), lambda x: x.isNotNull())
    fresh.select("blob", asked.alias("rules"), "findings").write.mode("append").parquet(ledger)
    return _placed(places, blobs, spark.read.schema(LEDGER).parquet(ledger), rules)


def _placed(places: DataFrame, blobs: DataFrame, kept: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of each blob at all its places; the places of a hot blob are dealt to several tasks."""
    names = [r.name for r in rules]
    some = kept.select("blob", F.filter("findings", lambda f: f["rule"].isin(*names)).alias("found")).where(F.size("found") > 0)
    # a row per run that looked at the blob; two runs at once may both have found the same
    found = some.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"))
    total = places.count()
    hot = blobs.where(F.col("n") * HOT_PART > total).select("blob", (F.col("n") * HOT_PART / max(total, 1)).cast("int").alias("_parts"))  # fewer than HOT_PART rows
    parts = F.coalesce("_parts", F.lit(1))
    left = places.join(F.broadcast(hot), "blob", "left").withColumn("_part", (F.monotonically_increasing_id() % parts).cast("int"))
    right = found.join(F.broadcast(hot), "blob", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    rank = F.array(*[F.lit(n) for n in names])
    ordered = F.array_sort(F.transform("found", lambda f: F.struct(f["start"].alias("start"), F.array_position(rank, f["rule"]).alias("rank"), f["end"].alias("end"))))
    kind = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform(ordered, lambda s: F.struct(F.element_at(kind, s["rank"].cast("int")).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    joined = left.drop("_parts").join(right.drop("_parts"), ["blob", "_part"], "left")
    return joined.select("id", "blob", F.coalesce(spans, F.array().cast("array<struct<kind:string,start:int,end:int>>")).alias("spans"))


def digests(found: DataFrame, base: Iterable[str] = tuple(r.kind for r in BASE)) -> DataFrame:
    """Counts and digest of the base kinds of ``scan``'s rows, and all spans as text."""
    base = list(base)
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of([k])).cast("long").alias(f"n_{k}") for k in base]
    return found.select("id", *counts, F.sha2(shown(of(base)), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
