"""Conversations in reply order, by linking quotations to the messages they come from.

Messages are parsed into quoted passages by level and what is left. Hashes of
quoted passages and lines meet hashes of earlier messages' own passages and
lines; a message answers the one most of its outermost quotes come from, or
else the message before it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators import ordered
from larkspur.session import cut

QUOTE = re.compile(r"\s{0,3}((?:>\s?)+)(.*)", re.S)
#: A line that only announces the quote below it.
ANNOUNCES = re.compile(r"(?i)\s*(on\b.*\bwrote|.*\b(writes|wrote|said))\s*:\s*")


def _unit(text: str) -> str | None:
    words = text.lower().split()
    return hashlib.blake2b(" ".join(words).encode(), digest_size=16).hexdigest() if words else None


def _units(runs: list[list[str]]) -> list[str]:
    """Hashes of each run of lines as a whole and of its lines."""
    found = [_unit("\n".join(run)) for run in runs] + [_unit(line) for run in runs for line in run]
    return list(dict.fromkeys(u for u in found if u))


def parse(text: str | None) -> tuple[str, list[str], list[tuple[int, str]]]:
    """Text without quotes, its units, and the (level, unit) pairs of its quotes."""
    own: list[str] = []
    runs: list[tuple[int, list[str]]] = []  # level 0 is the message's own text
    for line in (text or "").split("\n"):
        match = QUOTE.match(line)
        level = match[1].count(">") if match else 0
        if level:
            while own and runs and runs[-1][0] == 0 and ANNOUNCES.fullmatch(own[-1]):
                own.pop()
                runs[-1][1].pop()
        else:
            own.append(line)
        content = match[2] if match else line
        if runs and runs[-1][0] == level and content.strip():
            runs[-1][1].append(content)
        else:
            runs.append((level, [content] if content.strip() else []))
    quoted = [(level, u) for level, run in runs if level for u in _units([run])]
    kept = "\n".join(own).strip("\n") if quoted else (text or "")
    mine = _units([run for level, run in runs if not level])
    whole = _unit(kept)
    return kept, list(dict.fromkeys(mine + ([whole] if whole else []))), list(dict.fromkeys(quoted))


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = pa.list_(pa.struct([("level", pa.int32()), ("unit", pa.string())]))
    for batch in batches:
        own, units, quoted = zip(*map(parse, batch.column(4).to_pylist())) if batch.num_rows else ((), (), ())
        quoted = [[{"level": a, "unit": b} for a, b in q] for q in quoted]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(own, pa.string()), pa.array(units, pa.list_(pa.string())), pa.array(quoted, pairs)], [*batch.schema.names, "own", "units", "quoted"]
        )


def running_max(df: DataFrame, keys, order, value: str, alias: str, max_rows: int | None = None) -> DataFrame:
    """Largest value so far per key, current row included; null before the first value. The order has to be total."""
    return ordered.running(df, keys, order, {alias: F.col(value)}, F.max, F.greatest, max_rows)


def _toured(runs: DataFrame) -> DataFrame:
    """(conv, run, offset, branch) of runs (conv, run, start, n, up, parent): messages that come before a run in reply order, and runs above it.

    The tour of a conversation's tree enters a run, goes through the runs that branch off it, the deepest branch first, and leaves it. What is left of the
    tour after each step is summed by pointer doubling over the tour's list: two numbers a step, however deep the tree.
    """
    kids = cut(runs.where("run > 0"))
    after = F.struct((-F.col("parent")).alias("m"), "start")
    first = kids.groupBy("conv", "up").agg(F.min_by("run", after).alias("child"))
    aside = ordered.neighbour(kids.withColumn("back", -F.col("parent")), ["conv", "up"], ["back", "start"], "run", -1, "aside")
    known = runs.join(first.withColumnRenamed("up", "run"), ["conv", "run"], "left").join(aside.select("conv", "run", "aside"), ["conv", "run"], "left")
    enter, leave = F.col("run") * 2, F.col("run") * 2 + 1
    home = F.when(F.col("run") > 0, F.col("up") * 2 + 1)
    steps = F.array(
        F.struct(enter.alias("step"), F.coalesce(F.col("child") * 2, leave).alias("next"), F.col("n").alias("w"), F.lit(1).cast("long").alias("d")),
        F.struct(leave.alias("step"), F.coalesce(F.col("aside") * 2, home).alias("next"), F.lit(0).cast("long").alias("w"), F.lit(-1).cast("long").alias("d")),
    )
    tour = cut(known.select("conv", F.inline(steps)))
    while not tour.where("next IS NOT NULL").isEmpty():
        further = tour.select("conv", F.col("step").alias("next"), F.col("next").alias("then"), F.col("w").alias("w2"), F.col("d").alias("d2"))
        joined = tour.join(further, ["conv", "next"], "left")
        zero = F.lit(0).cast("long")
        tour = cut(joined.select("conv", "step", F.col("then").alias("next"), (F.col("w") + F.coalesce("w2", zero)).alias("w"), (F.col("d") + F.coalesce("d2", zero)).alias("d")))
    whole = tour.where("step = 0").select("conv", F.col("w").alias("whole"))
    entered = tour.where("step % 2 = 0").join(whole, "conv")
    return entered.select("conv", F.expr("step div 2").alias("run"), (F.col("whole") - F.col("w")).alias("offset"), (-F.col("d")).cast("int").alias("branch"))


def reply_ordered(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row (conv_id, position, turn, role, text, reply_to, branch) per message, quotes removed.

    Lines that begin with ``>`` are quotes, their number of ``>`` is the level; a line that announces a quote goes with
    it. Passages are compared by their words in lower case. A message answers the latest earlier message of its
    conversation that most of its outermost known quotes come from, or the message before it. ``reply_to`` is that
    message's turn, null for the first. ``position`` (from 1) puts every message after the one it answers,
    depth first, answers to one message by turn; ``branch`` counts the quotes on the way that left the flow of turns.

    Messages of a conversation are taken by (turn, role, text), nulls first; equal rows are messages of their own. Rows without
    conversation id are one conversation. Null text is empty; a message is parsed whole, so a task holds an Arrow batch or one long message. Other columns
    are not read; an empty table gives an empty one. Work is by message, passage and branch, never by whole conversation, and a message carries numbers only.
    """
    conv = F.when(F.col(f"`{conversation}`").isNull(), "-").otherwise(F.concat(F.lit("="), F.col(f"`{conversation}`").cast("string")))
    rows = df.select(
        conv.alias("conv"), F.col(f"`{conversation}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").cast("string").alias("text")
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    parsed = rows.mapInArrow(_parsed, f"{kinds}, own string, units array<string>, quoted array<struct<level:int,unit:string>>")
    # equal rows have a place of their own too, so that a conversation of equal rows can be cut into segments
    parsed = cut(parsed.withColumn("_row", F.monotonically_increasing_id()))
    messages = cut(ordered.row_number(parsed, ["conv"], ["turn", "role", "text", "_row"], "at").drop("_row"))

    had = messages.select("conv", F.explode("units").alias("unit"), "at", F.lit(None).cast("int").alias("level"))
    asked = messages.select("conv", F.explode("quoted").alias("q"), "at").select("conv", "q.unit", "at", "q.level")
    # only units that are quoted; their list is written, so that the join can split a hot one
    known = had.join(cut(asked.select("conv", "unit").distinct()), ["conv", "unit"], "left_semi")
    rows = known.unionByName(asked).withColumns({"own": F.col("level").isNull(), "place": F.when(F.col("level").isNull(), F.col("at"))})
    # a message's quotes come before its own units; the latest place is the largest
    found = running_max(cut(rows), ["conv", "unit"], ["at", "own"], "place", "source")
    votes = found.where("level IS NOT NULL AND source IS NOT NULL").groupBy("conv", "at", "source").agg(F.min("level").alias("level"), F.count("*").alias("n"))
    quoted = votes.groupBy("conv", "at").agg(F.max_by("source", F.struct(-F.col("level"), "n", "source")).alias("source"))

    # a message that does not answer the one before it begins a run; inside runs order is plain
    leaves = F.col("source").isNotNull() & (F.col("source") != F.col("at") - 1)
    linked = messages.drop("units", "quoted", "text").join(quoted, ["conv", "at"], "left").withColumn("leaves", F.coalesce(leaves, F.lit(False)).cast("int"))
    linked = cut(linked.withColumn("parent", F.when(F.col("leaves") == 1, F.col("source")).when(F.col("at") > 1, F.col("at") - 1)))
    linked = cut(ordered.prefix_sums(linked, ["conv"], ["at"], {"run": F.col("leaves")}))
    above = linked.select(F.col("conv").alias("c"), F.col("at").alias("a"), F.col("run").alias("up"), F.col("turn").alias("reply_to"))
    linked = linked.join(above, (F.col("conv") == F.col("c")) & (F.col("parent") == F.col("a")), "left").drop("c", "a")
    # only conversations that branch have an order of their own
    branched = linked.groupBy("conv", "run").agg(
        F.min("at").alias("start"), F.count("*").alias("n"), F.max(F.when(F.col("leaves") == 1, F.col("up"))).alias("up"), F.max(F.when(F.col("leaves") == 1, F.col("parent"))).alias("parent")
    )
    runs = cut(branched.join(linked.where("run > 0").select("conv").distinct(), "conv", "left_semi"))
    placed = linked.join(_toured(runs).join(runs.select("conv", "run", "start"), ["conv", "run"]), ["conv", "run"], "left")
    position = F.coalesce(F.col("offset") + F.col("at") - F.col("start") + 1, F.col("at"))
    return placed.select("conv_id", position.cast("long").alias("position"), "turn", "role", F.col("own").alias("text"), "reply_to", F.coalesce("branch", F.lit(0)).alias("branch"))
