"""Rows told apart by id and text, and a filter of bounded size that spares most rows a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.session import cut

#: Rows of 64 bits in a filter that is broadcast: 4 MB at most.
FILTER_SLOTS = 1 << 18


def keyed(df: DataFrame, id: str, text: str) -> DataFrame:
    """(doc_id, row, text); texts that share an id are told apart by ``row``, the xxhash64 of the text. Null text is empty."""
    told = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return df.select(F.col(f"`{id}`").alias("doc_id"), F.xxhash64(told).alias("row"), told.alias("text"))


def same_row(of: str = "of", of_row: str = "of_row") -> Column:
    return F.col("doc_id").eqNullSafe(F.col(of)) & (F.col("row") == F.col(of_row))


def apart(docs: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows (doc_id, row, text) with one of each group of equal rows, and the further ones, if there are any; ``known`` has a row (doc_id, row) for each of ``docs``, if these need not be read for it."""
    again = cut((docs if known is None else known).groupBy("doc_id", "row").count().where("count > 1").select(F.col("doc_id").alias("of"), F.col("row").alias("of_row")))
    if again.isEmpty():
        return docs, None
    equal = cut(docs.join(again, same_row(), "left_semi").withColumn("_at", F.monotonically_increasing_id()))
    first = equal.groupBy("doc_id", "row").agg(F.min("_at").alias("_at")).select("_at")
    one_each = docs.join(again, same_row(), "left_anti").unionByName(equal.join(first, "_at", "left_semi").drop("_at"))
    return one_each, equal.join(first, "_at", "left_anti").drop("_at")


def sieve(rows: DataFrame, keys: DataFrame, hashed: Column, alias: str) -> DataFrame:
    """Adds ``alias``: whether the row may be one of ``keys`` by ``hashed``, a 64-bit hash of columns that both have; false is certain."""
    bit = F.shiftright(hashed, 32).bitwiseAND(F.lit(63)).cast("int")
    slot = F.pmod(hashed, F.lit(FILTER_SLOTS))
    bits = keys.select(slot.alias("_slot"), bit.alias("_bit")).groupBy("_slot").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    joined = rows.withColumns({"_slot": slot, "_bit": bit}).join(F.broadcast(bits), "_slot", "left")
    hit = F.coalesce(F.expr("shiftright(_bits, _bit) & 1 = 1"), F.lit(False))
    return joined.withColumn(alias, hit).drop("_slot", "_bit", "_bits")
