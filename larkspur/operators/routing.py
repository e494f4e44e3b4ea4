"""Routing rows to several outputs, and user functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERRORS = "validation_errors"


def with_errors(df: DataFrame, rules, name: str = ERRORS) -> DataFrame:
    """Add the list of broken rules.

    ``rules`` holds pairs of a label (text or Column) and the condition under
    which a row is wrong; a condition that is null counts as not broken.
    """
    found = [F.when(bad, label if isinstance(label, Column) else F.lit(label)) for label, bad in rules]
    return df.withColumn(name, F.array_compact(F.array(*found)))


def split(df: DataFrame, name: str = ERRORS) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the list, and invalid rows with it as text."""
    broken = F.size(name) > 0
    return df.filter(~broken).drop(name), df.filter(broken).withColumn(name, F.array_join(name, ", "))


def map_rows(df: DataFrame, columns: dict, required=()) -> tuple[DataFrame, DataFrame]:
    """Rows through column expressions; rows that lack a required column go to the second frame."""
    checked = with_errors(df, [(f"missing_{c}", F.col(c).isNull()) for c in required]) if required else df.withColumn(ERRORS, F.array())
    good, bad = split(checked)
    return good.withColumns(columns), bad


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """A user function over pandas batches, for logic no built-in expresses."""
    return df.mapInPandas(function, schema)


def group_apply(df: DataFrame, keys, summarise, schema, combine) -> DataFrame:
    """A user function over the rows of each key, as pandas frames, in two steps.

    ``summarise`` sees the rows of one key in one batch of a task's rows; ``combine`` turns the results of a key, which have the same columns,
    into one. A key costs the shuffle a row per batch, so no task ever holds all rows of a large key, at any size.
    """
    keys = list(keys)

    def parts(batches):
        for batch in batches:
            for _, rows in batch.groupby(keys, dropna=False, sort=False):
                yield summarise(rows)

    return df.mapInPandas(parts, schema).groupBy(*keys).applyInPandas(combine, schema)
