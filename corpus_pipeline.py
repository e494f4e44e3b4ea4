"""From raw documents to checked token counts: five stages, each written as Parquet and read again.

Stages decide by row and return the columns they were given, whatever those are called; null and empty texts have no
words, tokens or copies in the Jaccard stage and are one text for exact dedup; an empty table gives an empty one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import exact, jaccard, suffixes
from larkspur.llm.queries import token_digests, toxic_scores
from larkspur.session import shared_dir, tune


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def _hashable(docs: DataFrame) -> list[Column]:
    """The columns, those with maps as text."""
    return [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that differs where rows do and is never null: their id (none after all others), a digest of the text, a hash of the row; and its name."""
    sha = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", sha.alias("sha"), F.xxhash64(*_hashable(docs)).alias("rest"))
    name = _free(docs, "_row")
    return docs.withColumn(name, row), name


def _only(docs: DataFrame, row: str, kept: DataFrame) -> DataFrame:
    """Rows of keyed ``docs`` whose key ``row`` is a doc_id of ``kept``."""
    rows = kept.select(F.col("doc_id").alias(row)).distinct()
    return docs.join(rows, row, "left_semi").drop(row)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger does not reject."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    keyed, row = _keyed(docs)
    return _only(keyed, row, toxic_scores(keyed, labels, id=row).where("predicted = 0")).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id; of repeated rows one."""
    sha = F.sha2(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), 256)
    kept_id, kept_sha, own = (_free(docs, name) for name in ("_kept_id", "_kept_sha", "_sha"))
    kept = exact.deduplicate(docs).where("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha))
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (sha == F.col(kept_sha))
    return docs.join(kept, same, "left_semi").withColumn(own, sha).dropDuplicates(["doc_id", own]).drop(own)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id, a row with an id before one without; texts without words all stay."""
    keyed, row = _keyed(docs)
    size, each = _free(docs, "_n"), _free(docs, "_each")
    found = jaccard.near_duplicates(keyed, id=row).where("component_id = doc_id")
    kept = found.groupBy(F.col("doc_id").alias(row)).agg(F.max("n_shingles").alias(size))
    # equal rows have one key; those with words are one row, the others stay as many as they are
    told = keyed.join(kept, row).withColumn(each, F.when(F.col(size) == 0, F.monotonically_increasing_id()))
    return told.dropDuplicates([row, each]).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    keyed, row = _keyed(docs)
    return _only(keyed, row, suffixes.contamination(keyed, items, id=row).where("NOT contaminated")).select(docs.columns)


def count_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return token_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", count_tokens),
]

#: The tagger's training and BPE have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the session's shared folder."""
    docs = tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline/{uuid.uuid4()}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
