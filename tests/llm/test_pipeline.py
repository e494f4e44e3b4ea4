"""Registered text queries against their SQL, and the pipeline's stages against plain Python."""

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from larkspur.llm.queries import QUERIES, SQL
from larkspur.session import cut

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), SQL[name]) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    result = corpus_pipeline.run(spark, SMALL)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = cut(stage(spark, before, SMALL))  # as run() does
        assert kept.columns == docs.columns
        assert kept.exceptAll(before).count() == 0 and 0 < kept.count() <= before.count()
    # what is left decodes to the documents' own texts
    same = result.join(kept.select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("sha")), F.col("doc_id") == F.col("id"))
    assert same.where("sha = decoded_sha256").count() == result.count() == kept.count()


def test_stages_with_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "A b c"), (1, "A b c"), (2, "a B c"), (3, None), (4, ""), (None, "lonely words"), (None, None)], "doc_id long, text string")
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.lit(1).cast("long")})
    left = cut(corpus_pipeline.drop_copies(spark, cut(docs), SMALL))
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, "lonely words"), (2, "a B c"), (4, "")]
    assert corpus_pipeline.drop_near_copies(spark, left, SMALL).count() == 3
    assert corpus_pipeline.drop_contaminated(spark, left, SMALL).count() == 3
    assert corpus_pipeline.drop_toxic(spark, cut(docs.limit(0)), SMALL).count() == 0


def test_stages_keep_other_columns(spark):
    """Names the stages use themselves, and a column that can't be hashed."""
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "h i j k l m n"), (4, None)], "doc_id long, text string")
    docs = docs.withColumns({n: F.col("doc_id") for n in ("_row", "_sha", "_kept_id", "_kept_sha", "_n", "_each", "row", "n", "v")} | {"tags": F.create_map(F.lit("k"), F.col("doc_id"))})
    docs = cut(docs)
    for stage, kept in ((corpus_pipeline.drop_toxic, [1, 2, 3, 4]), (corpus_pipeline.drop_copies, [2, 3, 4]), (corpus_pipeline.drop_near_copies, [1, 3, 4]), (corpus_pipeline.drop_contaminated, [1, 2, 3, 4])):
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert sorted((r.doc_id, r._row, r._n, r.tags["k"]) for r in out.collect()) == [(i, i, i, i) for i in kept]


def with_columns(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.lit(1).cast("long")})


def left_of(stage, docs, folder=SMALL):
    return sorted(((-1 if r.doc_id is None else r.doc_id), r.text or "") for r in stage(docs.sparkSession, docs, folder).collect())


def test_stages_decide_by_row(spark, tmp_path):
    """Null and shared ids: each row goes or stays for its own text."""
    toxic, clean = "you are a moron here", "what a lovely day"
    known = [(i, (toxic, clean, "moron. really", "nice words only")[i % 4]) for i in range(160)]
    spark.createDataFrame([(i, 1 - i % 2) for i, _ in known], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = cut(with_columns(spark, known + [(None, clean), (None, toxic), (999, clean), (999, toxic)]))
    assert [x for x in left_of(corpus_pipeline.drop_toxic, docs, str(tmp_path)) if x[0] in (-1, 999)] == [(-1, clean), (999, clean)]

    (passage,) = spark.read.parquet(f"{SMALL}/benchmark.parquet").where("item_id IS NOT NULL").orderBy(-F.length("text")).select("text").first()
    rows = [(None, "no such words"), (None, passage), (5, "nor such ones"), (5, passage), (6, None)]
    assert left_of(corpus_pipeline.drop_contaminated, cut(with_columns(spark, rows))) == [(-1, "no such words"), (5, "nor such ones"), (6, "")]

    base = [" ".join(f"w{i}_{j}" for j in range(40)) for i in range(5)]
    rows = [(None, base[0]), (None, base[0] + " x"), (7, base[1]), (7, base[1] + " y"), (8, base[2]), (8, base[2]), (None, base[3]), (3, base[3] + " z"), (8, base[4]), (None, "alone here")]
    left = left_of(corpus_pipeline.drop_near_copies, cut(with_columns(spark, rows + [(9, ""), (9, ""), (None, None), (None, None)])))
    of = lambda text: [x for x in left if text and x[1].startswith(text)]
    assert [len(of(b)) for b in base] == [1] * 5 and of(base[3]) == [(3, base[3] + " z")] and of("alone") == [(-1, "alone here")]
    assert [x for x in left if not x[1]] == [(-1, ""), (-1, ""), (9, ""), (9, "")] and len(left) == 10
    again = left_of(corpus_pipeline.drop_near_copies, cut(with_columns(spark, rows[::-1]).repartition(3)))
    assert again == [x for x in left if x[1]]
