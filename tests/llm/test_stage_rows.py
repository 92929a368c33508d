"""The pipeline's stages on awkward rows with labels: decisions are by row."""
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.conftest import SF001
from tests.llm.cases import frame
from tests.llm.test_edges import bench

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def labelled(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet").select(COLUMNS)


def test_rejected_row_takes_no_other_row_of_its_id(spark):
    docs = labelled(spark)
    good = docs.where("length(text) > 200").orderBy("doc_id").limit(3)
    twice = good.select("doc_id", F.lit("12 34 !!").alias("text"), "lang", "source", "n_chars")
    nulls = spark.createDataFrame([(None, "123", None, None, None), (10**9, None, None, None, None), (10**9 + 1, "", None, None, None)],
                                  docs.schema)
    got = cp.language_id(spark, docs.unionAll(twice).unionAll(nulls), SF001)
    want = docs.where(F.col("text").rlike(r"\p{L}"))
    assert got.columns == COLUMNS
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_names_of_its_own_pass_through(spark):
    docs = labelled(spark).withColumns({"lang_pred": F.lit("mine"), "score": F.lit(7), "row": F.lit(1), "letters": F.lit(False)})
    got = cp.language_id(spark, docs, SF001)
    assert got.columns == docs.columns
    assert got.where("lang_pred = 'mine' and score = 7 and row = 1 and not letters").count() == got.count() > 0


def test_all_stages_on_awkward_rows_with_labels(spark, tmp_path):
    bench(spark, 5).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = labelled(spark).unionAll(frame(spark).select(COLUMNS))
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == COLUMNS, name
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        left = spark.read.parquet(path)
        assert 0 < left.count() <= docs.count(), name
        if name == "language_id":
            assert {r[0] for r in left.where("doc_id is null").select("text").collect()} - {None}
            assert left.where("doc_id in (1, 2, 3, 16) and not text rlike '[a-z]'").count() == 0
        docs = left
    packed = cp.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
