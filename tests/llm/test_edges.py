"""Every operator and stage on awkward rows and on an empty table."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.cases import empty, frame
from wardstat.llm import (decontaminate, language_id, license_scan, line_dedup, near_dedup, packing, passage_dedup,
                          quality_rules, suffix_dedup, toxicity)


def bench(spark, n=3):
    rows = [(1, "this same boilerplate line stands in many of the documents here."), (2, None), (None, "x"), (3, "  "), (1, "one")]
    return spark.createDataFrame(rows[:n], "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(6, 1, 0), (8, 1, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")


OPS = {
    "op1": lambda s, d: passage_dedup.near_passages(s, d),
    "op2": lambda s, d: toxicity.toxicity(s, d, labels(s)),
    "op3": lambda s, d: quality_rules.quality(s, d),
    "op4": lambda s, d: near_dedup.near_duplicates(s, d),
    "op5": lambda s, d: language_id.identify(s, d),
    "op6": lambda s, d: license_scan.scan(s, d),
    "op7": lambda s, d: suffix_dedup.dedup_substrings(s, d),
    "op8": lambda s, d: packing.pack(s, d),
    "op9": lambda s, d: decontaminate.find_leaks(s, d, bench(s, 5)),
    "op10": lambda s, d: line_dedup.dedup_lines(s, d),
}
PER_ROW = ("op2", "op3", "op4", "op5", "op7", "op10")


@pytest.mark.parametrize("name", OPS)
def test_awkward_rows(spark, name):
    got = OPS[name](spark, frame(spark)).collect()
    if name in PER_ROW:
        assert len(got) == 19
    if name == "op1":  # 6, 7 and 8 share 120 words
        assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] < 9} == {6: 6, 7: 6, 8: 6}
    if name == "op4":
        comp = {r["doc_id"]: (r["component_id"], r["kept"]) for r in got}
        assert comp[7] == (6, False) and comp[8] == (6, False) and comp[6] == (6, True) and comp[None] == (None, True)
        assert comp[1] == (1, True) and comp[3] == (3, True)
    if name == "op5":
        assert {r["lang_pred"] for r in got} == {"und"}
    if name == "op8":
        assert sum(r["n_tokens"] for r in got if r["doc_id"] == 14) == 30001
        assert len({(r["bin_id"], r["bin_offset"]) for r in got}) == len(got)
    if name == "op9":
        assert {r["doc_id"] for r in got} == {4, 5, 9, 10, 11, 12, 13}
    if name == "op10":
        n = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in got if r["doc_id"]}
        assert n[1] == (1, 0) and n[3] == (2, 0) and n[11] == (3, 2) and n[12] == (2, 1) and n[13] == (2, 0)


@pytest.mark.parametrize("name", OPS)
def test_empty_table(spark, name):
    assert OPS[name](spark, empty(spark)).count() == 0


@pytest.mark.parametrize("make", (frame, empty))
def test_stages(spark, tmp_path, make):
    bench(spark, 5).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        if name != "language_id":  # without labels no language is known
            out.collect()
    packed = cp.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert packed.where(F.col("bin_offset") + F.col("n_tokens") > F.col("bin_size")).count() == 0
