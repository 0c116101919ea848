"""The corpus pipeline, stage by stage, against what the stages' decisions must be."""

import pandas as pd
import pytest
from test_links import print_by_hand, roots_by_hand

import corpus_pipeline
from brassledger.llm import decontaminate, packing
from brassledger.session import staged

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found.append(staged(stage(spark, found[-1], SF), name))
    return found


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay(stages):
    assert all(df.dtypes == stages[0].dtypes for df in stages)


def test_bad_quality_goes_and_good_stays(stages):
    kept, labels = set(ids(stages[1])), pd.read_parquet(f"{SF}/labels.parquet")
    good, bad = (set(labels["doc_id"][labels["quality"] == q]) for q in (1, 0))
    assert len(good & kept) >= 0.98 * len(good) and len(bad & kept) <= 0.1 * len(bad)


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, print_by_hand(r.text)) for r in stages[1].collect()]
    edges = [(a, b) for i, (a, x) in enumerate(rows) for b, y in rows[:i] if (x ^ y).bit_count() <= 4]
    assert ids(stages[2]) == sorted(set(roots_by_hand([a for a, _ in rows], edges).values()))


def test_passages_of_the_benchmark_go(spark, stages):
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {
        r.doc_id
        for r in stages[2].collect()
        for words in [b" " + b" ".join(decontaminate.words_of(r.text)) + b" "]
        if any(b" " + b" ".join(i) + b" " in words for i in items)
    }
    assert exact and set(ids(stages[3])) == set(ids(stages[2])) - exact  # the data hold no edited ones


def test_all_that_is_left_is_packed(spark, stages):
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert sorted(packed["doc_id"].unique()) == ids(stages[3])
    used = packed.groupby("sequence_id")["length"].sum()
    assert used.max() <= 2048 and len(used) <= -(-used.sum() // 2048) * 1.02 + 1


def test_odd_documents_pass(spark, tmp_path):
    rows = [(1, None, "x"), (2, "", "y"), (None, "some text here", None), (3, "w " * 5000, "z"), (3, "w " * 5000, "z")]
    docs = spark.createDataFrame([(i, t, "en", s, 0, "extra") for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, length string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert sorted(packed["doc_id"].dropna().unique()) == [1, 3] and packed["doc_id"].isna().sum() == 1
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert packing.cut(0, 4) == []
