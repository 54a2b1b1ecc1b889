import pytest
from conftest import DATA

import corpus_pipeline
from siftspark.llm.packing import LENGTH


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], DATA).cache())
    return out


def test_stages_keep_columns_and_only_remove(stages):
    for before, after in zip(stages[:-2], stages[1:-1], strict=True):
        assert after.columns == before.columns and 0 < after.count() <= before.count()
        assert after.select("doc_id").exceptAll(before.select("doc_id")).count() == 0


def test_last_stage_packs_all_that_is_left(stages):
    left, packed = stages[-2], stages[-1]
    assert packed.select("doc_id").distinct().count() == left.count()
    assert packed.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= LENGTH


def test_run_gives_the_stages_result(spark, stages):
    assert corpus_pipeline.run(spark, DATA).count() == stages[-1].count()


def test_stages_judge_rows_of_odd_keys_each(spark):
    rng = __import__("random").Random(3)
    one, two = (" ".join(f"w{rng.randrange(3000)}" for _ in range(n)) for n in (200, 120))
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").where("length(text) > 80").first()["text"]
    rows = [(1, one, 1), (2, one, 2), (2, one, 3), (None, one, 4), (2, two, 5), (3, None, 6), (4, "", 7), (None, None, 8), (5, two + " " + one, 9), (6, f"{two[:50]} {item}", 10), (None, item, 11)]
    docs = spark.createDataFrame([(i, t, n, n, "x") for i, t, n in rows], "doc_id long, text string, _row0 int, id int, component_id string")
    apart = corpus_pipeline.one_of_each_group(spark, docs, DATA)
    assert apart.columns == docs.columns and sorted(r["_row0"] for r in apart.collect()) == [1, 5, 6, 7, 8, 9, 10, 11]
    cut = {r["_row0"]: r["text"] for r in corpus_pipeline.without_repeats(spark, apart, DATA).collect()}
    assert cut[1] == one and two not in (cut.get(5), cut.get(9)) or cut[5] == two and 9 not in cut
    assert cut[6] is None and cut[7] == "" and cut[8] is None
    clean = corpus_pipeline.without_benchmark(spark, docs, DATA)
    assert clean.columns == docs.columns and sorted(r["_row0"] for r in clean.collect()) == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0, name
