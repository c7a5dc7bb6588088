import corpus_pipeline
import pytest

import __spark_entry__
from strataflow.llm.queries import ORACLE_SQL, QUERIES

from .conftest import DDL, ROWS, prose


def test_registered():
    names = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names) and {f"op{n}_" for n in range(1, 14)} == {k[: k.index("_") + 1] for k in QUERIES}
    assert set(ORACLE_SQL) <= set(QUERIES) and "op2_quality_rules" in __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    good = [(i, prose(i, 80), "en", "s", 0) for i in range(60)]
    bad = [(i, " ".join(w.upper() + "!!" for w in prose(i, 80).split()), "en", "s", 0) for i in range(60, 90)]
    copies = [(100 + i, prose(3, 80), "en", "s", 0) for i in range(3)]
    odd = [(*r, 0) for r in ROWS if r[0] not in (8, 9)]
    spark.createDataFrame(good + bad + copies + odd, DDL).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(i, int(i < 60), 0) for i in range(90)], "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        seen[name] = [r["doc_id"] for r in docs.collect()]
    quality, language, first, rest = (seen[n] for n, _ in corpus_pipeline.STAGES[:-1])
    assert set(range(12, 60)) <= set(quality) and not set(range(60, 90)) & set(quality)
    assert set(range(12, 60)) <= set(language)
    assert not {100, 101, 102} & set(first) and set(range(12, 60)) <= set(first) and first.count(2) == 1
    assert set(range(12, 60)) <= set(rest)


def test_run_packs_what_is_left(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} >= set(range(12, 60)) and max(r["offset"] + r["length"] for r in rows) <= 2048


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DDL).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
