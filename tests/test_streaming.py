import json

import pytest
from pyspark.sql import functions as F

from strataflow.streaming import upserts
from strataflow.streaming.upserts import SnapshotTable, upsert_stream

DDL = "k string, v long, first long"


@pytest.mark.parametrize("most", [2, 16])
def test_stream_of_upserts_equals_a_replay(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(upserts, "MOST_PARTS", most)
    batches = [[("a", 1, 1), ("b", 1, 1)], [("a", 2, 2), ("c", 2, 2), ("a", 1, 9)], [("d", 3, 3)], [("b", 4, 4), ("b", 5, 5)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, DDL).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
    table = SnapshotTable(spark, str(tmp_path / "table"), DDL, ["k"])
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    query = upsert_stream(stream, table, [F.desc("v")], keep=["first"]).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", 2, 1), ("b", 5, 1), ("c", 2, 2), ("d", 3, 3)]
    assert sorted(r["k"] for r in table.read(0).collect()) == ["a", "b"] and table.read(1).count() == 3  # versions stay
    parts = [len(json.loads(p.read_text())) for p in sorted((tmp_path / "table" / "_log").iterdir())]
    assert parts == ([1, 2, 1, 2] if most == 2 else [1, 2, 3, 4])


def test_a_batch_writes_what_it_changes_and_once(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), DDL, ["k"])
    assert table.read().count() == 0
    table.put(spark.createDataFrame([(f"k{i}", 1, 1) for i in range(500)], DDL), 0, [F.desc("v")], ["first"])
    change = spark.createDataFrame([("k7", 2, 2), ("new", 2, 2)], DDL)
    for _ in range(2):  # replayed
        table.put(change, 1, [F.desc("v")], ["first"])
    sizes = {p.name.split("-")[0]: spark.read.parquet(str(p)).count() for p in tmp_path.glob("v=*")}
    assert sizes == {"v=0": 500, "v=1": 2} and table.versions() == [0, 1]
    assert {tuple(r) for r in table.read().filter("v = 2").collect()} == {("k7", 2, 1), ("new", 2, 2)} and table.read().count() == 501
