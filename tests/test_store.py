"""Commits of several writers, writers that die, and stores of older layouts."""

import json
import multiprocessing

import pytest
from pyspark.sql import functions as F

from strataflow.plans import packets, store as module
from strataflow.plans.store import BrokenStore, ConcurrentChange, Store
from strataflow.sinks.shared_folder import SharedFolder


def test_writers_of_different_tables_both_commit(spark, tmp_path):
    one, two = Store(spark, tmp_path / "db"), Store(spark, tmp_path / "db")
    with one.transaction():
        one.append("enumeration_batches", [("r", 0, 1, None, None, None)])
        with two.transaction():
            two.append("human_reviews", [(1, "1", "INCLUDE", True, None, None, None)])
        two.append("audit_samples", [("s", "1", "NO", 0.1, "x", "y", None)])
    third = Store(spark, tmp_path / "db")
    assert [third.read(t).count() for t in ("enumeration_batches", "human_reviews", "audit_samples")] == [1, 1, 1]
    log = [json.loads(p.read_bytes())["changed"] for p in sorted((tmp_path / "db" / "_log").iterdir())]
    assert log == [["schema_meta"], ["human_reviews"], ["audit_samples"], ["enumeration_batches"]]


def test_a_writer_that_dies_blocks_nobody(spark, tmp_path, monkeypatch):
    one = Store(spark, tmp_path / "db")
    for step in ("_add", "_put"):
        whole = getattr(Store, step)

        def dies(self, *a, whole=whole, step=step, **k):
            if step == "_add":
                whole(self, *a, **k)
            raise KeyboardInterrupt

        monkeypatch.setattr(Store, step, dies)
        with pytest.raises(KeyboardInterrupt):
            one.append("human_reviews", [(1, "1", "INCLUDE", True, None, None, None)])
        monkeypatch.undo()
    (tmp_path / "db" / "_log" / "00000000000000000002.json.abc.partial").write_bytes(b"{")  # left behind
    assert Store(spark, tmp_path / "db").read("human_reviews").count() == 0
    one.append("human_reviews", [(2, "1", "INCLUDE", True, None, None, None)])
    assert [r["id"] for r in Store(spark, tmp_path / "db").read("human_reviews").collect()] == [2]


def link(folder, name, value, out):
    class Session:  # what the folder takes from a session, which a forked process does not have
        _jvm = None

        class _jsc:
            hadoopConfiguration = staticmethod(lambda: None)

    out.put((value, SharedFolder(Session, folder).put_new(name, value.encode() * 1000)))


def test_one_of_many_processes_is_first(tmp_path):
    out = multiprocessing.get_context("spawn").Queue()
    many = [multiprocessing.get_context("spawn").Process(target=link, args=(tmp_path, "_log/1.json", f"{n:02d}", out)) for n in range(6)]
    for p in many:
        p.start()
    got = [out.get(timeout=60) for _ in many]
    for p in many:
        p.join()
    winner = [v for v, won in got if won]
    assert len(winner) == 1 and (tmp_path / "_log" / "1.json").read_text() == winner[0] * 1000 and len(list((tmp_path / "_log").iterdir())) == 1


def test_a_rename_does_not_overwrite(spark, tmp_path):
    folder = SharedFolder(spark, tmp_path)
    assert folder.put_new("a/1", b"x") and not folder.put_new("a/1", b"y") and folder.read("a/1") == b"x" and folder.names("none") == []
    assert folder._put_by_rename("a/2", "a/2.partial", b"z") and not folder._put_by_rename("a/2", "a/2.partial", b"y")
    assert folder.read("a/2") == b"z" and [n for n in folder.names("a") if not n.startswith(".")] == ["1", "2"]


ATTEMPT = "batch_id string, attempt int, calibration_id string, provider_route string, execution_mode string, model_display_name string, operator string, prompt_version string, record_count int, status string, created_at string, completed_at string"


def older(spark, folder, items=(("b", 1, "p1", 1, None),), status="prepared"):
    """A store as version 5 left it: a pointer file, attempts without the wrapper's columns, under other names and types."""
    parts = {
        "schema_meta": spark.createDataFrame([("schema_version", "5")], "key string, value string"),
        "calibration_samples": spark.createDataFrame([("c", "s", "v1", "now")], module.TABLES["calibration_samples"]),
        "articles": spark.createDataFrame([("p1",)], "pmid string"),
        "manual_web_attempts": spark.createDataFrame([("b", 1, "c", "web", "manual", "M", "human", "v1", 20, status, "now", "later")], ATTEMPT),
        "manual_web_attempt_items": spark.createDataFrame(list(items), module.TABLES["manual_web_attempt_items"]),
    }
    for table, df in parts.items():
        df.write.parquet(str(folder / table / "v=1-old"))
    (folder / "CURRENT").write_text("\n".join(f"{t}=1-old" for t in parts) + "\n")


def test_an_older_store_is_migrated_when_it_is_opened(spark, tmp_path):
    older(spark, tmp_path)
    store = Store(spark, tmp_path)
    row = store.read("manual_web_attempts").first()
    assert (row["route"], row["model_label"], row["validated_at"], row["record_count"], row["status"]) == ("web", "M", "later", 20, "prepared")
    assert row["wrapper_version"] is None and row["wrapper_sha256"] is None and row["max_tokens"] is None
    assert store.read("manual_web_attempt_items").count() == 1 and store.read("articles").first()["pmid"] == "p1"
    assert {r["value"] for r in store.read("schema_meta").collect()} == {module.SCHEMA_VERSION}
    number = store._number()
    assert Store(spark, tmp_path)._number() == number == 2  # once
    store.upsert("manual_web_attempts", [row.asDict() | {"status": "valid"}])
    assert [r["status"] for r in store.read("manual_web_attempts").collect()] == ["valid"]


@pytest.mark.parametrize("fault", [{"items": [("b", 1, "unknown", 1, None)]}, {"items": [("b", 2, "p1", 1, None)]}, {"status": "lost"}])
def test_a_broken_older_store_is_left_as_it_was(spark, tmp_path, fault):
    older(spark, tmp_path, **fault)
    if "items" in fault:  # an item's table is checked when its own layout changed
        spark.createDataFrame(fault["items"], module.TABLES["manual_web_attempt_items"]).drop("llm_screen_id").write.mode("overwrite").parquet(str(tmp_path / "manual_web_attempt_items" / "v=1-old"))
    for _ in range(2):
        with pytest.raises(BrokenStore, match="manual_web_attempt"):
            Store(spark, tmp_path)
    assert [json.loads(p.read_bytes())["tables"]["manual_web_attempts"] for p in (tmp_path / "_log").iterdir()] == ["1-old"]


def test_a_later_store_is_refused(spark, tmp_path):
    Store(spark, tmp_path).upsert("schema_meta", [("schema_version", "99")])
    with pytest.raises(BrokenStore, match="99"):
        Store(spark, tmp_path)


def test_the_same_table_is_refused(spark, tmp_path):
    one, two = Store(spark, tmp_path), Store(spark, tmp_path)
    with pytest.raises(ConcurrentChange, match="audit_samples"), one.transaction():
        one.append("human_reviews", [(1, "1", "INCLUDE", True, None, None, None)])
        one.append("audit_samples", [("s", "1", "NO", 0.1, "x", "y", None)])
        two.append("audit_samples", [("s", "2", "NO", 0.1, "x", "y", None)])
    assert two.read("human_reviews").count() == 0 and two.read("audit_samples").select("pmid").first()[0] == "2"


def test_answers_of_all_packets_against_the_ledger(spark, tmp_path):
    store = Store(spark, tmp_path / "db")
    paths = [tmp_path / f"{n} ü.jsonl" for n in range(5)]
    for p in paths[:4]:
        p.write_text(p.name)
    shas = [packets._sha(p.name.encode()) for p in paths]
    columns = store.frame("manual_web_attempts", []).columns
    row = lambda b, n, path, sha, status="failed": tuple({"batch_id": b, "attempt": n, "output_path": str(path), "output_sha256": sha, "status": status}.get(c) for c in columns)
    store.append("manual_web_attempts", [row("a", 1, paths[0], shas[0]), row("a", 2, paths[1], "0" * 64), row("b", 1, paths[2], shas[2]), row("c", 1, paths[2], shas[2]), row("d", 1, paths[4], shas[4]), row("e", 1, None, None, "prepared"), row("f", 1, paths[3], shas[3])])
    got = {(r["batch_id"], r["attempt"]): r["problem"] for r in packets.check_answers(store).collect()}
    assert got == {("a", 2): "changed", ("b", 1): "given twice", ("c", 1): "given twice", ("d", 1): "missing"}
    assert packets.check_answers(store, "b").agg(F.count("*")).first()[0] == 0  # in its own packet it is given once
