"""What the other tests take for granted: rule files, revisions, printed JSON, windows, the gate."""

import json
import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strataflow import cli
from strataflow.operators import scratch, stats, upsert
from strataflow.plans import backfill
from strataflow.sinks import files
from strataflow.sources import config


def test_rule_files(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"version": "v2", "cancer": ["a+"], "omics": [r"\\bb\\b"]}))
    rules = config.load_rules(path)
    assert rules.version == "v2" and path.exists()
    path.write_text(json.dumps({"version": "v2", "cancer": ["("], "omics": []}))
    with pytest.raises(re.error):
        config.load_rules(path)


def test_software_revision(tmp_path):
    assert config.software_revision(tmp_path) == "unknown"
    assert re.fullmatch("[0-9a-f]{40}|unknown", config.software_revision(files.CODE))


def test_json_is_compact_and_sorted_or_spaced():
    assert files.json_text({"b": [1, None], "a": "ü"}) == '{"a":"ü","b":[1,null]}'
    assert files.json_line({"b": [1, None], "a": "ü"}) == '{"a": "ü", "b": [1, null]}'


def test_the_command_line_prints_json(spark, tmp_path, capsys):
    assert cli.main(["init-db", "--db", str(tmp_path / "db")]) == 0
    out = capsys.readouterr().out
    assert json.loads(out) == {"schema_version": "6"} and out.startswith('{\n  "')


def test_a_window_that_ends_before_it_starts_is_refused(spark, tmp_path):
    for call in (backfill.run_backfill, backfill.enumerate_journal):
        with pytest.raises(ValueError, match="ends before"):
            call(None, None, None, *([None] if call is backfill.enumerate_journal else []), date(2024, 1, 2), date(2024, 1, 1), tmp_path, "rev")


def test_the_gate_takes_all_three(spark):
    rows = [(1.0, 0.95, 0.9, True), (0.99, 1.0, 1.0, False), (1.0, 0.949, 1.0, False), (1.0, 1.0, 0.899, False), (1.0, 1.0, None, True)]
    got = spark.createDataFrame(rows, "c double, r double, w double, want boolean").select("want", stats.gate(F.col("c"), F.col("r"), F.col("w")).alias("got")).collect()
    assert all(r["want"] == r["got"] for r in got)


def test_back_references_follow_the_natural_key(spark):
    items = spark.createDataFrame([("a", "m", None), ("b", "m", None), ("c", "m", 7)], "k string, model string, llm_screen_id long")
    screens = spark.createDataFrame([("a", "m", 1), ("b", "other", 2), ("c", "m", 3)], "k string, model string, id long")
    got = upsert.back_reference(items, screens, ["k", "model"])
    assert sorted((r["k"], r["llm_screen_id"]) for r in got.collect()) == [("a", 1), ("b", None), ("c", 3)]


def test_settling_gives_freed_native_memory_back(spark):
    jvm, status = spark.sparkContext._jvm, Path(f"/proc/{spark.sparkContext._gateway.proc.pid}/status")

    def mb():
        return int(re.search(r"RssAnon:\s+(\d+)", status.read_text())[1]) / 1024

    many = [jvm.java.util.zip.Deflater() for _ in range(600)]  # native memory outside the heap
    for x in [x for i, x in enumerate(many) if i % 16 < 15]:  # one of 16 stays, so that no end of an arena is free
        x.end()
    for _ in range(3):
        jvm.System.gc()
    before = mb()
    scratch.settle(spark)
    after = mb()
    for x in many[15::16]:
        x.end()
    assert after < before - 30
