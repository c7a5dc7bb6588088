import json
from argparse import Namespace

import pytest

from strataflow import cli
from strataflow.plans import packets
from strataflow.plans.store import Store
from strataflow.schemas import TABLES

QUOTAS = {"candidate_priority": 6, "non_priority_original_or_unclear": 4, "obvious_non_original": 2}
GOOD = {"disease": "cancer", "study": "review", "primary_contribution": "other", "data_modalities": ["scRNA"], "computational_centrality": 2, "new_experimental_data": "none", "public_data_reuse": "minor", "relevance": "NO", "confidence": 0.5, "rationale": "why"}
WHEN = "2026-09-01T00:00:00Z"


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("packets")
    store = Store(spark, folder / "db")
    names = [f.split(" ")[0] for f in __import__("strataflow.sources.xml_records", fromlist=["_fields"])._fields(TABLES["articles"])]
    kinds = ["Journal Article"] * 10 + ["Review"] * 3
    store.append("articles", [dict.fromkeys(names) | {"pmid": str(70 + i), "title": f"Cancer single-cell {i}" if i < 6 else "Other", "abstract": "", "article_types": [k], "mesh_terms": []} for i, k in enumerate(kinds)])
    rules = folder / "rules.json"
    rules.write_text(json.dumps({"version": "v1", "cancer": [r"\bcancer\b"], "omics": [r"\bsingle[- ]cell\b"]}))
    assert cli.run(Namespace(command="screen", db=folder / "db", rules=rules), spark)["candidate_priority"] == 6
    packets.create_sample(store, "c1", "seed", "v1", QUOTAS)
    found = packets.prepare_packets(store, "c1", folder / "out", "Ask:\n{input}", "rev", 6, QUOTAS)
    return store, folder, found


def test_packets_are_reproducible_and_reject_drift(made):
    store, folder, found = made
    assert [m["record_count"] for m in found] == [6, 6]
    again = packets.prepare_packets(store, "c1", folder / "out", "Ask:\n{input}", "rev", 6, QUOTAS)
    assert again == found and store.read("manual_web_attempts").count() == 2 and store.read("manual_web_attempt_items").count() == 12
    with pytest.raises(packets.InvalidPacket, match="web_prompt"):
        packets.prepare_packets(store, "c1", folder / "out", "Other:\n{input}", "rev", 6, QUOTAS)
    for bad in ({"size": 51}, {"revision": "unknown"}, {"quotas": {"candidate_priority": 7}}):
        with pytest.raises(packets.InvalidPacket):
            packets.prepare_packets(**{"store": store, "sample_id": "c1", "root": folder / "out", "prompt": "Ask:\n{input}", "revision": "rev", "size": 6, "quotas": QUOTAS} | bad)
    visible = json.loads((folder / "out" / found[0]["batch_id"] / "input.jsonl").read_text().splitlines()[0])
    assert set(visible) == set(packets.VISIBLE_FIELDS)


def lines(ids, **change):
    return "\n".join(json.dumps(GOOD | {"pmid": p} | change) for p in ids) + "\n"


@pytest.mark.parametrize("spoil", ["missing", "extra", "twice", "foreign", "reversed", "confidence", "field", "fence", "prose"])
def test_invalid_answers(spoil):
    ids = [str(i) for i in range(70, 76)]
    text = {
        "missing": lines(ids[:-1]), "extra": lines([*ids, "99"]), "twice": lines([*ids[:-1], ids[0]]), "foreign": lines([*ids[:-1], "99"]), "reversed": lines(ids[::-1]),
        "confidence": lines(ids, confidence=2), "field": lines(ids, model="m"), "fence": "```\n" + lines(ids) + "```", "prose": "Here: " + lines(ids),
    }[spoil]
    assert packets.check_answer(text, ids, "m", "v1", WHEN)[1]


def test_answers_attempts_and_import(spark, made):
    store, folder, found = made
    m = found[0]
    at = folder / "out" / m["batch_id"] / "manifest.json"
    bad, good = folder / "a1.txt", folder / "a2.txt"
    bad.write_text("nothing")
    good.write_text(lines(m["ordered_pmids"]))
    give = lambda path, attempt, **more: packets.validate_answer(store, at, path, **{"model": "m", "operator": "o", "fresh_chat": True, "executed_at": WHEN} | more, attempt=attempt)
    for more in ({"model": " "}, {"operator": ""}, {"fresh_chat": False}, {"executed_at": "2026"}):
        with pytest.raises(packets.InvalidPacket):
            give(good, 1, **more)
    with pytest.raises(packets.InvalidPacket, match="lines expected"):
        give(bad, 1)
    with pytest.raises(packets.InvalidPacket, match="follow"):
        give(good, 3)
    assert len(give(good, 2)) == 6
    with pytest.raises(packets.InvalidPacket):
        give(good, 3)
    states = {r["attempt"]: r["status"] for r in store.read("manual_web_attempts").filter(f"batch_id = '{m['batch_id']}'").collect()}
    assert states == {1: "failed", 2: "valid"}
    assert store.read("manual_web_attempt_items").filter("attempt = 2 and llm_screen_id is not null").count() == 6
    came, new = packets.import_records(store, [GOOD | {"pmid": m["ordered_pmids"][0], "model": "m", "prompt_version": "v1", "screened_at": WHEN}])
    assert (came, new) == (1, 0)
    with pytest.raises(packets.InvalidPacket, match="unknown"):
        packets.import_records(store, [GOOD | {"pmid": "1", "model": "m", "prompt_version": "v1", "screened_at": WHEN}])
    assert packets.sample_audit(store, 0.1, "s", "a1") == (6, 1)
    assert cli.status(store)["llm_screened"] == 6
    other = folder / "out" / found[1]["batch_id"]
    (other / "input.jsonl").write_text("x")
    with pytest.raises(packets.InvalidPacket, match="changed"):
        packets.validate_answer(store, other / "manifest.json", good, "m", "o", True, WHEN)


def test_exports(spark, made, tmp_path):
    store, *_ = made
    assert packets.export_queue(store, tmp_path / "q.jsonl") == 13 and packets.export_sample(store, "c1", tmp_path / "s.jsonl") == 12
    first = json.loads((tmp_path / "q.jsonl").read_text().splitlines()[0])
    assert first["candidate_priority"] is True and first["doi"] is None


def test_command_line_has_all_commands():
    commands = next(a for a in cli.parser()._actions if a.dest == "command").choices
    assert len(commands) == 14
