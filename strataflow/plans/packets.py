"""Packets for an external classifier, and the strict way back (SNK-02, SNK-03, SNK-05, SNK-06, VAL-04..09, VAL-12)."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, functions as F

from strataflow.functions.record_rules import iso_time
from strataflow.functions.vocabularies import QUOTAS, VISIBLE_FIELDS
from strataflow.operators import batches, latest, sample, upsert, validate
from strataflow.operators.scratch import discard, stored
from strataflow.operators.screen import stratum
from strataflow.plans.backfill import now, precise_now
from strataflow.plans.store import Store
from strataflow.schemas import KEYS, SEMANTIC, TABLES
from strataflow.sinks.files import export_lines, file_digests, json_line, outside_code, publish
from strataflow.sources.jsonl import decode, read_records, record_error

SCHEMA_VERSION = "web_semantic_screen_v1"
IMMUTABLE = ("calibration_id", "batch_id", "ordered_pmids", "record_count", "prompt_version", "schema_version", "sampling_strata", "input_sha256", "web_prompt_sha256", "software_revision")
_FIELDS = [f.split(" ")[0] for f in SEMANTIC.split(", ")]


class InvalidPacket(ValueError):
    """A packet, its manifest or its answer does not fit."""


def latest_screens(store: Store) -> DataFrame:
    return latest.latest_by(store.read("deterministic_screens"), ["pmid"], [F.desc("screened_at"), F.desc("rules_version")])


def with_priority(store: Store) -> DataFrame:
    return latest.with_latest(store.read("articles"), store.read("deterministic_screens"), ["pmid"], [F.desc("screened_at"), F.desc("rules_version")], {"candidate_priority": False})


def export_queue(store: Store, path: str | Path) -> int:
    """All records with their latest priority, most urgent first."""
    rows = with_priority(store).select("pmid", "doi", "title", "abstract", "publication_date", "article_types", "mesh_terms", "candidate_priority")
    return export_lines(rows, path, [F.desc("candidate_priority"), F.desc_nulls_last("publication_date"), F.desc("pmid")])


def create_sample(store: Store, sample_id: str, seed: str, prompt_version: str, quotas: dict[str, int] | None = None, clock: Callable[[], str] = now) -> DataFrame:
    """Draw and store a calibration sample; a short stratum raises before anything is written."""
    frame = with_priority(store).select("pmid", stratum(F.col("candidate_priority"), F.col("article_types")).alias("stratum"))
    chosen = sample.stratified_sample(frame, "pmid", "stratum", quotas or QUOTAS, seed, check=True)
    with store.transaction():
        store.append("calibration_samples", [(sample_id, seed, prompt_version, clock())])
        store.append("calibration_sample_items", chosen.select(F.lit(sample_id).alias("calibration_id"), "pmid", "stratum", "population_size", "hash_rank", F.lit(clock()).alias("selected_at")))
    return store.read("calibration_sample_items").filter(F.col("calibration_id") == sample_id)


def _items(store: Store, sample_id: str) -> DataFrame:
    return store.read("calibration_sample_items").filter(F.col("calibration_id") == sample_id)


def export_sample(store: Store, sample_id: str, path: str | Path) -> int:
    rows = store.read("articles").join(F.broadcast(_items(store, sample_id)), "pmid")
    return export_lines(rows.select(*VISIBLE_FIELDS, "stratum", "population_size", "hash_rank"), path, ["stratum", "hash_rank"])


def sample_audit(store: Store, fraction: float, seed: str, sample_id: str, clock: Callable[[], str] = now) -> tuple[int, int]:
    """Store a share of the latest NO decisions by hash rank; returns population and sample size."""
    last = latest.latest_by(store.read("llm_screens"), ["pmid"], [F.desc("imported_at"), F.desc("id")]).filter("relevance = 'NO'")
    chosen = sample.fraction_sample(last, "pmid", fraction, seed)
    store.append("audit_samples", chosen.select(F.lit(sample_id).alias("sample_id"), "pmid", F.lit("NO").alias("source_relevance"), F.lit(fraction).alias("fraction"), F.lit(seed).alias("seed"), "hash_rank", F.lit(clock()).alias("sampled_at")))
    return last.count(), store.read("audit_samples").filter(F.col("sample_id") == sample_id).count()


def _sha(content: str | bytes) -> str:
    return hashlib.sha256(content.encode() if isinstance(content, str) else content).hexdigest()


def packet_prompt(prompt: str, schema: str | None, text: str, replaced: dict[str, str] | None = None) -> str:
    """What an external classifier is asked (FN-25): the reviewed prompt, the schema of an answer and the input lines.

    ``replaced`` are literal texts of the prompt and what stands in their place, such as those that ask for
    provenance. A prompt with ``{input}`` has the lines there; else they follow the schema.
    """
    for old, new in (replaced or {}).items():
        if old not in prompt:
            raise InvalidPacket(f"the prompt lacks a text to be replaced: {old[:40]!r}")
        prompt = prompt.replace(old, new)
    if "{input}" in prompt:
        return prompt.replace("{input}", text)
    return "\n\n".join([prompt, *([f"JSON SCHEMA OF A LINE\n{schema}"] if schema else []), f"INPUT JSONL\n{text}"])


def prepare_packets(store: Store, sample_id: str, root: str | Path, prompt: str, revision: str, size: int = 20, quotas: dict[str, int] | None = None, schema: str | None = None, replaced: dict[str, str] | None = None, clock: Callable[[], str] = precise_now) -> list[dict]:
    """Write a folder per batch and register a first attempt; a packet that exists must be the same.

    The sample has to have the locked shape. Its size bounds what the driver handles.
    """
    if not 1 <= size <= 50:
        raise InvalidPacket("a packet holds 1 to 50 records")
    if not revision.strip() or revision == "unknown":
        raise InvalidPacket("an exact software revision is required")
    info = store.read("calibration_samples").filter(F.col("calibration_id") == sample_id).first()
    if info is None:
        raise InvalidPacket("unknown sample")
    items = _items(store, sample_id)
    if batches.sample_shape(items, quotas or QUOTAS).count():
        raise InvalidPacket("the sample does not have the locked shape")
    placed = batches.assign_batches(items, ["stratum", "hash_rank"], size)
    manifests = {r["batch_no"]: r for r in batches.batch_manifests(placed, sample_id, info["prompt_version"]).collect()}
    rows = placed.join(items.select("pmid", "stratum"), "pmid").join(store.read("articles").select(*VISIBLE_FIELDS), "pmid").orderBy("batch_no", "ordinal").collect()
    out, folder = [], outside_code(root)
    for no, m in sorted(manifests.items()):
        mine = [r.asDict() for r in rows if r["batch_no"] == no]
        text = "".join(json_line({k: r[k] for k in VISIBLE_FIELDS}) + "\n" for r in mine)
        ask = packet_prompt(prompt, schema, text, replaced)
        manifest = {
            "calibration_id": sample_id, "batch_id": m["batch_id"], "ordered_pmids": list(m["ordered_keys"]), "record_count": m["record_count"], "prompt_version": info["prompt_version"], "schema_version": SCHEMA_VERSION,
            "sampling_strata": [r["stratum"] for r in mine], "input_sha256": _sha(text), "web_prompt_sha256": _sha(ask), "software_revision": revision, "created_at": clock(), "status": "prepared", "attempt": 1,
        }
        at = folder / m["batch_id"]
        if (at / "manifest.json").exists():
            before = json.loads((at / "manifest.json").read_text())
            changed = [k for k in IMMUTABLE if before.get(k) != manifest[k]]
            changed += [n for n, want in (("input.jsonl", text), ("web_prompt.txt", ask)) if (at / n).read_text() != want]
            if changed:
                raise InvalidPacket(f"{m['batch_id']}: {', '.join(changed)} differ from the packet that exists")
            manifest = before
        else:
            publish(at / "input.jsonl", text)
            publish(at / "web_prompt.txt", ask)
            publish(at / "manifest.json", json.dumps(manifest, indent=2, sort_keys=True) + "\n")
        out.append(manifest)
    attempts = [_attempt(m, 1, "prepared", input_path=str(folder / m["batch_id"] / "input.jsonl"), created_at=m["created_at"]) for m in out]
    with store.transaction():
        store.insert_ignore("manual_web_attempts", store.frame("manual_web_attempts", attempts))
        store.insert_ignore("manual_web_attempt_items", [(m["batch_id"], 1, p, i, None) for m in out for i, p in enumerate(m["ordered_pmids"], 1)])
    return out


def _attempt(manifest: dict, number: int, status: str, **more: object) -> dict:
    names = [f.strip().split(" ")[0] for f in TABLES["manual_web_attempts"].split(",")]
    base = dict.fromkeys(names) | {"batch_id": manifest["batch_id"], "attempt": number, "calibration_id": manifest["calibration_id"], "route": "external web UI", "execution_mode": "manual", "prompt_version": manifest["prompt_version"], "software_revision": manifest["software_revision"], "input_sha256": manifest["input_sha256"], "record_count": manifest["record_count"], "fresh_chat_confirmed": False, "temperature": "unavailable", "max_tokens": "unavailable", "status": status}
    return base | more


def check_answer(text: str, ordered: list[str], model: str, prompt_version: str, executed_at: str) -> tuple[list[dict], str | None]:
    """Records of a raw answer with provenance, or the first error: count, JSON, rules, repeats, order."""
    lines = text.splitlines()
    if len(lines) != len(ordered):
        return [], f"{len(ordered)} lines expected, {len(lines)} found"
    rows = decode(lines, "", provenance=False, skip_blank=False)
    bad = next((r for r in rows if r["error"]), None)
    if bad:
        return [], f"line {bad['line']}: {bad['error']}"
    seen: set[str] = set()
    for want, r in zip(ordered, rows, strict=True):
        if r["pmid"] in seen:
            return [], f"line {r['line']}: duplicate id {r['pmid']}"
        if r["pmid"] != want:
            return [], f"line {r['line']}: id {r['pmid']} where {want} was expected"
        seen.add(r["pmid"])
    records = [{k: r[k] for k in _FIELDS} | {"model": model, "prompt_version": prompt_version, "screened_at": executed_at} for r in rows]
    for n, record in enumerate(records, 1):
        error = record_error(record)
        if error:
            return [], f"line {n}: with provenance: {error}"
    return records, None


def check_packet(store: Store, manifest: dict, quotas: dict[str, int] | None = None) -> None:
    """Compare a manifest with the sample in the store, or raise (VAL-06).

    The sample has the manifest's prompt version and, if ``quotas`` are given, their shape; the manifest's
    1 to 50 ids follow each other in the sample's order without a gap, and their strata are the sample's.
    """
    info = store.read("calibration_samples").filter(F.col("calibration_id") == manifest["calibration_id"]).first()
    if info is None or info["prompt_version"] != manifest["prompt_version"]:
        raise InvalidPacket("the store's sample is unknown or has another prompt version")
    items = _items(store, manifest["calibration_id"])
    if quotas and batches.sample_shape(items, quotas).count():
        raise InvalidPacket("the sample does not have the locked shape")
    ids = manifest["ordered_pmids"]
    if not 1 <= len(ids) <= 50 or len(set(ids)) != len(ids) or len(manifest["sampling_strata"]) != len(ids):
        raise InvalidPacket("a packet holds 1 to 50 records, each once and with its stratum")
    whole = batches.assign_batches(items, ["stratum", "hash_rank"], 1 << 40).join(items.select("pmid", "stratum"), "pmid")
    asked = store.spark.createDataFrame(list(zip(ids, manifest["sampling_strata"], range(1, len(ids) + 1), strict=True)), "pmid string, said string, nth long")
    found = whole.join(F.broadcast(asked), "pmid").agg(F.count("*").alias("n"), F.countDistinct(F.col("ordinal") - F.col("nth")).alias("shifts"), F.count_if(F.col("stratum") != F.col("said")).alias("wrong")).first()
    if found["n"] != len(ids):
        raise InvalidPacket("the manifest has ids that the sample lacks")
    if found["shifts"] != 1:
        raise InvalidPacket("the manifest's ids are no contiguous part of the sample's order")
    if found["wrong"]:
        raise InvalidPacket("the manifest's strata are not the sample's")


def check_answers(store: Store, batch_id: str | None = None) -> DataFrame:
    """Attempts, of one packet or of all, whose answer file is not what the ledger says, in one job (VAL-08)."""
    closed = store.read("manual_web_attempts").filter("status <> 'prepared'")
    ledger = (closed if batch_id is None else closed.filter(F.col("batch_id") == batch_id)).select("batch_id", "attempt", "output_path", "output_sha256")
    return validate.file_problems(file_digests(ledger, "output_path"), "output_path", "output_sha256").select("batch_id", "attempt", "output_path", "problem")


def validate_answer(store: Store, manifest_path: str | Path, output: str | Path, model: str, operator: str, fresh_chat: bool, executed_at: str, attempt: int = 1, mode: str = "manual", quotas: dict[str, int] | None = None, clock: Callable[[], str] = precise_now) -> list[dict]:
    """Check an answer against its packet, record the attempt and import it; failures are recorded and raised.

    Checks of the manifest, by itself and against the store, of the attempts so far and of their files raise without an attempt.
    """
    at = Path(manifest_path)
    m = json.loads(at.read_text())
    lacking = sorted({*IMMUTABLE, "created_at"} - set(m))
    if lacking:
        raise InvalidPacket(f"the manifest lacks {', '.join(lacking)}")
    if not isinstance(m["prompt_version"], str) or not m["prompt_version"].strip():
        raise InvalidPacket("the manifest has no prompt version")
    if at.parent.name != m["batch_id"] or m["schema_version"] != SCHEMA_VERSION or len(m["ordered_pmids"]) != m["record_count"]:
        raise InvalidPacket("the manifest does not fit its folder or version")
    if m["batch_id"] != _sha("\n".join([m["calibration_id"], m["prompt_version"], *m["ordered_pmids"]]))[:24]:
        raise InvalidPacket("the batch id does not follow from the manifest")
    for name, key in (("input.jsonl", "input_sha256"), ("web_prompt.txt", "web_prompt_sha256")):
        if _sha((at.parent / name).read_bytes()) != m[key]:
            raise InvalidPacket(f"{name} was changed")
    check_packet(store, m, quotas)
    if not model.strip() or not operator.strip() or not fresh_chat or not iso_time(executed_at):
        raise InvalidPacket("model, operator, a fresh chat and an ISO time are required")
    had = sorted((r.asDict() for r in store.read("manual_web_attempts").filter(F.col("batch_id") == m["batch_id"]).collect()), key=lambda r: r["attempt"])
    closed = [r for r in had if r["status"] != "prepared"]
    if [r["attempt"] for r in closed] != list(range(1, attempt)) or any(r["status"] == "valid" for r in closed):
        raise InvalidPacket("attempts have to follow each other, and none a valid one")
    if any(Path(r["output_path"]) == Path(output) for r in closed):
        raise InvalidPacket("the answer of an earlier attempt is given again")
    odd = check_answers(store, m["batch_id"]).orderBy("attempt").first()
    if odd:
        raise InvalidPacket(f"the answer of attempt {odd['attempt']} is {odd['problem']}")
    raw = Path(output).read_bytes()
    records, error = check_answer(raw.decode("utf-8"), m["ordered_pmids"], model, m["prompt_version"], executed_at)
    done = _attempt(m, attempt, "failed" if error else "valid", error=error, output_path=str(output), output_sha256=_sha(raw), model_label=model, operator=operator, execution_mode=mode, fresh_chat_confirmed=True, created_at=m["created_at"], executed_at=executed_at, validated_at=clock(), imported_at=None if error else clock(), input_path=str(at.parent / "input.jsonl"))
    with store.transaction():
        store.upsert("manual_web_attempts", [done])
        if not error:
            import_records(store, records, clock)
            items = store.frame("manual_web_attempt_items", [(m["batch_id"], attempt, p, i, None) for i, p in enumerate(m["ordered_pmids"], 1)])
            natural = items.withColumns({"model": F.lit(model), "prompt_version": F.lit(m["prompt_version"]), "screened_at": F.lit(executed_at)})
            store.upsert("manual_web_attempt_items", upsert.back_reference(natural, store.read("llm_screens"), KEYS["llm_screens"]).select(*items.columns))
    report = "validation.json" if attempt == 1 else f"validation.attempt-{attempt}.json"
    publish(at.parent / report, json.dumps({"status": done["status"], "error": error, "records": len(records)}, indent=2, sort_keys=True) + "\n")
    publish(at, json.dumps(m | {"status": done["status"], "attempt": attempt}, indent=2, sort_keys=True) + "\n")
    if error:
        raise InvalidPacket(error)
    return records


def import_records(store: Store, records: list[dict], clock: Callable[[], str] = now) -> tuple[int, int]:
    """Insert decisions with unknown keys; returns how many came and how many were new. Unknown articles raise."""
    names = [f.split(" ")[0] for f in f"{SEMANTIC}, model string, prompt_version string, screened_at string".split(", ")]
    rows = store.spark.createDataFrame([(n, *[r[k] for k in names]) for n, r in enumerate(records, 1)], f"line long, {SEMANTIC}, model string, prompt_version string, screened_at string")
    return import_frame(store, rows, clock)


def import_file(store: Store, path: str | Path, clock: Callable[[], str] = now) -> tuple[int, int]:
    """The same for files of JSON lines, read where they are; the first line with an error raises before anything is written (VAL-09)."""
    rows = stored(read_records(store.spark, str(path)), "import")
    bad = rows.filter("error is not null").orderBy("path", "line").select("line", "error").first()
    if bad:
        raise InvalidPacket(f"line {bad['line']}: {bad['error']}")
    out = import_frame(store, rows.drop("error"), clock)
    discard(rows)
    return out


def import_frame(store: Store, rows: DataFrame, clock: Callable[[], str] = now) -> tuple[int, int]:
    """Insert typed decisions, the first line of a key winning; ids go on from the last one in the order of the lines."""
    missing = [r["pmid"] for r in upsert.orphans(rows, store.read("articles"), ["pmid"]).select("pmid").limit(5).collect()]
    if missing:
        raise InvalidPacket(f"unknown articles: {', '.join(missing)}")
    table = store.read("llm_screens")
    top = table.agg(F.max("id")).first()[0] or 0
    order = [F.asc(c) for c in ("path", "line") if c in rows.columns]
    new = upsert.inserted(table, batches.global_position(rows, order).withColumns({"id": F.col("position") + top, "imported_at": F.lit(clock())}), KEYS["llm_screens"], [F.asc("id")])
    new = stored(new, "inserted")
    store.append("llm_screens", new)
    counts = rows.count(), new.count()
    discard(new)
    return counts
