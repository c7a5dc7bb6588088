"""Command line: python -m strataflow.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json
import os
import sys
import uuid
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession, functions as F

from strataflow.functions.vocabularies import QUOTAS
from strataflow.operators import screen
from strataflow.plans import backfill, packets
from strataflow.plans.store import Store
from strataflow.sinks.files import export_report
from strataflow.sources.config import load_registry, load_rules, software_revision
from strataflow.sources.paged import Remote, Window


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strataflow")
    commands = p.add_subparsers(dest="command", required=True)

    def command(name: str, *args: str, **defaults: object) -> None:
        c = commands.add_parser(name)
        for a in args:
            flag = a.rstrip("!?")
            kind = {"action": "store_true"} if a.endswith("?") else {"required": a.endswith("!"), "default": defaults.get(flag[2:].replace("-", "_"))}
            c.add_argument(flag, **kind)

    source = ("--journals!", "--start!", "--end!", "--email!", "--api-key-env", "--batch-size")
    usual = {"api_key_env": "NCBI_API_KEY", "batch_size": 200, "journal": "all"}
    command("init-db", "--db!")
    command("enumerate", "--db!", "--journal", "--raw-dir!", *source, **usual)
    command("validate-registry", "--journal", *source, **usual)
    command("screen", "--db!", "--rules!")
    command("export-llm-queue", "--db!", "--out!")
    command("create-calibration-sample", "--db!", "--sample-id", "--seed", "--prompt-version", seed="calibration-v1", prompt_version="v1")
    command("export-calibration-queue", "--db!", "--calibration-id!", "--out!")
    command("prepare-web-calibration-batches", "--db!", "--calibration-id!", "--out!", "--prompt!", "--schema", "--batch-size", "--software-revision", batch_size=20)
    command("validate-web-calibration-batch", "--db!", "--manifest!", "--output!", "--model-display-name!", "--operator!", "--executed-at!", "--fresh-chat-confirmed?", "--attempt", "--execution-mode", attempt=1, execution_mode="manual")
    command("import-llm-results", "--db!", "--input!")
    command("sample-no-audit", "--db!", "--sample-id", "--fraction", "--seed", fraction=0.10, seed="audit-v1")
    command("status", "--db!")
    command("historical-backfill", "--db!", "--raw-dir!", "--resume-id", "--report", "--software-revision", *source, **usual)
    command("coverage-report", "--db!", "--backfill-id!", "--out!")
    return p


def _day(text: str) -> date:
    return date.fromisoformat(text)


def _source(a: argparse.Namespace) -> Remote:
    return Remote(a.email, os.environ.get(a.api_key_env))


def status(store: Store) -> dict:
    """Global counts, one aggregate a table."""
    count = lambda t, *c: store.read(t).agg(*(c or (F.count("*"),))).first()[0]
    return {
        "articles": count("articles"), "runs": count("enumeration_runs", F.count_if(F.col("status") == "complete")), "screened": count("deterministic_screens", F.countDistinct("pmid")),
        "llm_screened": count("llm_screens", F.countDistinct("pmid")), "human_reviewed": count("human_reviews", F.countDistinct("pmid")), "audit_sampled": count("audit_samples"), "backfills": count("historical_backfills"),
    }


def run(a: argparse.Namespace, spark: SparkSession, source: object | None = None) -> object:
    store = Store(spark, a.db) if getattr(a, "db", None) else None
    match a.command:
        case "init-db":
            return {"schema_version": store.read("schema_meta").first()["value"]}
        case "enumerate":
            registry = load_registry(a.journals)
            chosen = registry.journals if a.journal == "all" else (registry.by_key(a.journal),)
            return [backfill.enumerate_journal(store, source or _source(a), registry, j, _day(a.start), _day(a.end), a.raw_dir, int(a.batch_size)) for j in chosen]
        case "validate-registry":
            registry = load_registry(a.journals)
            asked = [(j.key, (source or _source(a)).count(Window(j.pubmed_title, _day(a.start), _day(a.end)))) for j in registry.journals if a.journal in ("all", j.key)]
            return {"journals": [{"key": k, "count": n, "valid": n > 0} for k, n in asked], "zero_hit_count": sum(n == 0 for _, n in asked)}
        case "screen":
            made = screen.screen(store.read("articles"), load_rules(a.rules), backfill.now())
            store.upsert("deterministic_screens", made.drop("obvious_non_original_type"))
            return screen.screen_summary(made).first().asDict()
        case "export-llm-queue":
            return {"records": packets.export_queue(store, a.out)}
        case "create-calibration-sample":
            items = packets.create_sample(store, a.sample_id or uuid.uuid4().hex, a.seed, a.prompt_version)
            return {r["stratum"]: {"population": r["p"], "selected": r["n"]} for r in items.groupBy("stratum").agg(F.max("population_size").alias("p"), F.count("*").alias("n")).collect()}
        case "export-calibration-queue":
            return {"records": packets.export_sample(store, a.calibration_id, a.out)}
        case "prepare-web-calibration-batches":
            return packets.prepare_packets(store, a.calibration_id, a.out, Path(a.prompt).read_text(), a.software_revision or software_revision(), int(a.batch_size), schema=Path(a.schema).read_text() if a.schema else None)
        case "validate-web-calibration-batch":
            return packets.validate_answer(store, a.manifest, a.output, a.model_display_name, a.operator, a.fresh_chat_confirmed, a.executed_at, int(a.attempt), a.execution_mode, QUOTAS)
        case "import-llm-results":
            came, new = packets.import_file(store, Path(a.input).resolve().as_uri())
            return {"records": came, "inserted": new}
        case "sample-no-audit":
            population, size = packets.sample_audit(store, float(a.fraction), a.seed, a.sample_id or uuid.uuid4().hex)
            return {"population": population, "sample": size}
        case "status":
            return status(store)
        case "historical-backfill":
            out = backfill.run_backfill(store, source or _source(a), load_registry(a.journals), _day(a.start), _day(a.end), a.raw_dir, a.software_revision or software_revision(), int(a.batch_size), resume=a.resume_id)
            if a.report:
                export_report(backfill.report(store, out["backfill_id"]), a.report)
            return out
        case "coverage-report":
            return str(export_report(backfill.report(store, a.backfill_id), a.out))
    raise AssertionError(a.command)


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("strataflow").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    print(json.dumps(run(a, spark), indent=2, sort_keys=True, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
