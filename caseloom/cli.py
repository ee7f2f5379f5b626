"""Command line: each command runs one stage over tables under a data root and prints its summary as one JSON line."""

from __future__ import annotations

import argparse
import json
import os
import platform
import re
import sys
import time
from datetime import UTC, datetime
from pathlib import Path

from caseloom.operators import cases, classify, state
from caseloom.operators.atomic import load_transformer, stated_claims
from caseloom.plans import acquisition, stages
from caseloom.plans.runs import Run, summaries
from caseloom.schemas import SCHEMAS
from caseloom.sources import files, sinks
from caseloom.sources.http import HttpClient, urllib_transport

_HOLE = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


def expand(value, env: dict):
    """``${NAME:-default}`` in every text of a settings tree; a name without value or default is an error."""
    if isinstance(value, dict):
        return {k: expand(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [expand(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def fill(m: re.Match) -> str:
        found = env.get(m[1]) or m[2]
        if found is None:
            raise ValueError(f"setting {m[1]} has no value")
        return found

    return _HOLE.sub(fill, value)


def load_settings(path: str, env: dict | None = None) -> dict:
    """YAML settings with placeholders filled; storage paths must be relative and stay below the root."""
    import yaml

    cfg = expand(yaml.safe_load(Path(path).read_text()) or {}, dict(os.environ if env is None else env))
    for name, value in (cfg.get("storage") or {}).items():
        if name != "root" and isinstance(value, str) and (value.startswith("/") or ".." in value.split("/")):
            raise ValueError(f"storage.{name} must be a relative path")
    return cfg


def parse_dotenv(text: str) -> dict[str, str]:
    out = {}
    for line in text.splitlines():
        line = line.strip().removeprefix("export ")
        if line and not line.startswith("#") and "=" in line:
            k, v = line.split("=", 1)
            out[k.strip()] = v.strip().strip("'\"")
    return out


def layered(dotenv: dict, env: dict, cli: dict, prefix: str = "CASELOOM_") -> dict:
    """Configuration by rising precedence: dotenv, environment, command line. Empty values count as absent."""
    own = lambda d: {k.removeprefix(prefix).lower(): v for k, v in d.items() if k.startswith(prefix) and v != ""}
    return own(dotenv) | own(env) | {k: v for k, v in cli.items() if v is not None}


#: Commands of acquisition, and those that fetch.
TABLE_COMMANDS = ("init-db", "sync-investigations", "discover-dockets", "enumerate-dockets", "download-selected", "collect", "promote", "materialize-case", "export-ingestion-manifest", "summarize", "run", "doctor", "select", "register-reports", "extract")
STAGES = ("ingest", "triage", "narrative", "structure", "sentence-spans", "atomic-extract")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="caseloom")
    p.add_argument("--data", required=True, help="root of tables and runs, any path Spark can write")
    p.add_argument("--code-version", default="unknown")
    p.add_argument("--config", help="YAML settings")
    p.add_argument("--env-file", help="NAME=value lines, below the environment in rank")
    p.add_argument("--index-url")
    p.add_argument("--search-url")
    p.add_argument("--docket-url")
    p.add_argument("--rate", type=float, help="requests a second")
    sub = p.add_subparsers(dest="command", required=True)
    c = {name: sub.add_parser(name) for name in (*TABLE_COMMANDS, *STAGES)}
    for name in ("enumerate-dockets", "download-selected", "promote", "run"):
        c[name].add_argument("--ntsb-number", help="one case only")
    for name in ("sync-investigations", "run"):
        c[name].add_argument("--payloads", help="folder of captured index payloads, instead of the index itself")
        c[name].add_argument("--limit", type=int, help="most investigations, for the index to apply")
    for name in ("sync-investigations", "enumerate-dockets", "download-selected", "materialize-case"):
        c[name].add_argument("--html-feedback", action="store_true", help="write a report beside the run")
    c["materialize-case"].add_argument("--ntsb-number", help="without one, only the plan of all cases is written")
    c["materialize-case"].add_argument("--output-root")
    for name in ("promote", "run"):
        c[name].add_argument("--raw-root", help="where promoted files go")
    c["register-reports"].add_argument("--raw-root", required=True)
    c["register-reports"].add_argument("--manifest")
    c["register-reports"].add_argument("--blob-prefix", action="append", default=[])
    c["extract"].add_argument("--extractor", required=True, help="package.module:callable from a file's bytes to its pages' texts")
    c["extract"].add_argument("--ocr-threshold", type=int, default=200)
    c["extract"].add_argument("--ocr", action="store_true")
    c["ingest"].add_argument("--manifest", required=True)
    c["ingest"].add_argument("--texts", required=True, help="Parquet of blob_path, text, error")
    for name in STAGES[1:]:
        c[name].add_argument("--input", required=name != "atomic-extract")
        c[name].add_argument("--upstream", help="root of the certified runs the input must come from")
    c["structure"].add_argument("--trace", action="store_true")
    c["atomic-extract"].add_argument("--transformer", help="package.module:callable over one span; default: stated claims")
    return p


def settings(args, env: dict | None = None) -> dict:
    """Layered settings of a command: env file, environment, command line; a YAML file's top level lies below all."""
    base = {k: v for k, v in (load_settings(args.config, env) if args.config else {}).items() if not isinstance(v, dict)}
    dotenv = parse_dotenv(Path(args.env_file).read_text()) if args.env_file else {}
    return base | layered(dotenv, dict(os.environ if env is None else env), {k: getattr(args, k) for k in ("index_url", "search_url", "docket_url", "rate")})


def _need(cfg: dict, name: str) -> str:
    if not cfg.get(name):
        raise ValueError(f"{name} is not configured")
    return cfg[name]


class Reporter:
    """Lines of a long command: to the console and to a log under the root, each with its time; a heartbeat at most
    once a minute."""

    def __init__(self, store: acquisition.Store, clock=time.monotonic, every: float = 60.0):
        self.store, self.clock, self.every, self.lines = store, clock, every, []
        self.began = self.last = clock()
        self.phase = ""

    def line(self, text: str) -> None:
        told = f"{datetime.now(UTC).strftime('%Y-%m-%dT%H:%M:%SZ')} | {text}"
        self.lines.append(told)
        print(told, file=sys.stderr)

    def status(self, detail: str) -> None:
        if self.clock() - self.last >= self.every:
            self.last = self.clock()
            self.line(sinks.heartbeat(self.phase, self.clock() - self.began, detail))

    def close(self) -> str:
        path = f"{self.store.data}/logs/collect_{self.store.version}.log"
        sinks.write_atomic(self.store.spark, path, "\n".join(self.lines) + "\n")
        return path


def collect(store: acquisition.Store, client: HttpClient, cfg: dict, reporter: Reporter) -> dict:
    """Discover, enumerate and download in one go."""
    told: dict = {}
    try:
        for phase, name, step in (
            ("Discovering dockets", "discover-dockets", lambda: acquisition.discover(store, client, _need(cfg, "search_url"))),
            ("Enumerating dockets", "enumerate-dockets", lambda: acquisition.enumerate_dockets(store, client, _need(cfg, "docket_url"), acquisition.known_cases(store), reporter.status)),
            ("Downloading documents", "download-selected", lambda: acquisition.download(store, client, progress=reporter.status)),
        ):
            reporter.phase = phase
            reporter.line(f"--- Starting: {name} ---")
            told[name] = step()
            reporter.line(f"{name} complete | " + " | ".join(f"{sinks.label(k)}: {sinks.shown(v)}" for k, v in told[name].items()))
    except Exception as e:
        reporter.line(f"Collect failed | {e}")
        raise
    finally:
        path = reporter.close()
    found, listed, got = told.values()
    return {"discovered": found["discovered"], "enumerated": listed["enumerated"], "changed": found["changed"] + listed["changed"], "total_items": listed["total_items"], **{k: got[k] for k in ("selected", "downloaded", "reused", "rejected")}, "elapsed_duration": sinks.elapsed(reporter.clock() - reporter.began), "log_path": path}


def acquire(args, spark, run: Run, client: HttpClient | None) -> dict:
    """A command over the tables; its counters."""
    data, store = args.data, acquisition.Store(spark, args.data, run)
    cfg = settings(args)
    if client is None and args.command in ("sync-investigations", "discover-dockets", "enumerate-dockets", "download-selected", "collect", "run"):
        client = HttpClient(urllib_transport("caseloom"), rate=float(cfg.get("rate") or 1.0))
    number = getattr(args, "ntsb_number", None)
    wanted = acquisition.known_cases(store, number) if number else None
    raw_root = getattr(args, "raw_root", None) or f"{data}/raw"

    def sync() -> dict:
        folder = getattr(args, "payloads", None)
        bodies = spark.read.text(folder, wholetext=True).withColumnRenamed("value", "body") if folder else acquisition.fetch_index(store, client, _need(cfg, "index_url"), args.limit)
        return acquisition.sync(store, bodies)

    match args.command:
        case "init-db":
            new = [n for n in SCHEMAS if not sinks.exists(spark, f"{data}/tables/{n}/CURRENT")]
            for n in new:
                store.put(store.table(n), n)
            return {"created": len(new), "state_changed": bool(new)}
        case "sync-investigations":
            return sync()
        case "discover-dockets":
            return acquisition.discover(store, client, _need(cfg, "search_url"))
        case "enumerate-dockets":
            return acquisition.enumerate_dockets(store, client, _need(cfg, "docket_url"), wanted or acquisition.known_cases(store))
        case "download-selected":
            return acquisition.download(store, client, wanted)
        case "collect":
            return collect(store, client, cfg, Reporter(store))
        case "promote":
            return acquisition.promote(store, raw_root, wanted)
        case "run":
            found = sync()
            mine = wanted or store.table("investigations_current").select("ntsb_number")
            listed = acquisition.enumerate_dockets(store, client, _need(cfg, "docket_url"), mine)
            got = acquisition.download(store, client, mine)
            put = acquisition.promote(store, raw_root, mine)
            return {"investigations_discovered": found["discovered"], "investigations_changed": found["changed"], "dockets_enumerated": listed["enumerated"], "docket_items_total": listed["total_items"], **{f"selection_{k}": got[k] for k in ("evaluated", "selected", "rejected")}, "downloads_created": got["downloaded"], "downloads_reused": got["reused"], "promotions_evaluated": put["evaluated"], "promotions_created": put["promoted"], "promotions_reused": put["reused"], "conflicts": put["conflicts"]}
        case "select":
            items = store.table("docket_items_current")
            store.put(state.apply_selection(items, classify.select_items(items), run.seen_at, run.run_id), "docket_items_current")
            return {}
        case "export-ingestion-manifest":
            rows = cases.handoff(store.table("downloads_current"), store.table("docket_items_current"), store.table("docket_search_results_current"))
            return {"output_path": sinks.export_handoff(rows, f"{data}/exports", store.version)}
        case "summarize":
            names = ("investigations_current", "dockets_current", "docket_items_current", "blobs_current", "downloads_current", "promotions_current")
            per = cases.case_summary(acquisition.known_cases(store), store.table("docket_items_current"), store.table("downloads_current"))
            per.coalesce(1).write.json(f"{run.dir}/cases")
            return {"tables": {r.table_name: r.n for r in cases.table_counts({n: store.table(n) for n in names}).collect()}, "cases_path": f"{run.dir}/cases"}
        case "materialize-case" if number:
            return acquisition.materialize_case(store, number, args.output_root or f"{data}/case_views")
        case "materialize-case":
            cases.case_view(cases.selected_downloads(store.table("docket_items_current"), store.table("downloads_current"))).write.parquet(f"{run.dir}/case_view")
            return {"output_path": f"{run.dir}/case_view"}
        case "register-reports":
            return acquisition.register(store, raw_root, args.manifest, tuple(args.blob_prefix))
        case "extract":
            return acquisition.extract(store, load_transformer(args.extractor), args.ocr_threshold, args.ocr)
        case "doctor":
            return doctor(spark, data)
    raise ValueError(args.command)


def doctor(spark, data: str) -> dict:
    """Checks of what a run needs: versions, a root that can be written, a shared folder, tables."""
    version = tuple(int(x) for x in spark.version.split(".")[:2])
    probe = f"{data}/doctor.txt"
    try:
        sinks.write_atomic(spark, probe, "ok")
        writable = sinks.read_small(spark, probe) == "ok"
    except Exception:
        writable = False
    local = spark.sparkContext.master.startswith("local")
    checks = [
        {"check": "python_version", "ok": sys.version_info >= (3, 11), "detail": platform.python_version()},
        {"check": "spark_version", "ok": version >= (4, 0), "detail": spark.version},
        {"check": "data_root_writable", "ok": writable, "detail": data},
        {"check": "shared_folder", "ok": local or bool(spark.conf.get("spark.checkpoint.dir", None)), "detail": spark.conf.get("spark.checkpoint.dir", "-")},
    ]
    return {"checks": checks, "tables": {n: sinks.exists(spark, f"{data}/tables/{n}/CURRENT") for n in SCHEMAS}, "runs": len(summaries(spark, f"{data}/runs/*")), "state_changed": False, "unfit": not all(c["ok"] for c in checks)}


def staged(args, spark, run: Run) -> dict:
    """A certified stage."""
    if args.command == "ingest":
        records, rejected = files.read_handoff(spark, args.manifest)
        return stages.ingest(run, records, rejected, spark.read.parquet(args.texts))
    if args.command == "atomic-extract" and (args.upstream or not args.input):
        root = args.upstream or f"{args.data}/runs/sentence-spans"
        rows = stages.certified_spans(spark, root, args.input)[1] if not args.input or args.input.startswith(root) else spark.read.parquet(args.input)
    else:
        rows = spark.read.parquet(args.input)
    match args.command:
        case "triage":
            return stages.triage(run, rows, args.upstream)
        case "narrative":
            return stages.narratives(run, rows, args.upstream)
        case "structure":
            return stages.structures(run, rows, trace=args.trace)
        case "sentence-spans":
            return stages.sentence_spans(run, rows)
        case "atomic-extract":
            named = load_transformer(args.transformer) if args.transformer else stated_claims
            return stages.atomic_claims(run, rows, named, per_row=bool(args.transformer), upstream_root=args.upstream)
    raise ValueError(args.command)


#: Counters that say that a command changed something.
CHANGES = ("discovered", "changed", "enumerated", "selected", "rejected", "downloaded", "promoted", "investigations_changed", "downloads_created", "promotions_created", "materialized", "inserted", "claimed")


def main(argv: list[str] | None = None, spark=None, client: HttpClient | None = None) -> int:
    """Run one command; one JSON line with its status. ``client`` replaces the network."""
    args = parser().parse_args(argv)
    if spark is None:
        from caseloom.session import session

        spark = session()
    stage = {"sentence-spans": "sentence_spans"}.get(args.command, args.command)
    run = Run(spark, stage, f"{args.data}/runs/{args.command}", {k: v for k, v in vars(args).items() if k != "data"}, args.code_version)
    try:
        out = staged(args, spark, run) if args.command in STAGES else acquire(args, spark, run, client)
    except Exception as e:
        print(json.dumps({"command": args.command, "status": "error", "error_type": type(e).__name__, "error_message": " ".join(str(e).split())[:1000]}, sort_keys=True))
        return 1
    bad = out.pop("unfit", False) or bool(out.get("conflicts")) or out.get("status", "certified") != "certified"
    out = {"run_id": run.run_id, "status": "error" if bad else "ok", "state_changed": any(isinstance(out.get(k), int) and out[k] > 0 for k in CHANGES)} | out
    if getattr(args, "html_feedback", False):
        shown = {k: v for k, v in out.items() if k not in ("run_id", "status", "state_changed")}
        out["report_path"] = f"{args.data}/reports/{sinks.report_name(args.command, run.run_id, run.seen_at)}"
        sinks.write_atomic(spark, out["report_path"], sinks.html_report(args.command, shown, None, run.run_id, run.seen_at))
    print(json.dumps({"command": args.command} | out, sort_keys=True, default=str))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
