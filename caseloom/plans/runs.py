"""Certified runs: context, envelope, summary and sentinel. Only counts, digests and rules come to the driver."""

from __future__ import annotations

import hashlib
import json
import platform
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators import certify
from caseloom.sources import sinks


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=True)


def digest(value) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


@dataclass
class Run:
    """One run of a stage. Its start time is the time of every row it writes; its id follows from stage, start and
    configuration, so equal runs at equal times are one run."""

    spark: SparkSession
    stage: str
    root: str
    config: dict = field(default_factory=dict)
    code_version: str = "unknown"
    started: datetime = field(default_factory=lambda: datetime.now(UTC))

    def __post_init__(self):
        self.config_digest = digest(self.config)
        self.runtime_digest = digest({"python": platform.python_version(), "spark": self.spark.version})
        stamp = self.started.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        self.run_id = f"{self.stage}_{stamp}_{digest([self.stage, stamp, self.config_digest, self.code_version])[:8]}"
        self.dir = f"{self.root}/{self.run_id.replace(':', '')}"

    @property
    def seen_at(self) -> str:
        return self.started.strftime("%Y-%m-%dT%H:%M:%SZ")

    def finish(self, outputs: DataFrame, failures: DataFrame, counts: dict, json_column, rules=None, quality: dict | None = None, distributions: dict[str, DataFrame] | None = None, upstream: dict | None = None, max_failures: int = 0, max_rate: float = 0.0, short_envelope: bool = False, inputs: DataFrame | None = None, input_digest: str | None = None) -> dict:
        """Write outputs, failures and the input manifest, evaluate all rules over what was stored, write the report and
        the summary, look at the files themselves, and publish the final report, the summary and then the sentinel.

        ``counts``: records_seen, records_succeeded, records_failed and records_skipped as the input has them. ``rules``:
        a function of the stored outputs that gives the stage's own rules. ``inputs``: the input manifest's entries.
        """
        outputs.write.mode("overwrite").parquet(f"{self.dir}/outputs")
        failures.write.mode("overwrite").json(f"{self.dir}/failures")
        stored = self.spark.read.parquet(f"{self.dir}/outputs")
        n = {"records_completed": counts["records_succeeded"] + counts["records_skipped"], **counts}
        d = certify.set_digest(stored, json_column).first()
        taken = self.input_manifest(inputs) if inputs is not None else {}
        input_digest = input_digest or taken.get("input_digest")
        failed = self.spark.read.schema(failures.schema).json(f"{self.dir}/failures").count()
        base = certify.envelope(n, failed, [self.config_digest, self.runtime_digest, d.digest], max_failures=max_failures, max_rate=max_rate, deterministic=not short_envelope)
        base += list(rules(stored)) if rules else []
        if short_envelope:  # the same input must have given the same output before
            prior = latest_certified(self.spark, self.root, self.stage)
            same = prior is not None and prior.get("input_digest") == input_digest
            agrees = not same or (prior["output_count"], prior["output_digest"]) == (d.record_count, d.digest)
            base.append(("sentence_spans_reproducible_for_same_input_digest", "error", agrees, f"prior {prior['run_id']}" if same else "no comparable prior certified run"))
        shares, wide = {}, []
        for name, rows in (distributions or {}).items():
            rows.write.mode("overwrite").parquet(f"{self.dir}/distribution_{name}")
            head = self.spark.read.parquet(f"{self.dir}/distribution_{name}").orderBy(F.desc("n"), "value").limit(SHOWN + 1).collect()
            shares[name] = {r[0]: r[1] for r in sorted(head[:SHOWN])}
            wide += [name] if len(head) > SHOWN else []  # all values are in the folder
        ended = datetime.now(UTC)
        seconds = (ended - self.started).total_seconds()

        def publish(every: list[tuple]) -> dict:
            summary = certify.rule_summary(certify.as_rules(self.spark, every)).first().asDict()
            blocking = [r[0] for r in every if r[1] == "error" and not r[2]]
            at = ended.strftime("%Y-%m-%dT%H:%M:%SZ")
            out = n | taken | {
                "run_id": self.run_id, "stage_name": self.stage, "status": "failed" if blocking else "certified", "sentinel": True, "run_dir": self.dir,
                "started_at": self.seen_at, "ended_at": at, "certified_at": None if blocking else at,
                "output_count": d.record_count, "output_digest": d.digest, "input_digest": input_digest, "config_digest": self.config_digest, "runtime_digest": self.runtime_digest, "code_version": self.code_version,
                "records_per_second": round(n["records_seen"] / seconds, 6) if seconds else 0.0, "rules": summary, "blocking": blocking, "quality": quality or {}, "upstream_run_id": (upstream or {}).get("run_id"),
                "distributions": shares, "distributions_shown_in_part": wide,
            }
            sinks.write_atomic(self.spark, f"{self.dir}/validation.json", json.dumps([dict(zip(("rule_id", "severity", "passed", "detail"), r, strict=True)) for r in every], indent=2))
            sinks.write_atomic(self.spark, f"{self.dir}/metrics.json", json.dumps(n | {"quality": quality or {}}, indent=2))
            sinks.write_atomic(self.spark, f"{self.dir}/run_summary.json", json.dumps(out, indent=2))
            return out

        publish(base)
        wanted = ["outputs", "failures", "validation.json", "metrics.json", "run_summary.json", *(["input_manifest"] if inputs is not None else [])]
        missing = [x for x in wanted if not sinks.exists(self.spark, f"{self.dir}/{x}")]
        out = publish(certify.file_rules(missing, self.broken([x for x in wanted if x not in missing])) + base)
        sinks.sentinel(self.spark, self.dir, out["status"] == "certified", self.run_id)
        return out

    def broken(self, names: list[str]) -> list[str]:
        """Those of the run's JSON files, and of its folders of JSON lines, that do not parse."""
        bad = []
        for name in names:
            if name.endswith(".json"):
                try:
                    json.loads(sinks.read_small(self.spark, f"{self.dir}/{name}"))
                except ValueError:
                    bad.append(name)
            elif name in ("failures", "input_manifest"):
                lines = self.spark.read.text(f"{self.dir}/{name}").where("trim(value) <> ''")
                if not lines.where(F.try_parse_json("value").isNull() | ~F.ltrim("value").startswith("{")).isEmpty():
                    bad.append(name)
        return bad

    def input_manifest(self, entries: DataFrame) -> dict:
        """Write the run's input entries (scalar columns) as spaced JSON lines with sorted keys, in order of their text;
        the folder, the number of entries and their digest."""
        lines = entries.select(sinks.spaced_json({c: F.col(c) for c in entries.columns}).alias("value"))
        path = f"{self.dir}/input_manifest"
        lines.orderBy("value").write.mode("overwrite").text(path)
        d = certify.set_digest(self.spark.read.schema("value string").text(path), F.col("value")).first()
        return {"input_manifest": path, "input_count": d.record_count, "input_digest": d.digest}


#: Most values of a distribution that a summary shows; the run's folder has all of them.
SHOWN = 1000


def load_summary(spark: SparkSession, run_dir: str) -> dict:
    """A run's summary: run_summary.json, else the one file *_run_summary.json; several or none are errors."""
    if sinks.exists(spark, f"{run_dir}/run_summary.json"):
        return json.loads(sinks.read_small(spark, f"{run_dir}/run_summary.json"))
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{run_dir}/*_run_summary.json")
    found = sorted(x.getPath().toString() for x in p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or [])
    if len(found) != 1:
        raise ValueError(f"{len(found)} run summaries under {run_dir}")
    return json.loads(sinks.read_small(spark, found[0]))


def summaries(spark: SparkSession, root: str, stage: str | None = None) -> list[dict]:
    """Summaries of the finished runs under ``root``, of one stage or all; run folders begin with their stage, so others
    are not opened. Run folders without a summary are skipped."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{stage or ''}*/*run_summary.json")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return [load_summary(spark, x) for x in sorted({f.getPath().getParent().toString() for f in found or []})]


def latest_certified(spark: SparkSession, root: str, stage: str) -> dict | None:
    runs = [s for s in summaries(spark, root, stage) if s["stage_name"] == stage and s["status"] == "certified" and sinks.exists(spark, f"{s['run_dir']}/_CERTIFIED")]
    return max(runs, key=lambda s: (s["certified_at"] or s["ended_at"], s["run_dir"]), default=None)


def acquisition_run_id() -> str:
    """The one id that is random."""
    return str(uuid.uuid4())
