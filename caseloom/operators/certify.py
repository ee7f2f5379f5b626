"""Measures, rules and digests that certify a run. All are map-combined aggregates; a run brings one row per rule and
distribution value to the driver, whatever the number of records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.identity import ordered_digest


def distribution(rows: DataFrame, column: str, missing: str = "unknown") -> DataFrame:
    """Rows per value, missing and blank values under one name."""
    value = F.coalesce(F.when(F.col(column).cast("string") != "", F.col(column).cast("string")), F.lit(missing))
    return rows.groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key: two-level count, so a frequent key is combined before it moves."""
    per = rows.groupBy(key).agg(F.count("*").alias("c"))
    return per.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicate_count"))


def missing_fields(rows: DataFrame, required: list[str], present: Column | None = None) -> DataFrame:
    """Required fields that are null or empty, summed; a record without its artifact lacks them all."""
    each = reduce(lambda a, b: a + b, [F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), 1).otherwise(0) for c in required])
    lacking = each if present is None else F.when(present, each).otherwise(len(required))
    return rows.agg(F.coalesce(F.sum(lacking), F.lit(0)).cast("long").alias("missing_count"))


def output_measures(stored: DataFrame, key: str, required: tuple[str, ...], enum: tuple[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row about a stage's stored output: distinct keys, rows beyond the first of each, required values that are
    missing or blank, and values outside ``enum`` (column, allowed; a missing one is outside too). Rows are combined
    per key first, so a frequent key is no hot task."""
    each = reduce(lambda a, b: a + b, [F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), 1).otherwise(0) for c in required])
    odd = F.lit(False) if enum is None else ~F.coalesce(F.col(enum[0]).isin(*enum[1]), F.lit(False))
    per = stored.groupBy(key).agg(F.count("*").alias("n"), F.sum(each).alias("lacking"), F.count_if(odd).alias("odd"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per.agg(F.count("*").alias("output_count"), total(F.col("n") - 1).alias("duplicate_key_count"), total("lacking").alias("missing_required_field_count"), total("odd").alias("invalid_enum_count"))


def output_rules(prefix: str, measures: dict, expected: int) -> list[tuple[str, str, bool, str]]:
    """Rules over :func:`output_measures`: as many outputs as the input called for, no missing value, no repeated key."""
    told = lambda k: f"{k}={measures[k]}"
    return [
        (f"{prefix}_output_count_matches_expected", "error", measures["output_count"] == expected, f"actual={measures['output_count']} expected={expected}"),
        (f"{prefix}_required_fields_present", "error", measures["missing_required_field_count"] == 0, told("missing_required_field_count")),
        (f"{prefix}_duplicate_keys_absent", "error", measures["duplicate_key_count"] == 0, told("duplicate_key_count")),
    ]


def count_rule(rule_id: str, name: str, n: int) -> tuple[str, str, bool, str]:
    """A rule that holds when nothing was counted against it."""
    return (rule_id, "error", n == 0, f"{name}={n}")


def rule_summary(rules: DataFrame) -> DataFrame:
    """``rules``: rule_id, severity, passed. Warnings counts rules of that severity, passed ones too."""
    return rules.agg(F.count("*").alias("evaluated"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"), F.count_if(F.col("severity") == "warning").alias("warnings"))


def within_threshold(failed: Column, seen: Column, max_count: int = 0, max_rate: float = 0.0) -> Column:
    """Failures at most so many, and at most so large a share of what was seen."""
    return (failed <= max_count) & ((seen == 0) | (failed / F.greatest(seen, F.lit(1)) <= max_rate))


def logical_digest(rows: DataFrame, json: Column) -> DataFrame:
    """Digest of all records as an ordered list of canonical JSON objects, and their number. Per-partition order and
    partition count do not matter. The list is one value, as its definition has it: meant for manifests of runs;
    :func:`set_digest` is for tables of any size."""
    return rows.agg(F.count("*").alias("record_count"), ordered_digest(json).alias("digest"))


def set_digest(rows: DataFrame, json: Column) -> DataFrame:
    """Order-free digest for tables of any size: sums of two independent 64-bit hashes of each record, with the count;
    16 bytes of state however many rows."""
    wide = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(38,0)"))
    return rows.agg(F.count("*").alias("record_count"), F.sha2(F.concat_ws(":", F.count("*"), wide(json), wide(json, F.lit(1))), 256).alias("digest"))


def average_rate(total: Column, count: Column) -> Column:
    return F.when(count > 0, F.round(total / count, 6)).otherwise(0.0)


def stage_counts(outcomes: DataFrame) -> DataFrame:
    """``outcomes``: outcome of ok, reused or failed. Completed counts reused records too, succeeded does not."""
    ok, reused, failed = (F.count_if(F.col("outcome") == k) for k in ("ok", "reused", "failed"))
    return outcomes.agg(F.count("*").alias("records_seen"), (ok + reused).alias("records_completed"), ok.alias("records_succeeded"), failed.alias("records_failed"), reused.alias("records_skipped"))


def as_rules(spark: SparkSession, rules: list[tuple[str, str, bool, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "rule_id string, severity string, passed boolean, detail string")


def envelope(counts: dict, failures: int, digests: list[str | None], status: str = "completed", max_failures: int = 0, max_rate: float = 0.0, deterministic: bool = True) -> list[tuple[str, str, bool, str]]:
    """Rules every run is held to before its files are looked at. ``counts``: what the input held and what became of it,
    counted apart from each other; ``failures``: failure records that were stored. ``deterministic`` off leaves out the
    digest and rate rules, for stages whose envelope is the short one."""
    seen, ok, failed, skipped = (counts[k] for k in ("records_seen", "records_succeeded", "records_failed", "records_skipped"))
    rules = [
        ("run_completed", "error", status == "completed", f"run_status={status}"),
        ("counts_reconcile", "error", seen == ok + failed + skipped, f"{seen} seen, {ok} + {failed} + {skipped} accounted for"),
        ("failures_recorded", "error", failures == failed, f"{failures} failure records for {failed} failures"),
    ]
    if deterministic:
        rules += [(f"digest_{k}_present", "error", bool(d), f"{d}") for k, d in enumerate(digests)]
        rate = failed / seen if seen else 0.0
        rules.append(("failure_threshold", "error", failed <= max_failures and rate <= max_rate, f"{failed} failures, rate {rate:.6f}"))
    return rules


def file_rules(missing: list[str], broken: list[str]) -> list[tuple[str, str, bool, str]]:
    """Rules about a run's files as they were found: those that are not there, and those that are no JSON."""
    return [("outputs_present", "error", not missing, ", ".join(missing) or "all run files exist"), ("json_parses", "error", not broken, ", ".join(broken) or "all run files parse")]


def latest_certified(runs: DataFrame, stage: str) -> DataFrame:
    """The last certified run of a stage, by time of certification and then by name: a map-combined maximum."""
    ok = runs.where((F.col("stage_name") == stage) & (F.col("status") == "certified") & F.col("sentinel"))
    best = ok.agg(F.max(F.struct(F.coalesce("certified_at", "ended_at").alias("at"), F.col("run_dir").alias("dir"), F.struct("*").alias("run"))).alias("b"))
    return best.where("b is not null").select("b.run.*")


def assert_upstream(run: dict | None, count: int, digest: str) -> None:
    """Refuse input that is not what the upstream run certified."""
    if run is None:
        raise RuntimeError("no certified upstream run")
    if run["output_count"] != count or run["output_digest"] != digest:
        raise RuntimeError(f"input differs from certified run {run['run_id']}: {count} records, {digest}")


#: Kind of failure -> (code, class, worth a retry).
FAILURES = {
    "unreadable": ("input_unreadable", "io", True),
    "missing": ("input_missing", "io", True),
    "invalid": ("input_invalid", "validation", False),
    "unsupported": ("input_unsupported", "validation", False),
    "transform": ("transform_failed", "processing", False),
    "contract": ("contract_violation", "contract", False),
    "unconfigured": ("transformer_unconfigured", "configuration", False),
    "write": ("output_failed", "io", True),
    "other": ("unexpected_error", "processing", False),
}


def failure_rows(failed: DataFrame, run_id: str, stage: str, record: Column, artifact: Column, kind: Column, message: Column) -> DataFrame:
    """Failure records in the common form; an unknown kind counts as "other"."""
    table = F.create_map(*[x for k, (code, cls, again) in FAILURES.items() for x in (F.lit(k), F.struct(F.lit(code).alias("c"), F.lit(cls).alias("k"), F.lit(again).alias("r")))])
    known = F.coalesce(F.try_element_at(table, kind), F.element_at(table, F.lit("other")))
    return failed.select(F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage_name"), record.alias("record_id"), artifact.alias("artifact_id"), known["c"].alias("failure_code"), known["k"].alias("failure_class"), message.alias("message"), known["r"].alias("retryable"), F.lit(None).cast("string").alias("blocked_output"), F.lit(None).cast("string").alias("source_locator"), F.lit(None).cast("string").alias("exception_type"))
