"""Stages that are run once: a stage whose inputs and settings are those of its table is read, any other is built anew."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import SCHEMA_VERSION, read_table, write_table
from ..storage import publish_text, read_text


@dataclass(frozen=True)
class Settings:
    """What the stages of a run share. Secrets are no settings: they are never written."""

    seed: str = "peerloom"
    limit: int | None = None
    allow_partial: bool = False
    options: dict[str, str] = field(default_factory=dict)


def places(root: str) -> dict[str, str]:
    """Where each stage's table and the report lie under root."""
    return {name: f"{root.rstrip('/')}/{i:02d}_{name}" for i, name in enumerate(("reviews", "metadata", "papers", "issues"), 1)} | {"report": f"{root.rstrip('/')}/report.json"}


def utc_now() -> str:
    return datetime.now(timezone.utc).replace(microsecond=0).isoformat()


def fingerprint(settings: Settings, inputs: dict[str, str]) -> str:
    """One hash of the settings and of what the inputs are made from."""
    return hashlib.sha256(json.dumps([SCHEMA_VERSION, asdict(settings), sorted(inputs.items())], sort_keys=True).encode()).hexdigest()


def made_from(spark: SparkSession, path: str) -> str:
    """What identifies the table at path: the folder of its data, which is new each time it is written; empty if there is none."""
    text = read_text(spark, f"{path}/manifest.json")
    return json.loads(text)["data"] if text else ""


def run_stage(spark: SparkSession, path: str, stage: str, settings: Settings, inputs: dict[str, str], build: Callable[..., DataFrame], complete: bool = True) -> DataFrame:
    """The table of a stage: build(**tables of inputs), or what is there if it was made from the same.

    inputs: stage -> path of its table. They are read as they are, never refreshed; a partial one only if the settings
    allow it. A stage that fails leaves the table before in place, and the next run goes on from there."""
    mark = fingerprint(settings, {s: made_from(spark, p) for s, p in inputs.items()})
    text = read_text(spark, f"{path}/manifest.json")
    there = json.loads(text) if text else {}
    if (there.get("stage"), there.get("made_from"), there.get("complete")) == (stage, mark, complete):
        return read_table(spark, path, stage, allow_partial=True)
    tables = {s: read_table(spark, p, s, settings.allow_partial) for s, p in inputs.items()}
    write_table(build(**tables), path, stage, complete, mark)
    return read_table(spark, path, stage, allow_partial=True)


def write_report(spark: SparkSession, path: str, issues: DataFrame) -> bool:
    """The number of issues of each constraint as JSON; gives whether there is none."""
    found = {r["constraint"]: r["n"] for r in issues.groupBy("constraint").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    publish_text(spark, path, json.dumps({"at": utc_now(), "passed": not found, "issues": dict(sorted(found.items()))}, indent=2))
    return not found
