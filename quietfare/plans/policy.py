"""Declarative sharing policies and their compilation to an ordered plan."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml

POLICIES = Path(__file__).resolve().parent.parent / "policies"


@dataclass(frozen=True)
class Step:
    """One operation of a plan with its arguments."""

    op: str
    args: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    description: str
    output_kind: str
    requires_approval: bool = False
    row_level: dict[str, Any] | None = None
    aggregate: dict[str, Any] | None = None

    def __post_init__(self) -> None:
        if self.output_kind not in ("row_level", "aggregate"):
            raise ValueError(f"unknown output_kind {self.output_kind}")
        if getattr(self, self.output_kind) is None:
            raise ValueError(f"a policy of kind {self.output_kind} needs the block {self.output_kind}")
        if self.output_kind == "aggregate" and not self.aggregate.get("dimensions"):
            raise ValueError("an aggregate policy needs dimensions")


def policy_hash(raw: dict[str, Any]) -> str:
    """SHA-256 of the policy's canonical JSON."""
    return hashlib.sha256(json.dumps(raw, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def load_policy(path: str | Path) -> tuple[Policy, str]:
    """The policy of a YAML file and its hash. Unknown keys are an error."""
    raw = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    return Policy(**raw), policy_hash(raw)


def compile_policy(policy: Policy) -> list[Step]:
    """The plan, always in the order redact, pseudonymise, generalise time, roll up zones, drop, suppress, select."""
    if policy.output_kind == "aggregate":
        block = policy.aggregate or {}
        return [Step("aggregate", {"dimensions": list(block["dimensions"]), "minutes": block.get("time_bucket_minutes", 60), "k": block.get("k", 5)})]
    block = policy.row_level or {}
    possible = [
        Step("redact_note") if block.get("redact_note") else None,
        Step("pseudonymize", {"columns": block["pseudonymize_columns"]}) if block.get("pseudonymize_columns") else None,
        Step("generalize_time", {"minutes": block["time_bucket_minutes"]}) if block.get("time_bucket_minutes") else None,
        Step("rollup_zone") if block.get("rollup_zone") else None,
        Step("drop_columns", {"columns": block["drop_columns"]}) if block.get("drop_columns") else None,
        Step("kanon", dict(block["kanon"])) if block.get("kanon") else None,
        Step("select", {"columns": block["select_columns"]}) if block.get("select_columns") else None,
    ]
    return [s for s in possible if s]
