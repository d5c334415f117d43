"""Plans folded over a DataFrame: one lazy logical plan from the scan to the released columns."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from datetime import UTC, datetime
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quietfare.functions.hashing import pseudonym, salt_fingerprint
from quietfare.functions.spans import redact, scan
from quietfare.functions.temporal import bucket
from quietfare.operators import kanon
from quietfare.operators.zones import with_boroughs
from quietfare.plans.policy import Policy, Step, compile_policy
from quietfare.sources import salts, sinks

#: Spans of a note; any Column-valued detector may take its place.
NoteDetector = Callable[[Column], Column]


def dimension(df: DataFrame, token: str, minutes: int) -> Column:
    """A dimension token as a Column: a time bucket or an existing column; anything else is an error."""
    if token in ("pickup_bucket", "dropoff_bucket"):
        return bucket(F.col(token.replace("bucket", "datetime")), minutes)
    if token in df.columns:
        return F.col(token)
    raise ValueError(f"unknown dimension {token}")


def apply_step(df: DataFrame, step: Step, salt: bytes, zones: DataFrame | None, detector: NoteDetector | None) -> DataFrame:
    args = step.args
    if step.op == "redact_note":
        if detector is None:
            raise ValueError("the policy redacts notes, so it needs a detector")
        found = df.withColumn("_spans", detector(F.col("support_note")))  # a column of its own: a detector may run outside the JVM
        return found.withColumn("support_note", redact(F.col("support_note"), F.col("_spans"))).drop("_spans")
    if step.op == "pseudonymize":
        return df.withColumns({c: pseudonym(F.col(c), salt) for c in args["columns"] if c in df.columns})
    if step.op == "generalize_time":
        return df.withColumns({c: bucket(F.col(c), args["minutes"]) for c in ("pickup_datetime", "dropoff_datetime") if c in df.columns})
    if step.op == "rollup_zone":
        return with_boroughs(df, zones).drop("PULocationID", "DOLocationID")
    if step.op == "drop_columns":
        return df.drop(*args["columns"])
    if step.op == "kanon":
        return kanon.suppress(df, args["qi"], args["k"])
    if step.op == "select":
        return df.select(*[c for c in args["columns"] if c in df.columns])
    if step.op == "aggregate":
        wide = with_boroughs(df, zones) if {"PUBorough", "DOBorough"} & set(args["dimensions"]) and zones is not None else df
        keyed = wide.select(*[dimension(wide, t, args["minutes"]).alias(t) for t in args["dimensions"]])
        return kanon.cells(keyed, args["dimensions"], args["k"])
    raise ValueError(f"unknown step {step.op}")


def run_plan(df: DataFrame, plan: Sequence[Step], salt: bytes = b"", zones: DataFrame | None = None, detector: NoteDetector | None = scan) -> DataFrame:
    """The plan's result as one lazy DataFrame. The salt is an argument, so a run can be repeated."""
    if any(s.op == "pseudonymize" for s in plan) and not salt:
        raise ValueError("pseudonyms need a salt")
    return reduce(lambda d, step: apply_step(d, step, salt, zones, detector), plan, df)


def export(df: DataFrame, policy: Policy, salt: bytes = b"", zones: DataFrame | None = None, detector: NoteDetector | None = scan) -> DataFrame:
    return run_plan(df, compile_policy(policy), salt, zones, detector)


def withheld(original: Sequence[str], shared: Sequence[str]) -> list[str]:
    """Columns of the source that are not released."""
    return sorted(set(original) - set(shared))


NO_SALT = "n/a"  # fixed value: the fingerprint of an export without pseudonyms


def step_audit(df: DataFrame, step: Step, detector: NoteDetector | None = scan) -> dict:
    """What one step does to ``df``, its input: operation, columns or minutes, and the counts of steps that take something away."""
    args = step.args
    if step.op == "redact_note":
        n = df.where("support_note is not null").select(F.size(detector(F.col("support_note"))).alias("n")).agg(F.count_if(F.col("n") > 0).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("spans")).first()
        return {"op": step.op, "rows_redacted": n.rows, "spans_masked": n.spans}
    if step.op in ("pseudonymize", "select"):
        return {"op": step.op, "columns": [c for c in args["columns"] if c in df.columns]}
    if step.op == "drop_columns":
        return {"op": step.op, "dropped": [c for c in args["columns"] if c in df.columns], "missing": [c for c in args["columns"] if c not in df.columns]}
    if step.op == "kanon":
        n = kanon.suppression_audit(df, args["qi"], args["k"]).first()
        return {"op": step.op, "qi": list(args["qi"]), "k": args["k"], "rows_in": n.rows_in, "rows_out": n.rows_out, "cells_suppressed": n.cells_suppressed, "k_achieved": n.k_achieved}
    if step.op == "aggregate":
        wide = with_boroughs(df, zones) if (zones := args.get("zones")) is not None else df
        n = kanon.cells_audit(wide.select(*[dimension(wide, t, args["minutes"]).alias(t) for t in args["dimensions"]]), args["dimensions"], args["k"]).first()
        return {"op": step.op, "dimensions": list(args["dimensions"]), "k": args["k"], "cells_in": n.cells_in, "cells_out": n.cells_out, "cells_suppressed": n.cells_suppressed, "rows_in": n.rows_in, "rows_out": n.rows_represented, "k_achieved": n.k_achieved}
    return {"op": step.op, **args}


def output_hash(path: str | Path) -> str:
    """SHA-256 over the written files of ``path`` (or the file itself), by name and in chunks."""
    digest = hashlib.sha256()
    root = Path(path)
    for file in sorted(root.rglob("part-*")) if root.is_dir() else [root]:
        with file.open("rb") as source:
            for piece in iter(lambda: source.read(1 << 20), b""):
                digest.update(piece)
    return digest.hexdigest()


def release(
    df: DataFrame, policy: Policy, digest: str, source: str, folder: str | Path, score: float | None, zones: DataFrame | None = None, detector: NoteDetector | None = scan,
    salts_folder: str | Path | None = None, approval_id: str | None = None, input_hash: str = "", threshold: float = 90.0, at: str | None = None,
) -> dict:
    """Writes an export as ``<policy>_<source>`` under ``folder`` and gives its audit record.

    The gate comes first: with a score that is missing or too low, or without the
    approval that the policy asks for, nothing is planned, salted or written, and
    the record says why. A salt is made only if the plan has pseudonyms. Row-level
    exports are Parquet, aggregates CSV with the largest cells first.
    """
    record = {
        "policy_name": policy.name, "policy_version": policy.version, "policy_hash": digest, "output_kind": policy.output_kind, "source": source, "input_hash": input_hash,
        "requires_approval": policy.requires_approval, "approval_id": approval_id, "gate": {"health_score": score, "refused": score is None or score < threshold}, "generated_utc": at or datetime.now(UTC).isoformat(),
    }
    reason = "the health score is missing or below the threshold" if record["gate"]["refused"] else "the policy needs an approval" if policy.requires_approval and not approval_id else None
    if reason:
        return record | {"refused": True, "reason": reason, "salt_fingerprint": NO_SALT, "columns_shared": [], "columns_withheld": sorted(df.columns), "output_path": None, "output_hash": None}
    plan = compile_policy(policy)
    salt = salts.generate_salt() if any(s.op == "pseudonymize" for s in plan) else b""
    if salt and salts_folder is None:
        raise ValueError("pseudonyms need a folder for their salt")
    if salt:
        salts.write_salt(salt, salts_folder)
    steps, out = [], df
    for step in plan:
        steps.append(step_audit(out, Step(step.op, step.args | ({"zones": zones} if step.op == "aggregate" and zones is not None else {})), detector))
        out = apply_step(out, step, salt, zones, detector)
    aggregate = policy.output_kind == "aggregate"
    target = Path(folder) / f"{policy.name}_{source}.{'csv' if aggregate else 'parquet'}"
    if aggregate:
        sinks.write_csv(out, str(target), [F.desc("trip_count"), *steps[0]["dimensions"]])
        counts = {k: steps[0][k] for k in ("rows_in", "rows_out", "cells_in", "cells_out", "cells_suppressed", "k_achieved")}
    else:
        sinks.write_parquet(out, str(target))
        taken = [s for s in steps if s["op"] == "kanon"]
        counts = {"rows_in": df.count(), "rows_out": df.sparkSession.read.parquet(str(target)).count(), "cells_suppressed": sum(s["cells_suppressed"] for s in taken), "k_achieved": taken[-1]["k_achieved"] if taken else None}
    return record | counts | {
        "refused": False, "reason": None, "salt_fingerprint": salt_fingerprint(salt) if salt else NO_SALT, "columns_shared": list(out.columns), "columns_withheld": withheld(df.columns, out.columns),
        "output_path": str(target), "output_hash": output_hash(target), "transforms": steps,
    }
