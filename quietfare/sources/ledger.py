"""Hash-chained ledger of JSON lines: appended by one writer, verified by Spark."""

from __future__ import annotations

import fcntl
import hashlib
import json
import uuid
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quietfare.operators.skew import rank_in_key

# The first entry's predecessor; entries' keys (seq, timestamp_utc, run_id, command, operator,
# prev_entry_hash, entry_hash) and their canonical form (sorted keys, no blanks) decide the hashes.
GENESIS = "0" * 64


def canonical(entry: dict) -> str:
    return json.dumps(entry, sort_keys=True, separators=(",", ":"), default=str)


def entry_hash(entry: dict) -> str:
    """SHA-256 of the canonical entry without its own hash."""
    return hashlib.sha256(canonical({k: v for k, v in entry.items() if k != "entry_hash"}).encode()).hexdigest()


def make_entry(last: dict | None, record: dict, command: str, operator: str, run_id: str | None = None, at: str | None = None) -> dict:
    entry = {
        "seq": last["seq"] + 1 if last else 0, "timestamp_utc": at or datetime.now(UTC).isoformat(), "run_id": run_id or str(uuid.uuid4()),
        "command": command, "operator": operator, "prev_entry_hash": last["entry_hash"] if last else GENESIS, **record,
    }
    return entry | {"entry_hash": entry_hash(entry)}


def _last_line(path: Path, step: int = 4096) -> str | None:
    """The last line that isn't blank, read from the file's end."""
    with path.open("rb") as ledger:
        at, tail = ledger.seek(0, 2), b""
        while at > 0:
            size = min(step, at)
            at -= size
            ledger.seek(at)
            tail = ledger.read(size) + tail
            lines = tail.rstrip().splitlines()
            if len(lines) > 1 or (lines and at == 0):
                return lines[-1].decode()
    return None


def append(path: str | Path, record: dict, command: str, operator: str, run_id: str | None = None, at: str | None = None) -> dict:
    """Appends one entry under a file lock; only the last line is read."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    with target.open("a+", encoding="utf-8") as ledger:
        fcntl.flock(ledger, fcntl.LOCK_EX)
        last = _last_line(target)
        entry = make_entry(json.loads(last) if last else None, record, command, operator, run_id, at)
        ledger.write(canonical(entry) + "\n")
    return entry


def _true_hash(line: str) -> str | None:
    try:
        return entry_hash(json.loads(line))
    except ValueError:
        return None


def checked(lines: DataFrame) -> DataFrame:
    """``lines`` (``pos``, ``line``) with the first reason why each entry breaks the chain, null if it doesn't."""
    recomputed = F.pandas_udf(lambda x: x.map(_true_hash), StringType())  # lines need not be canonical
    fields = lines.select(
        "pos", F.get_json_object("line", "$.seq").cast("bigint").alias("seq"), F.get_json_object("line", "$.prev_entry_hash").alias("prev"),
        F.get_json_object("line", "$.entry_hash").alias("hash"), recomputed("line").alias("true_hash"),
    )
    # places and predecessors without a global window: ranks by one range shuffle, then each entry meets the one before it
    ranked = rank_in_key(fields.withColumn("_all", F.lit(0)), ["_all"], ["pos"], fields.columns, "_rank").withColumn("expected", F.col("_rank") - 1)
    before = ranked.select((F.col("_rank") + 1).alias("_next"), F.col("hash").alias("before"))
    linked = ranked.join(before, F.col("_rank") == F.col("_next"), "left").withColumn("before", F.when(F.col("expected") == 0, GENESIS).otherwise(F.col("before")))
    reason = (
        F.when(~F.col("seq").eqNullSafe(F.col("expected")), "sequence number is not the place")
        .when(~F.col("prev").eqNullSafe(F.col("before")), "previous hash is not the predecessor's")
        .when(~F.col("hash").eqNullSafe(F.col("true_hash")), "content hash mismatch")
    )
    return linked.select(F.col("expected").cast("bigint").alias("position"), "seq", "hash", reason.alias("reason"))


def verify(lines: DataFrame) -> DataFrame:
    """One row: ``ok``, ``entries``, ``break_seq``, ``reason`` of the first break. An empty ledger is whole."""
    first = F.min(F.when(F.col("reason").isNotNull(), F.struct("position", "reason")))
    return checked(lines).agg(F.count(F.lit(1)).alias("entries"), first.alias("_b")).select(
        F.col("_b").isNull().alias("ok"), "entries", F.col("_b.position").alias("break_seq"), F.col("_b.reason").alias("reason")
    )
