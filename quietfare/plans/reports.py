"""Reports as Markdown: pure functions of a record, so that a report can be made again byte for byte."""

from __future__ import annotations


def percent(part: float, whole: float) -> str:
    """A share as text; ``-`` where there is no whole."""
    return f"{part / whole:.2%}" if whole else "-"


def _table(head: list[str], rows: list[list[object]]) -> list[str]:
    return [f"| {' | '.join(head)} |", f"|{'---|' * len(head)}", *[f"| {' | '.join(map(str, r))} |" for r in rows]]


def _names(names: list[str]) -> str:
    return ", ".join(f"`{n}`" for n in names) or "none"


def validation_report(source: str, profile: dict, health: dict, rules: dict[str, int]) -> str:
    """Scores and gate of a table, and the rules that at least one row breaks. ``rules`` maps rule names to counts."""
    rows = profile["n"]
    lines = [f"# Validation of {source}", "", f"{rows:,} rows, {'refused' if health['refused'] else 'accepted'}", ""]
    lines += _table(["dimension", "score"], [[d, health[d]] for d in ("completeness", "validity", "consistency", "uniqueness", "health_score")])
    fired = sorted((-n, name) for name, n in rules.items() if n)
    lines += ["", "## Rules that fired", "", *(_table(["rule", "rows", "share"], [[name, f"{-n:,}", percent(-n, rows)] for n, name in fired]) if fired else ["none"])]
    return "\n".join([*lines, ""])


def risk_report(source: str, k: int, rungs: list[dict]) -> str:
    """The uniqueness ladder and what k-suppression costs on each of its rungs, which are rows of ``kanon.ladder``."""
    lines = [f"# Re-identification risk of {source}", "", f"k = {k}", ""]
    lines += _table(["quasi-identifier", "unique rows", "rows in", "rows out", "suppressed", "smallest class kept"], [
        [r["qi"], f"{r['uniqueness']:.2%}", f"{r['rows_in']:,}", f"{r['rows_out']:,}", f"{r['suppressed']:.2%}", "-" if r["k_achieved"] is None else r["k_achieved"]] for r in rungs
    ])
    return "\n".join([*lines, ""])


def methodology_report(record: dict) -> str:
    """How one export was made, from its audit record alone."""
    lines = [f"# Export under {record['policy_name']} v{record['policy_version']}", "", f"Source {record['source']}, made {record['generated_utc']}, {record['output_kind']}, policy {record['policy_hash']}", ""]
    if record["refused"]:
        return "\n".join([*lines, f"Refused, nothing was written: {record['reason']}", ""])
    lines += [f"Health score {record['gate']['health_score']}, salt {record['salt_fingerprint']}, output {record['output_path']} ({record['output_hash']})", "", "## Rows", ""]
    figures = ("rows_in", "rows_out", "cells_in", "cells_out", "cells_suppressed", "k_achieved")
    lines += _table(["figure", "value"], [[f, f"{record[f]:,}"] for f in figures if record.get(f) is not None])
    lines += ["", "## Columns", "", f"Shared: {_names(record['columns_shared'])}", "", f"Withheld: {_names(record['columns_withheld'])}", "", "## Steps", ""]
    lines += [f"{i}. {t['op']}" + "".join(f"; {k} = {v}" for k, v in t.items() if k != "op") for i, t in enumerate(record["transforms"], 1)]
    return "\n".join([*lines, ""])
