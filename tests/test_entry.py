import importlib
import re
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_library_does_not_import_the_llm_package():
    for path in (ROOT / "quietfare").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "quietfare.llm" not in path.read_text(), path


def test_no_local_checkpoints_or_cross_joins():
    for path in (ROOT / "quietfare").rglob("*.py"):
        assert not re.search(r"localCheckpoint\(|crossJoin\(", path.read_text()), path


def test_modules_import():
    for path in (ROOT / "quietfare").rglob("*.py"):
        if "llm" not in path.parts:
            importlib.import_module(".".join(path.relative_to(ROOT).with_suffix("").parts).removesuffix(".__init__"))
