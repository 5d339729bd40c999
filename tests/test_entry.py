"""The driver's entry points work without the training-data folders."""

import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_entry_without_the_training_data_folders(tmp_path):
    shutil.copytree(ROOT / "lectern", tmp_path / "lectern", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 50 and set(o) <= set(q) and 'pipeline' not in q and not any(k.startswith('op') and k[2:3].isdigit() for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_nothing_else_imports_them():
    for path in (ROOT / "lectern").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "lectern.llm" not in path.read_text(), path
