"""The driver contract without the optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("left_out", [["letterscope/llm"], ["letterscope/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_queries_load_without_optional_parts(tmp_path, left_out):
    shutil.copytree(ROOT / "letterscope", tmp_path / "letterscope", ignore=shutil.ignore_patterns(
        "__pycache__", *(["llm"] if "letterscope/llm" in left_out else [])))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    probe = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    out = subprocess.run([sys.executable, "-c", probe], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    names = out.stdout.split()
    assert "command_counts" in names and "pipeline" not in names
    assert any(n.startswith("op9_") for n in names) == ("letterscope/llm" not in left_out and (ROOT / "letterscope/llm").exists())
