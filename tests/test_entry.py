"""The entry imports with and without the training-data operators."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


def names(root):
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr
    return set(out.stdout.split())


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_a_copy_without_the_folders_imports(tmp_path, with_pipeline):
    copy = tmp_path / "copy"
    for part in ("tidelog", "workload"):
        shutil.copytree(ROOT / part, copy / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for file in ("__spark_entry__.py", *(["corpus_pipeline.py"] if with_pipeline else [])):
        if (ROOT / file).exists():
            shutil.copy(ROOT / file, copy / file)
    own = names(copy)
    assert "history_table" in own and "pipeline" not in own and not any(re.match(r"op\d", n) for n in own)


def test_an_error_inside_the_operators_is_not_swallowed(tmp_path):
    if not (ROOT / "tidelog" / "llm").exists():
        pytest.skip("nothing to break")
    copy = tmp_path / "copy"
    for part in ("tidelog", "workload"):
        shutil.copytree(ROOT / part, copy / part, ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", copy / "__spark_entry__.py")
    (copy / "tidelog" / "llm" / "queries.py").write_text("import no_such_module")
    with pytest.raises(AssertionError, match="no_such_module"):
        names(copy)
