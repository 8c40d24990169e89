"""The entry point with and without its optional parts."""

import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
SHOW = "import __spark_entry__ as e; print(len(e.queries()), sorted(q for q in e.queries() if q.startswith('op') or q == 'pipeline'), set(e.oracle_sql()) <= set(e.queries()))"


def copied(tmp_path, *without):
    for name in ("quarry", "__spark_entry__.py", "corpus_pipeline.py"):
        if not (ROOT / name).exists():
            continue
        if (ROOT / name).is_dir():
            shutil.copytree(ROOT / name, tmp_path / name, ignore=lambda d, names: [n for n in names if n == "__pycache__" or f"{pathlib.Path(d).name}/{n}" in without])
        elif name not in without:
            shutil.copy(ROOT / name, tmp_path / name)
    return tmp_path


@pytest.mark.parametrize("without", [("quarry/llm",), ("quarry/llm", "corpus_pipeline.py")])
def test_entry_without_the_training_data_part(tmp_path, without):
    from quarry.plans.catalog import queries

    got = subprocess.run([sys.executable, "-c", SHOW], cwd=copied(tmp_path, *without), capture_output=True, text=True)
    assert got.returncode == 0, got.stderr
    assert got.stdout.strip() == f"{len(queries())} [] True"


def test_entry_without_the_pipeline_only(tmp_path):
    if not (ROOT / "quarry/llm").exists():
        pytest.skip("no training-data part")
    got = subprocess.run([sys.executable, "-c", SHOW], cwd=copied(tmp_path, "corpus_pipeline.py"), capture_output=True, text=True)
    assert got.returncode == 0, got.stderr
    assert "op1_minhash_near_dedup" in got.stdout and "'pipeline'" not in got.stdout
