"""The driver's entry module, with and without the text operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; q = e.queries(); print('KEYS', len(q), 'ros_impute' in q, set(e.oracle_sql()) <= set(q), any(k.startswith('op') for k in q) or 'pipeline' in q)"


def shown(folder):
    run = subprocess.run([sys.executable, "-B", "-c", SHOW], cwd=folder, env=os.environ | {"PYTHONPATH": folder}, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    return run.stdout.split("KEYS")[1].split()


def test_whole_repository():
    assert shown(ROOT)[1:3] == ["True", "True"]


def test_without_the_text_operators(tmp_path):
    for name in ("seepline", "suite"):
        shutil.copytree(f"{ROOT}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    assert shown(str(tmp_path))[1:] == ["True", "True", "False"]


def test_an_empty_folder_is_no_package(tmp_path):
    for name in ("seepline", "suite"):
        shutil.copytree(f"{ROOT}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "seepline" / "llm").mkdir()
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    assert shown(str(tmp_path))[1:] == ["True", "True", "False"]


def test_a_broken_import_is_an_error(tmp_path):
    for name in ("seepline", "suite"):
        shutil.copytree(f"{ROOT}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "seepline" / "llm").mkdir()
    (tmp_path / "seepline" / "llm" / "__init__.py").write_text("")
    (tmp_path / "seepline" / "llm" / "queries.py").write_text("import nothing_of_this_name\n")
    (tmp_path / "corpus_pipeline.py").write_text("")
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    run = subprocess.run([sys.executable, "-B", "-c", SHOW], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert run.returncode != 0 and "nothing_of_this_name" in run.stderr
