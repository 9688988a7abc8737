import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(folder, code):
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, timeout=120)


def copy(tmp_path, *without):
    skip = shutil.ignore_patterns(".git", "__pycache__", "*.pyc", *without)
    return shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)


def test_everything_else_works_without_the_text_operators(tmp_path):
    folder = copy(tmp_path, "llm", "corpus_pipeline.py")
    done = run(folder, "import __spark_entry__ as e; q = e.queries(); assert 'long_short' in q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)")
    assert done.returncode == 0, done.stderr


def test_a_broken_module_is_not_taken_for_a_missing_one(tmp_path):
    folder = copy(tmp_path, "llm", "corpus_pipeline.py")
    (folder / "panelwise" / "llm").mkdir()
    (folder / "panelwise" / "llm" / "__init__.py").write_text("")
    (folder / "panelwise" / "llm" / "queries.py").write_text("import a_module_that_is_nowhere\n")
    done = run(folder, "import __spark_entry__")
    assert done.returncode != 0 and "a_module_that_is_nowhere" in done.stderr
