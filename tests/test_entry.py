"""The entry points with and without the corpus operators."""

import shutil
import subprocess
import sys

from tests.conftest import ROOT

CODE = """
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
print(len(q), set(o) <= set(q), 'pipeline' in q, sum(n.startswith('op') for n in q))
"""


def _listed(folder):
    out = subprocess.run([sys.executable, "-c", CODE], cwd=folder, capture_output=True, text=True, env={"PYTHONPATH": str(folder), "PATH": "/usr/bin:/bin"}, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


def test_queries_without_the_corpus_operators(tmp_path):
    shutil.copytree(ROOT, tmp_path / "all", ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    shutil.copytree(tmp_path / "all", tmp_path / "rest", ignore=shutil.ignore_patterns("llm"))
    n, known, pipeline, ops = _listed(tmp_path / "all")
    assert known == "True"
    n_rest, known, pipeline, ops = _listed(tmp_path / "rest")
    assert known == "True" and pipeline == "False" and ops == "0" and int(n_rest) > 100
    text = "\n".join(p.read_text() for p in (tmp_path / "rest").rglob("*.py") if p.name not in ("corpus_pipeline.py", "__spark_entry__.py") and "tests" not in p.parts)
    assert "quarry.llm" not in text
