"""The registry, with and without the folders of the training-data operators."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_query_of_the_library_has_sql():
    from docroute.plans import registry

    assert set(registry.QUERIES) == set(registry.ORACLES) and set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stands_without_the_corpus_operators(tmp_path):
    shutil.copytree(os.path.join(ROOT, "docroute"), tmp_path / "docroute", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'resolve_full' in q and 'pipeline' not in q and not any(k.startswith('op') for k in q); print(len(q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
