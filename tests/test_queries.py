"""Every registered query against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys

import compare
import pytest

from framelake.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, name):
    assert compare.compare(spark, con, SF, name, registry.QUERIES[name], registry.SQL.get(name)) is None


def test_entry(spark):
    import __spark_entry__ as driver
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_works_without_the_text_operators(tmp_path, pipeline):
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{top}/framelake", tmp_path / "framelake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *["corpus_pipeline.py"] * pipeline]:
        shutil.copy(f"{top}/{name}", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') for q in e.queries()), 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(registry.QUERIES)), str(len(registry.SQL)), "False", "False"], done.stderr
