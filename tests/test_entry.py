import os
import shutil
import subprocess
import sys

import __spark_entry__

ROOT = os.path.dirname(os.path.abspath(__spark_entry__.__file__))


def test_entry_returns_rows(spark):
    out = __spark_entry__.entry(spark)
    assert out.count() > 0 and "readiness" in out.columns


def test_sql_is_of_registered_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_the_rest_stands_without_the_training_data_part(tmp_path):
    shutil.copytree(f"{ROOT}/loam", tmp_path / "loam", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) == set(q), len(q); print(len(q))"
    run = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert run.returncode == 0, run.stderr
