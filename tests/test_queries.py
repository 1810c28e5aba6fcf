import decimal
import glob
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from gleanery.plans import records, reference, training

ALL = {k: f for m in (reference, records, training) for k, f in m.QUERIES.items()}
SQL = {k: s for m in (reference, records, training) for k, s in m.SQL.items()}


@pytest.fixture(scope="module")
def oracle(data):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{data}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def norm(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    return str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, data, oracle, name):
    df = ALL[name](spark, data)
    r = oracle.execute(SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted([norm(x[names.index(c)]) for c in order] for x in r.fetchall())
    assert sorted([norm(x[c]) for c in order] for x in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(ALL) - set(SQL)))
def test_query_runs(spark, data, name):
    df = ALL[name](spark, data)
    assert len(set(df.columns)) == len(df.columns)
    df.collect()


def test_entry(spark, data):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(ALL) <= set(e.queries())


def test_entry_works_without_the_llm_folder(tmp_path):
    """A copy without both folders imports, and registers all other queries."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "spark-warehouse", "*.parquet"))
    code = "import __spark_entry__ as e; print(len(e.queries()), any('llm' in m for m in __import__('sys').modules if m.startswith('gleanery')))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(ALL)), "False"], out.stderr


def test_a_fault_inside_the_llm_folder_is_not_hidden(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "spark-warehouse", "*.parquet"))
    (tmp_path / "r/gleanery/llm").mkdir()
    (tmp_path / "r/gleanery/llm/__init__.py").write_text("")
    (tmp_path / "r/gleanery/llm/queries.py").write_text("import no_such_module\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path / "r", env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode and "no_such_module" in out.stderr
