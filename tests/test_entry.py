"""The driver's contract: names agree, queries run, and the library stands without the llm subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_queries_run_and_repeat(spark, sf_dir):
    from tidewater import catalog

    for name, query in catalog.queries().items():
        rows = query(spark, sf_dir)
        assert rows.columns and len(set(rows.columns)) == len(rows.columns), name
        if name in catalog.oracle_sql():
            assert sorted(rows.columns) == sorted(columns_of(name, sf_dir)), name


def columns_of(name, sf_dir):
    import duckdb

    from tidewater import catalog

    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    return con.sql(catalog.oracle_sql()[name]).columns


def test_stands_without_llm(tmp_path):
    """A copy without the llm folders and the pipeline still imports and lists its queries."""
    import shutil

    shutil.copytree(ROOT / "tidewater", tmp_path / "tidewater", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); print(len(q))"
    env = {"PATH": "/usr/bin:/bin", "PYTHONPATH": ""}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env=env, timeout=120)
    assert done.returncode == 0, done.stderr


def test_core_does_not_import_llm():
    for path in (ROOT / "tidewater").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "tidewater").parts:
            assert "tidewater.llm" not in path.read_text(), path
