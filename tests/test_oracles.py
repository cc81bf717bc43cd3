"""Every catalog query against its SQL in another engine."""

from pathlib import Path

import duckdb
import pytest

from conftest import SF
from loomset.plans import catalog


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def _norm(rows):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    sql = catalog.ORACLES[name]
    assert sorted(duck.sql(sql).columns) == cols
    want = duck.sql(f"SELECT {', '.join(f'\"{c}\"' for c in cols)} FROM ({sql})").fetchall()
    assert _norm(tuple(r) for r in df.select(*(f"`{c}`" for c in cols)).collect()) == _norm(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def _copy(to, *left_out):
    import shutil

    shutil.copytree(Path(__file__).resolve().parent.parent, to, ignore=shutil.ignore_patterns(".git", "__pycache__", *left_out))
    return to


def _entry(folder, code, path=""):
    import subprocess
    import sys

    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); llm = [n for n in q if n.startswith('op') and n[2].isdigit() or n == 'pipeline'];" + code], cwd=folder, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": f"{path}:{folder}"})


def test_rest_works_without_the_optional_folders(tmp_path):
    """With the pipeline's module left in place, which can't be imported then."""
    _entry(_copy(tmp_path / "r", "llm"), "assert not llm and len(q) > 60 and set(o) <= set(q)")


def test_missing_libraries_cost_no_other_query(tmp_path):
    (tmp_path / "none").mkdir()
    for name in ("tiktoken", "regex"):
        (tmp_path / "none" / f"{name}.py").write_text("raise ImportError")
    _entry(_copy(tmp_path / "r"), "assert len(q) > 60", path=tmp_path / "none")
