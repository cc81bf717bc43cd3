"""Queries of this subpackage against their SQL."""

from pathlib import Path

import duckdb
import pytest

from conftest import SF
from loomset.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    duck = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        duck.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = duck.sql(f"SELECT {', '.join(cols)} FROM ({queries.ORACLES[name]})")
    norm = lambda rows: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=repr)
    assert norm(tuple(r) for r in df.select(*cols).collect()) == norm(want.fetchall())


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.QUERIES if n.startswith("op")] == [f"op{k}" for k in range(1, 11)]
