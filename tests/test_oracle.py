"""Every registered query beside its DuckDB SQL, on the small tables."""

import duckdb
import pytest

from brinework.plans import registry

registry.load()
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES + ["embeddings"]:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def rows(columns, got):
    out = []
    for r in got:
        out.append(tuple("null" if r[c] is None else f"{float(r[c]) + 0.0:.5f}" if isinstance(r[c], float) else str(r[c]) for c in columns))
    return sorted(out)


def same(a, b):
    """Rounded values may differ by one in the last place."""
    for x, y in zip(a, b):
        if x != y:
            for u, v in zip(x, y):
                if u != v and ("null" in (u, v) or abs(float(u) - float(v)) > 2e-5 + 1e-9 * abs(float(u))):
                    return False
    return True


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, sf, name):
    df = registry.QUERIES[name](spark, sf)
    got = [r.asDict() for r in df.collect()]
    assert got
    assert all(t in ("bigint", "int", "double", "string", "boolean") for _, t in df.dtypes), df.dtypes
    if name not in registry.ORACLE_SQL:
        return
    rel = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(rel.columns) == sorted(df.columns)
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    columns = sorted(df.columns)
    a, b = rows(columns, got), rows(columns, want)
    assert len(a) == len(b)
    wrong = [(x, y) for x, y in zip(a, b) if x != y and not same([x], [y])]
    assert not wrong, wrong[:3]
