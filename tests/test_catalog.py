"""Every query with an oracle gives the oracle's rows on the smallest tables."""

import os

import duckdb
import pytest

from plumbline import registry
from plumbline.sources.fixtures import TABLES

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        # Bounds of cells of two values reach 1e16, which only a relative tolerance can compare.
        return "nan" if v != v else round(v, 5) + 0.0 if abs(v) < 1e4 else float(f"{v:.9g}")
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
@pytest.mark.parametrize("name", [n for n in registry.oracle_sql()])
def test_equals_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    out = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == cols
    theirs = sorted(repr(tuple(plain(r[names.index(c)]) for c in cols)) for r in out.fetchall())
    assert mine == theirs
