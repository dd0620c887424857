"""Every query of the catalog against its SQL on the small tables."""

import math
import os

import duckdb
import pytest

from corvane import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(([norm(r[c]) for c in cols] for r in df.collect()), key=repr)
    spark.catalog.clearCache()
    if name in catalog.ORACLES:
        rel = duck.sql(catalog.ORACLES[name])
        names = [d[0] for d in rel.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        assert got == sorted(([norm(r[i]) for i in at] for r in rel.fetchall()), key=repr)
    else:
        assert got
