"""Each query with SQL gives the same rows as DuckDB does over the small tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

from studygraph import plans

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9)
    if isinstance(x, list | tuple):
        return tuple(map(plain, x))
    if isinstance(x, dict):
        return tuple(sorted((k, plain(v)) for k, v in x.items()))
    return x


def same(spark, run, sql, sf_dir=DATA):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = db.execute(sql)
    names = [c[0] for c in want.description]
    got = run(spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    order = sorted(names)
    expected = Counter(plain([dict(zip(names, row, strict=True))[c] for c in order]) for row in want.fetchall())
    found = Counter(plain([row[c] for c in order]) for row in got.collect())
    assert found == expected
    return sum(found.values())


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_matches_sql(spark, name):
    same(spark, plans.queries()[name], plans.oracle_sql()[name])
