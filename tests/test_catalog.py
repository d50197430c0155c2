"""Every query of the core against its SQL twin."""

from collections import Counter

import duckdb
import pytest
from conftest import SMALL

from loomleaf.plans import catalog, core, exams, reported

SQL = {**core.SQL, **catalog.SQL, **exams.SQL, **reported.SQL}
QUERIES = {**core.QUERIES, **catalog.QUERIES, **exams.QUERIES, **reported.QUERIES}


@pytest.fixture(scope="module")
def con():
    from pathlib import Path

    c = duckdb.connect()
    for p in Path(SMALL).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def shown(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(round(r[i], 6) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    cur = con.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert shown(df.collect(), df.columns) == shown(cur.fetchall(), names)
