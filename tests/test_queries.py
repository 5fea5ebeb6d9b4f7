"""Every query of the log operators against its SQL."""

import math
from pathlib import Path

import pytest

from halocline.plans.queries import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")


def canonical(rows, columns, order):
    at = [columns.index(c) for c in order]
    plain = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else round(float(v), 6) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    got = df.collect()
    assert got or name == "despike_gpd"
    if name in ORACLES:
        res = duck(DATA).execute(ORACLES[name])
        columns = [c[0] for c in res.description]
        assert sorted(columns) == sorted(df.columns)
        assert canonical(got, df.columns, sorted(columns)) == canonical(res.fetchall(), columns, sorted(columns))


def test_entry_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
