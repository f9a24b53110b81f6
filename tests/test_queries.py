"""Every registered query against its SQL on the smallest benchmark tables, and the shape of the registry."""

import math
import os

import pytest

from jobtide.plans.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are not available")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def normal(rows):
    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else round(value, 6) + 0.0
        return value

    return sorted((tuple(cell(v) for v in row) for row in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    types = {c[0]: str(c[1]) for c in result.description}
    order = [list(types).index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in result.fetchall()]
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    assert normal(tuple(r[c] for c in columns) for r in df.collect()) == normal(expected)
