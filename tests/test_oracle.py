"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from flowmart.plans import oracle as O
from flowmart.plans import queries as Q

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


QUERIES = sorted(Q.queries())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(O.oracle_sql())
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, res.fetchall())


_SPARK_TYPES = {"string": "str", "bigint": "int", "int": "int32", "double": "float",
                "boolean": "bool"}
_DUCK_TYPES = {"VARCHAR": "str", "BIGINT": "int", "INTEGER": "int32", "DOUBLE": "float",
               "BOOLEAN": "bool"}


@pytest.mark.parametrize("name", QUERIES)
def test_query_types_match_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    spark_types = {f.name: _SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    rel = con.sql(E.oracle_sql()[name])
    duck_types = {c: _DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["stt", "edt", "vc", "ch", "ar", "isNew", "uvCt", "svCt", "pvCt", "durSum"]
