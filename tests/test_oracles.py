"""Every registered query against its DuckDB oracle at sf0.001 (rows, columns, values)."""

import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from prodlink.plans import queries as Q


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v if isinstance(v, (int, bool, str)) else str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


# The queries of the optional subpackage have tests of their own.
QUERIES = {name: fn for name, (fn, _) in Q.REGISTRY.items()}
ORACLES = {name: sql for name, sql in E.oracle_sql().items() if name in QUERIES}
_DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
              "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = df.toPandas()
    res = duck.execute(ORACLES[name])
    duck_types = {d[0]: str(d[1]) for d in res.description}
    want = res.df()
    spark_types = {f.name: _DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == duck_types
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "post_key"
    assert df.where("found").count() > 0
