"""The registered queries against DuckDB SQL; the entry's names."""

import math

import pytest

import __spark_entry__ as E
from innsight.llm.queries import ORACLES, QUERIES

from .data import SF, connect


def plain(v):
    return None if v is None or v != v else float(f"{v:.9g}") if isinstance(v, float) else v


def test_operators_and_the_pipeline_are_registered():
    names = E.queries()
    assert [n for n in names if n.startswith("op")] == list(QUERIES) and len(QUERIES) == 13
    assert "pipeline" in names and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    cur = connect().execute(ORACLES[name])
    cols = [c[0] for c in cur.description]
    names = sorted(df.columns)
    assert names == sorted(cols)
    want = sorted((tuple(plain(r[cols.index(c)]) for c in names) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in names) for r in got), key=repr) == want
    assert not any(isinstance(v, float) and math.isnan(v) for r in got for v in r)
