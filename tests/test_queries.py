"""Every registered query of the map engine against its oracle in another engine."""

from __future__ import annotations

import os

import duckdb
import pytest

from waymill.queries import annotate, documents, extras, graph, lifecycle, packs, records, spatial, tag_rules

MODULES = (tag_rules, graph, spatial, records, lifecycle, annotate, extras, documents, packs)
CASES = [(m, q) for m in MODULES for q in m.QUERIES if q in m.ORACLES]


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return con


def plain(value):
    if value is None or value != value:
        return "null"
    if isinstance(value, bool):
        return str(value)
    return repr(round(float(value), 6) + 0.0) if isinstance(value, (int, float)) else str(value)


@pytest.mark.parametrize(("module", "name"), CASES, ids=[q for _, q in CASES])
def test_query_matches_oracle(spark, sf, oracle, module, name):
    frame = module.QUERIES[name](spark, sf)
    names = sorted(frame.columns)
    answer = oracle.execute(module.ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == names
    want = sorted([plain(dict(zip(columns, row, strict=True))[n]) for n in names] for row in answer.fetchall())
    got = sorted([plain(row[n]) for n in names] for row in frame.collect())
    assert len(got) == len(want)
    assert got == want
    assert got, "the fixture must reach the operator"
