"""Every registered query against its SQL in DuckDB."""

import re
from pathlib import Path

import pytest
from compare import differences

import __spark_entry__ as entry_point

DATA = "/root/testdata"
OPTIONAL = re.compile(r"op\d+_|pipeline$")  # tested with their own subpackage
QUERIES = {n: q for n, q in entry_point.queries().items() if not OPTIONAL.match(n)}
ORACLES = {n: q for n, q in entry_point.oracle_sql().items() if not OPTIONAL.match(n)}
STREAMS = [name for name in QUERIES if name.endswith("_stream")]
BATCH = [name for name in QUERIES if name not in STREAMS]

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", BATCH)
def test_batch_query(spark, name):
    sf_dir = f"{DATA}/sf0.01"
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir) == ""


@pytest.mark.parametrize("name", BATCH)
def test_batch_query_small(spark, name):
    sf_dir = f"{DATA}/sf0.001"
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir) == ""


@pytest.mark.parametrize("name", STREAMS)
def test_stream_query(spark, name):
    sf_dir = f"{DATA}/sf0.001"
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir) == ""


def test_entry(spark):
    assert entry_point.entry(spark).columns == [
        "area", "product_id", "product_name", "clickcount", "cityremark",
    ]
