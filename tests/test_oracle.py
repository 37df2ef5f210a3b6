import pytest

import __spark_entry__ as entry_points
import star_queries
from tests.oracle import FOLDER, compare

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


def test_every_query_on_keyed_tables_has_an_oracle():
    assert set(star_queries.QUERIES) == set(star_queries.ORACLES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(star_queries.ORACLES))
def test_matches_oracle(spark, name):
    ours, theirs = compare(spark, f"{FOLDER}/sf0.001", QUERIES[name], ORACLES[name])
    assert ours == theirs


def test_entry(spark):
    assert entry_points.entry(spark).columns == [
        "Country",
        "Method",
        "ValidFromVersion",
        "ValidToVersion",
        "Cents",
    ]
