"""Every registered query: against its oracle where there is one, else non-empty with a stable schema."""

import pytest

import oracle
from assetboard import plans
from conftest import FOLDER

QUERIES = plans.queries()
ORACLES = plans.oracle_sql()


@pytest.fixture
def duck():
    """A connection of its own for every test: one that fails cannot spoil the next."""
    con = oracle.connect(FOLDER)
    yield con
    con.close()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    problems = oracle.compare(QUERIES[name](spark, FOLDER), duck, ORACLES[name])
    assert [p for p in problems if p != "no rows"] == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.columns and df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    df = entry.entry(spark)
    assert df.columns == ["format", "team_size", "asset_id", "consensus_value", "board_rank"] and df.count() > 0
