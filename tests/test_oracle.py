"""Every registered query against its SQL twin, and a smoke run of the others."""

import pytest
from compare import compare, connect

import __spark_entry__ as contract

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_agrees_with_sql(spark, con, name):
    problem, rows, _ = compare(spark, con, name, SF)
    assert problem == ""
    assert rows > 0


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["doc_id", "verdict", "reason"]
    assert frame.count() == 200


# Counts of kept rows and first reasons at sf0.01.
EXPECTED = {
    "permissive": (834, {"max_ll": 108, "file_too_small": 1, "ave_ll": 2, "min_lines": 55}),
    "moderate": (419, {"max_ll": 513, "file_too_small": 4, "min_lines": 64}),
    "aggressive": (63, {"max_ll": 856, "file_too_small": 11, "min_lines": 70}),
}


@pytest.mark.parametrize("tier", EXPECTED)
def test_known_counts(spark, tier):
    rows = contract.queries()[f"f8_cascade_{tier}"](spark, SF).groupBy("reason").count()
    counts = {r["reason"]: r["count"] for r in rows.collect()}
    kept = counts.pop(None)
    assert (kept, counts) == EXPECTED[tier]


def test_tiers_are_nested(spark):
    kept = {
        tier: {r[0] for r in contract.queries()[f"f9_kept_{tier}"](spark, SF).select("doc_id").collect()}
        for tier in EXPECTED
    }
    assert kept["aggressive"] < kept["moderate"] < kept["permissive"]


def test_custom_limits_reach_every_rule(spark):
    out = contract.queries()["f8_cascade_custom"](spark, SF)
    reasons = {r[0] for r in out.select("reason").distinct().collect()}
    assert reasons == {
        None, "max_ll", "file_too_small", "file_too_large", "alphanum_frac", "ave_ll", "min_lines",
    }
