"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

from suite.check import compare, duck
from suite.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    text, _, good = compare(spark, con, SF, name)
    assert good and "types" not in text, text


SKEWED = [
    "claim_running", "stays_with_next", "readmissions", "omop_condition", "omop_drug", "omop_measurement",
    "prior_event_windows", "readmission_label", "discharge_features", "medication_adherence",
]


@pytest.mark.parametrize("name", SKEWED)
def test_hot_key_plan_gives_the_same_result(spark, con, every_key_hot, name):
    text, _, good = compare(spark, con, SF, name)
    assert good, text


def test_rows_only_queries_are_few():
    assert ROWS_ONLY == []
