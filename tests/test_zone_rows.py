"""No zone's row carries its city's whole list of zones."""

import re

import pytest

from abspark.config import FIXTURE_CONFIG
from abspark.operators import setups
from abspark.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sources(spark):
    return tables.derive_from_star_schema(spark, SF)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_a_zone_is_taken_out_of_its_city_without_the_other_zones(sources):
    lines = optimized(setups.zone_geography(sources.countries, setups.experiment_zones(sources.experiment_setups, FIXTURE_CONFIG)))
    (made,) = [x for x in lines if "Generate explode(" in x and "zones" in x]
    assert re.search(r"explode\(zones#\d+\), \[\d+\]", made), made  # the list itself is no column of the outcome
