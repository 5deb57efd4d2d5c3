"""Every registered query against its SQL at the smallest scale."""

import check_oracle
import pytest
from conftest import SMALL

from rowloom.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return check_oracle.connect(SMALL)


def test_names_line_up():
    assert set(ORACLES) <= set(QUERIES)


#: Wide presets take long to plan: two unlike generations run here, all of them in tools/check_oracle.py.
CHECKED = sorted(n for n in ORACLES if not n.endswith("_sums") or n.endswith(("gen1v2_sums", "gen2_sums")))


@pytest.mark.parametrize("name", CHECKED)
def test_against_sql(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert check_oracle.compare(got, duck.execute(ORACLES[name]).df()) == ""
