"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from conftest import FOLDER
from oracle import compare

from edupipe.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert compare(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_oracle_notices_a_difference(spark, duck):
    wrong = ORACLES["lenient_int"].replace("-1", "-2")
    assert compare(QUERIES["lenient_int"](spark, FOLDER), duck, wrong) is not None
