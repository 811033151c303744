"""Every query over empty tables, null rows, repeated rows and clashing columns."""

import pytest

from noticeflow.plans import general, reference
from odd import folders


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    from conftest import DATA

    return folders(spark, DATA, tmp_path_factory.mktemp("odd"))


@pytest.mark.parametrize("name", sorted({**general.QUERIES, **reference.QUERIES}))
def test_odd(spark, data, odd, name):
    query = {**general.QUERIES, **reference.QUERIES}[name]
    usual = sorted(map(str, query(spark, data).collect()))
    assert sorted(map(str, query(spark, odd["clashing"]).collect())) == usual
    query(spark, odd["empty"]).collect()
    twice = query(spark, odd["nulls"]).collect()
    if name in ("p1_found", "p1_values", "p2_found", "p6_found"):
        assert sorted(map(str, twice)) == usual
